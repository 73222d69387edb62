"""Operator 9, language identification by nearest centroid.

A text is a vector of hashed character trigrams of its padded words, weighted
log(1 + tf) * idf and scaled to unit length; document frequencies are counted
over the learning rows.  Spherical k-means splits every learned language's sample
vectors into several centroids; a text gets the language of the centroid of
greatest cosine.  Each centroid remembers the distance within which nearly all
its own training texts lie: a text farther from its nearest centroid is
rejected (``accepted`` false), and the operator then calls it ``und`` when
asked to (``reject=True``).

Two scans of whole texts (frequencies, prediction), no shuffle of texts; what
is sent around is one frequency vector per task and the centroids, whose
sizes are fixed by ``dims`` and the number of languages.

Edge cases: null texts and texts without letters are ``und`` with score 0;
without any learnable language every text is ``und``; repeated rows are
predicted each; null languages never count as learned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import Memo, bounded_batches, crc_mod, pick, stable_hash, text_chunks, written
from quarry.plans.broadcast import bounded_broadcast
from quarry.sources.tables import load

DIMS = 1 << 13
CENTROIDS = 4
#: bound on the labelled rows of the fit, per language
TRAIN_ROWS = 1_000
#: share of its own training texts that a centroid accepts
ACCEPT = 0.995
UNKNOWN = "und"
_LETTERS = re.compile(r"[^\W\d_]+")


def token_memo() -> Memo:
    """Token -> hashed trigrams (16-bit) of its padded words, as bytes."""
    gram = Memo(lambda g: (stable_hash(g) % DIMS).to_bytes(2, "little"))

    def token_grams(token: str) -> bytes:
        out = []
        for word in _LETTERS.findall(token.lower()):
            if not any(map(str.isalpha, word)):     # other numerals only
                continue
            padded = f" {word} "
            out += [gram[padded[k:k + 3]] for k in range(len(word))]
        return b"".join(out)

    return Memo(token_grams)


def grams(text: str | None, memo: Memo) -> np.ndarray | None:
    """All trigrams of a text, None without letters.  Words never reach over
    white space, so tokens are looked up whole."""
    raw = b"".join(map(memo.__getitem__, text.split())) if text else b""
    return np.frombuffer(raw, dtype="<u2") if raw else None


def document_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """idf over ``docs``; one row per task is summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = token_memo()
        df = np.zeros(DIMS, dtype=np.int64)
        n = 0
        for _, texts in text_chunks(batches):
            for t in texts:
                g = grams(t, memo)
                if g is not None:
                    n += 1
                    df[g] += 1              # each dimension once
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([df.tolist()], pa.list_(pa.int64()))], names=["n", "df"])

    source = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = source.mapInArrow(count, "n long, df array<long>")
    sums = counted.select(F.posexplode(F.concat(F.array("n"), F.col("df"))).alias("k", "c")).groupBy("k").agg(F.sum("c").alias("c"))
    total = np.zeros(DIMS + 1)
    for r in sums.collect():            # DIMS + 1 rows
        total[r.k] = r.c
    return np.log((1 + total[0]) / (1 + total[1:])) + 1


def spherical_kmeans(x: np.ndarray, k: int, seed: int = 5, rounds: int = 20) -> np.ndarray:
    """Unit centroids of unit rows, started from random rows."""
    c = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        own = (x @ c.T).argmax(axis=1)
        new = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        norm = np.sqrt((new * new).sum(axis=1, keepdims=True))
        new = new / np.where(norm == 0, 1, norm)
        if np.allclose(new, c, atol=1e-5):
            break
        c = new
    return c


def learning_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, held: int) -> DataFrame:
    """(id, lang, text) of the rows that may be learned from."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang_col}`").alias("lang"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull()
                      & (crc_mod("id", folds) != held))


def training_sample(rows: DataFrame, most: int) -> DataFrame:
    """(lang, text): about ``most`` of the learning rows of every language.
    Rows are diced by id and text, repeated ones count once; the shares, a row
    per language, are broadcast behind a check of their number, so that no text
    is shuffled by language."""
    share = written(rows.groupBy("lang").agg((F.lit(float(most)) / F.count("*")).alias("share")), "shares")
    dice = F.pmod(F.xxhash64("id", "text", F.lit(3)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    return written(rows.join(bounded_broadcast(share), "lang").where(dice < F.col("share"))
                   .select("lang", "text").distinct(), "languages")


class Model:
    def __init__(self, idf: np.ndarray, langs: list[str], centroids: np.ndarray, reach: np.ndarray):
        self.idf, self.langs, self.centroids, self.reach = idf.astype(np.float32), langs, centroids, reach

    def predict(self, rows: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        sims = rows @ self.centroids.T
        at = sims.argmax(axis=1)
        cos = sims[np.arange(len(rows)), at]
        return [self.langs[k] for k in at], np.clip(cos, 0, 1), cos >= self.reach[at]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          rows_per_language: int = TRAIN_ROWS, centroids: int = CENTROIDS, folds: int = 4, held: int = 2) -> Model | None:
    """None if there is nothing to learn from."""
    rows = learning_rows(docs, id_col, text_col, lang_col, folds, held)
    idf = document_frequencies(rows, "text")
    sample = training_sample(rows, rows_per_language)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = token_memo()
        for (lang,), texts in text_chunks(batches):
            keep, got = [], []
            for r, t in enumerate(texts):
                g = grams(t, memo)
                if g is not None:
                    keep.append(r)
                    got.append(np.stack(np.unique(g, return_counts=True)).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([lang.take(pa.array(keep, pa.int64())), pa.array(got, pa.binary())], names=["lang", "v"])

    found = sample.mapInArrow(vectors, "lang string, v binary")
    got = found.orderBy("lang", "v").toArrow()
    langs = np.asarray(got.column("lang").to_pylist())
    packed = got.column("v").to_pylist()

    def dense(at: np.ndarray) -> np.ndarray:
        x = np.zeros((len(at), DIMS), dtype=np.float32)
        for r, k in enumerate(at):
            dims, c = np.frombuffer(packed[k], dtype="<u4").reshape(2, -1)
            v = np.log1p(c) * idf[dims]
            x[r, dims] = v / np.sqrt(v @ v)
        return x

    # one mean per language first: rows nearer to another language's mean are
    # taken for wrongly labelled and not learned from
    known = sorted(set(langs.tolist()))
    means = []
    for lang in known:
        mean = dense(np.flatnonzero(langs == lang)).sum(axis=0)
        means.append(mean / np.sqrt(mean @ mean))
    names, parts, reach = [], [], []
    for own_lang, lang in enumerate(known):
        x = dense(np.flatnonzero(langs == lang))
        right = (x @ np.stack(means).T).argmax(axis=1) == own_lang
        x = x[right] if right.any() else x
        c = spherical_kmeans(x, centroids)
        sims = x @ c.T
        own = sims.argmax(axis=1)
        for k in range(len(c)):
            mine = sims[own == k, k]
            names.append(lang)
            parts.append(c[k])
            reach.append(float(np.quantile(mine, 1 - ACCEPT)) if len(mine) else 1.0)
    return Model(idf, names, np.stack(parts), np.asarray(reach)) if parts else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
            reject: bool = True) -> DataFrame:
    """(doc_id, lang_pred, score, accepted) of every row; with ``reject``,
    texts outside every centroid's reach are ``und``."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = token_memo()
        for (ids,), texts in text_chunks(batches, limit=2 << 20):
            lang, score, fine = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), dtype=bool)
            for start in range(0, len(texts), 256):
                found = [grams(t, memo) if model else None for t in texts[start:start + 256]]
                at = [k for k, g in enumerate(found) if g is not None]
                if not at:
                    continue
                x = np.stack([np.bincount(found[k], minlength=DIMS) for k in at]).astype(np.float32)
                x = np.log1p(x) * model.idf
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                names, cos, ok = model.predict(x)
                for k, name, c, o in zip(at, names, cos, ok):
                    score[start + k], fine[start + k] = float(c), bool(o)
                    lang[start + k] = name if o or not reject else UNKNOWN
            yield pa.RecordBatch.from_arrays([ids, pa.array(lang), pa.array(score), pa.array(fine)],
                                             names=["doc_id", "lang_pred", "score", "accepted"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, lang_pred string, "
                                  "score double, accepted boolean")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    docs = pick(load(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    found = predict(docs, train(docs), reject=False)        # the contract wants a learned value for any letters
    return found.withColumn("held_out", crc_mod("doc_id", 4) == 2).select("doc_id", "held_out", "lang_pred", "score", "accepted")
