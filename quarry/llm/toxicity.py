"""Operator 10, toxicity: a counterfactually regularised linear classifier.

Features of a text are its distinct words and their prefixes of four to six
characters, so that inflected forms share evidence.  The features that tell
the classes apart best are chosen by a two-proportion z score over the
labelled sample; a sparse logistic model is fitted on them.  For the
counterfactual part, identity terms in labelled sentences are swapped for
other terms (and neutral mentions inserted where a sentence has none): the
fit penalises the squared change of the score between the two versions, so
that a group's mere mention carries no weight.  Terms whose own features would
stay unseen are always in the model.

Only weights (bounded by ``features``) reach the tasks that score; scoring is
one scan of whole texts without a shuffle.

Edge cases: null texts score as empty ones (the bias alone); without any
learnable label, or with one class only, the score is that class's share; ids
and repeated rows are passed through as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import (
    Memo, bounded_batches, crc_mod, ddl, hash_sample, pick, stable_hash, text_chunks, text_last, token_words, words, written,
)
from quarry.llm.labelled import labelled_sample
from quarry.sources.tables import load

#: bound on the labelled rows of the fit
TRAIN_ROWS = 20_000
FEATURES = 8_192
MIN_DOCS = 3
L1 = 2e-4
L2 = 1e-5
COUNTERFACTUAL = 1.0
#: bound on the different counterfactual changes of the fit
COUNTERFACTUAL_ROWS = 200_000
STEPS = 400
#: one in this many sentences without an identity term gets a mention inserted
INSERT_EVERY = 16

# Identity terms, by language (en, de, fr, es).
IDENTITY_TERMS = (
    "women", "men", "woman", "man", "girls", "boys", "muslims", "muslim", "jews", "jewish", "christians", "christian",
    "hindus", "hindu", "buddhists", "atheists", "catholics", "blacks", "black", "whites", "white", "asians", "asian",
    "africans", "african", "mexicans", "latinos", "arabs", "arab", "gays", "gay", "lesbians", "lesbian", "transgender",
    "bisexual", "queer", "straight", "immigrants", "refugees", "foreigners", "disabled", "blind", "deaf", "elderly",
    "teenagers", "americans", "chinese", "indians", "russians", "germans", "french", "spanish",
    "frauen", "männer", "muslime", "juden", "christen", "schwarze", "weiße", "schwule", "lesben", "ausländer",
    "flüchtlinge", "behinderte", "alte",
    "femmes", "hommes", "musulmans", "juifs", "chrétiens", "noirs", "blancs", "homosexuels", "lesbiennes", "étrangers",
    "réfugiés", "handicapés",
    "mujeres", "hombres", "musulmanes", "judíos", "cristianos", "negros", "blancos", "homosexuales", "lesbianas",
    "extranjeros", "refugiados", "discapacitados",
)


def word_features(word: str) -> tuple[int, ...]:
    """Hashes of a word and of its prefixes."""
    got = [stable_hash("=" + word)]
    got += [stable_hash(word[:k]) for k in (4, 5, 6) if len(word) >= k]
    return tuple(got)


def text_features(ws: list[str], memo: Memo) -> set[int]:
    found: set[int] = set()
    for w in set(ws):
        found.update(memo[w])
    return found


def _term_features() -> list[int]:
    return sorted({f for t in IDENTITY_TERMS for f in word_features(t)})


def choose_features(sample: DataFrame, n_pos: int, n_neg: int, most: int, min_docs: int) -> list[int]:
    """The features of largest z score, counted over the whole sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(word_features)
        tally: dict[tuple[int, int], int] = {}

        def batch():
            keys = list(tally)
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.int64()),
                 pa.array([n if k[1] else 0 for k, n in tally.items()], pa.int64()),
                 pa.array([0 if k[1] else n for k, n in tally.items()], pa.int64())], names=["f", "pos", "neg"])

        for (label,), texts in text_chunks(batches):
            for y, t in zip(label.to_pylist(), texts):
                for f in text_features(words(t), memo):
                    key = (f, int(y == 1))
                    tally[key] = tally.get(key, 0) + 1
                if len(tally) > 200_000:
                    yield batch()
                    tally.clear()
        yield batch()

    counts = (sample.mapInArrow(count, "f long, pos long, neg long").groupBy("f")
              .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).where(F.col("pos") + F.col("neg") >= min_docs))
    p, q = F.col("pos") / max(n_pos, 1), F.col("neg") / max(n_neg, 1)
    pooled = (F.col("pos") + F.col("neg")) / (n_pos + n_neg)
    z = F.abs(p - q) / F.sqrt(pooled * (1 - pooled) * (1 / max(n_pos, 1) + 1 / max(n_neg, 1)) + 1e-12)
    top = counts.orderBy(z.desc(), "f").limit(most).select("f").collect()
    return sorted({r.f for r in top} | set(_term_features()))


def _swap(ws: list[str], at: int) -> list[str]:
    """The sentence with another identity term in place of word ``at``."""
    pick_one = stable_hash(" ".join(ws)) % len(IDENTITY_TERMS)
    other = IDENTITY_TERMS[pick_one]
    if other == ws[at]:
        other = IDENTITY_TERMS[(pick_one + 1) % len(IDENTITY_TERMS)]
    return [*ws[:at], other, *ws[at + 1:]]


def counterfactuals(text: str) -> Iterator[tuple[list[str], list[str]]]:
    """Sentences of the text and their versions with a term swapped or, where
    there is none, a neutral mention added (every INSERT_EVERY-th by hash)."""
    terms = set(IDENTITY_TERMS)
    for line in text.replace("!", ".").replace("?", ".").replace("\n", ".").split("."):
        ws = words(line)
        if not ws:
            continue
        hits = [k for k, w in enumerate(ws) if w in terms]
        for k in hits:
            yield ws, _swap(ws, k)
        if not hits and (h := stable_hash(line)) % INSERT_EVERY == 0:
            yield ws, [*ws, IDENTITY_TERMS[h // INSERT_EVERY % len(IDENTITY_TERMS)]]


def training_rows(sample: DataFrame, chosen: list[int]) -> DataFrame:
    """Rows of the fit: kind 0/1: a text's chosen features with its label;
    kind 2: what a counterfactual version of a sentence adds (feature + 1) and
    takes away (-(feature + 1))."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {f: k for k, f in enumerate(chosen)}
        memo = Memo(word_features)
        for (label,), texts in text_chunks(batches):
            kinds, feats = [], []
            for y, t in zip(label.to_pylist(), texts):
                kinds.append(int(y == 1))
                feats.append([place[f] for f in text_features(words(t), memo) if f in place])
                for a, b in counterfactuals(t):
                    fa, fb = text_features(a, memo), text_features(b, memo)
                    diff = sorted([place[f] + 1 for f in fb - fa if f in place] + [-place[f] - 1 for f in fa - fb if f in place])
                    if diff:
                        kinds.append(2)
                        feats.append(diff)
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(feats, pa.list_(pa.int32()))], names=["kind", "f"])

    return sample.mapInArrow(rows, "kind int, f array<int>")


def fit_rows(sample: DataFrame, chosen: list[int], most: int) -> DataFrame:
    """``training_rows`` with equal counterfactual changes as one row (``n`` of
    them), of which about ``most`` are chosen by hash if there are more."""
    rows = written(training_rows(sample, chosen), "fit_rows")
    changes = written(rows.where("kind = 2").groupBy("f").agg(F.count("*").alias("n")), "changes")
    return rows.where("kind < 2").select("kind", "f", F.lit(1).cast("long").alias("n")).unionByName(
        hash_sample(changes, ["f"], most, 5).select(F.lit(2).alias("kind"), "f", "n").orderBy("f"))


class Sparse:
    """Rows of (feature, value) lists as flat arrays; ``mass`` rows in all."""

    def __init__(self, lists: list[np.ndarray], values: list[np.ndarray] | None, width: int, mass: int | None = None):
        self.n, self.width = len(lists), width
        self.mass = self.n if mass is None else mass
        sizes = np.asarray([len(x) for x in lists], dtype=np.int64)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.col = np.concatenate(lists).astype(np.int64) if len(lists) else np.empty(0, dtype=np.int64)
        self.val = np.concatenate(values).astype(float) if values else np.ones(len(self.col))

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.col] * self.val, minlength=self.n)

    def t_dot(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, weights=r[self.row] * self.val, minlength=self.width)


def fit(x: Sparse, y: np.ndarray, cf: Sparse, l1: float, l2: float, counterfactual: float, steps: int) -> tuple[np.ndarray, float]:
    """Balanced logistic loss + l1 |w| + l2 |w|^2 + counterfactual * mean
    squared score change, by accelerated proximal gradient steps."""
    n_pos = y.sum()
    weight = np.where(y == 1, 0.5 / n_pos, 0.5 / (len(y) - n_pos))
    # features weigh alike in the step: a bound on the curvature from row sums
    sizes = np.bincount(x.row, minlength=x.n) + 1
    lip = 0.25 * float((weight * sizes).sum()) + 2 * l2
    if cf.n:
        lip += 2 * counterfactual * float((np.bincount(cf.row, weights=cf.val ** 2, minlength=cf.n)).sum() / cf.mass)
    step = 1 / lip
    w, b = np.zeros(x.width), 0.0
    vw, vb, t = w, b, 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x.dot(vw) + vb, -30, 30)))
        r = weight * (p - y)
        gw, gb = x.t_dot(r) + 2 * l2 * vw, r.sum()
        if cf.n:
            gw = gw + 2 * counterfactual / cf.mass * cf.t_dot(cf.dot(vw))
        nw = vw - step * gw
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * l1, 0)
        nb = vb - step * gb
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, float(b)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", train_rows: int = TRAIN_ROWS,
          features: int = FEATURES, min_docs: int = MIN_DOCS, l1: float = L1, l2: float = L2,
          counterfactual: float = COUNTERFACTUAL, steps: int = STEPS,
          counterfactual_rows: int = COUNTERFACTUAL_ROWS) -> tuple[dict[int, float], float]:
    """Weights by feature hash (non-zero ones) and the bias."""
    sample = labelled_sample(docs, labels, label, train_rows)
    size = {r.label: r.n for r in sample.groupBy((F.col("label") == 1).cast("int").alias("label")).agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = size.get(1, 0), size.get(0, 0)
    if not n_pos or not n_neg:
        share = n_pos / max(n_pos + n_neg, 1)
        return {}, math.log((share + 1e-3) / (1 - share + 1e-3))
    chosen = choose_features(sample, n_pos, n_neg, features, min_docs)
    got = fit_rows(sample, chosen, counterfactual_rows).toArrow()
    kind = got.column("kind").to_numpy()
    lists = [np.asarray(v, dtype=np.int64) for v in got.column("f").to_pylist()]
    rows = [v for k, v in zip(kind, lists) if k < 2]
    swaps = [v for k, v in zip(kind, lists) if k == 2]
    times = got.column("n").to_numpy()[kind == 2]
    x = Sparse(rows, None, len(chosen))
    cf = Sparse([np.abs(v) - 1 for v in swaps], [np.sign(v) * root for v, root in zip(swaps, np.sqrt(times))], len(chosen), int(times.sum()))
    w, b = fit(x, (kind[kind < 2] == 1).astype(float), cf, l1, l2, counterfactual, steps)
    return {chosen[k]: float(w[k]) for k in np.flatnonzero(w)}, b


def score(docs: DataFrame, model: tuple[dict[int, float], float], text_col: str = "text", out: str = "score",
          keep_text: bool = False) -> DataFrame:
    """All columns (the text only if asked for) and the score of every row;
    one scan, whole texts."""
    weights, bias = model
    source, others = text_last(docs, text_col)
    names = [f.name for f in others] + [text_col] * keep_text + [out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(lambda token: tuple(f for w in token_words(token) for f in word_features(w) if f in weights))
        for cols, texts in text_chunks(batches):
            got = []
            for t in texts:
                found = set().union(*filter(None, map(memo.__getitem__, t.split()))) if t else ()
                logit = bias + sum(weights[f] for f in sorted(found))
                got.append(1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))))
            text = [pa.array(texts, pa.string())] * keep_text
            yield pa.RecordBatch.from_arrays([*cols, *text, pa.array(got, pa.float64())], names=names)

    return source.mapInArrow(run, ddl(source.schema.fields if keep_text else others) + f", `{out}` double")


def op10_toxicity(spark: SparkSession, sf_dir: str, threshold: float = 0.5) -> DataFrame:
    bounded_batches(spark)
    docs = pick(load(spark, sf_dir, "documents"), "doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels"))
    return (score(docs, model).withColumn("held_out", crc_mod("doc_id", 5) == 0)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "held_out", "score", "predicted"))
