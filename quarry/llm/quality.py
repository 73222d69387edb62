"""Operator 1, quality: positive-unlabelled learning on text statistics.

Trusted positives are the learning rows labelled 1; the unlabelled set is a
hash sample of web text whose labels are not looked at.  Texts are described
by statistics of their whole content (repetition, symbols, letter case, digits,
line structure, word shapes), each cut into quantile bins.  A first classifier
of positives against unlabelled text gives the class prior: the least ratio of
the unlabelled to the positive share above a score, with a confidence margin
(best-bin estimate).  The model then minimises the non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the logistic loss; where the second part turns negative, its gradient is
reversed, which keeps the fit from explaining unlabelled positives away.

Both samples are bounded in rows: a labelled id counts once, and unlabelled
rows are diced by id and text, equal ones counting once.

The weights (a few hundred numbers) go to the tasks that score; scoring is one
scan of whole texts without a shuffle.

Edge cases: null and empty texts have all statistics zero and are scored like
any other; without positives every score is 0, without unlabelled text the
prior; repeated rows are scored each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, crc_mod, hash_sample, pick, text_chunks
from quarry.llm.labelled import FOLDS, labelled_sample
from quarry.sources.tables import load

#: bounds on the rows of the fit
POSITIVE_ROWS = 10_000
UNLABELLED_ROWS = 30_000
BINS = 16
STEPS = 1000
RATE = 0.2
DECAY = 3e-6

_CLASS = np.zeros(256, dtype=np.uint8)     # 0 other letters (UTF-8 bytes too)
_CLASS[[9, 10, 11, 12, 13, 32]] = 1
_CLASS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 2
_CLASS[48:58] = 3
_CLASS[65:91] = 4
_CLASS[[ord(c) for c in ".,;:'\"()?-"]] = 5
_SHOUT = re.compile(r"[!?]{2,}")

STATISTICS = ("words", "mean_word", "distinct", "top_word", "same_next", "symbols", "digits", "capitals", "marks",
              "lines", "line_words", "repeated_lines", "wordless", "symbol_end", "sentence_end", "long_words",
              "shouts", "upper_words", "bigrams")


def statistics(text: str | None) -> list[float]:
    """Numbers that describe the whole text (all zero for an empty one)."""
    ws = text.split() if text else []
    n = len(ws)
    if not n:
        return [0.0] * len(STATISTICS)
    raw = text.encode()
    kinds = np.bincount(_CLASS[np.frombuffer(raw, dtype=np.uint8)], minlength=6)
    solid = max(1, len(raw) - int(kinds[1]))
    tally = Counter(ws)
    lines = [x for x in text.split("\n") if x]
    seen = len(set(lines))
    same = sum(map(str.__eq__, ws, ws[1:]))
    ends = Counter([w[-1] for w in ws])
    symbol_end = sum(c for ch, c in ends.items() if not ch.isalnum() and ch not in ".,;:'\")?-")
    stop_end = sum(ends[ch] for ch in ".!?")
    wordless = sum(c for w, c in tally.items() if not any(map(str.isalnum, w)))
    long_words = sum(c for w, c in tally.items() if len(w) > 20)
    upper = sum(c for w, c in tally.items() if len(w) > 1 and w.isupper())
    return [np.log1p(n), solid / n, len(tally) / n ** 0.8, max(tally.values()) / n, same / n,
            kinds[2] / solid, kinds[3] / solid, kinds[4] / solid, kinds[5] / solid,
            len(lines) / n, n / max(1, len(lines)), 1 - seen / max(1, len(lines)), wordless / n,
            symbol_end / n, stop_end / n, long_words / n, len(_SHOUT.findall(text)) / n, upper / n,
            len(set(zip(ws, ws[1:]))) / n]


def describe(docs: DataFrame, id_col: str | None, text_col: str, others: list[str] = ()) -> DataFrame:
    """Other columns and the statistics of every text."""
    keep = ([F.col(f"`{id_col}`").alias("doc_id")] if id_col else []) + [F.col(c) for c in others]
    source = docs.select(*keep, F.col(f"`{text_col}`").cast("string").alias("text"))
    names = source.columns[:-1]
    schema = ", ".join([f"`{n}` {source.schema[n].dataType.simpleString()}" for n in names] + ["x array<float>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols, texts in text_chunks(batches):
            x = pa.array([statistics(t) for t in texts], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([*cols, x], names=[*names, "x"])

    return source.mapInArrow(run, schema)


class Binner:
    """Quantile bins per statistic, as indices into one weight vector."""

    def __init__(self, x: np.ndarray, bins: int):
        marks = np.linspace(0, 1, bins + 1)[1:-1]
        # the tails hold the junk: finer cuts there
        marks = np.unique(np.concatenate([marks, [0.005, 0.01, 0.02, 0.04, 0.96, 0.98, 0.99, 0.995]]))
        self.cuts = [np.unique(np.quantile(x[:, k], marks)) for k in range(x.shape[1])]
        self.base = np.concatenate([[0], np.cumsum([len(c) + 1 for c in self.cuts])])
        self.width = int(self.base[-1])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.stack([self.base[k] + np.searchsorted(c, x[:, k], side="left")
                         for k, c in enumerate(self.cuts)], axis=1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, width: int, prior: float, steps: int) -> tuple[np.ndarray, float]:
    """Weights by Adam on the non-negative risk; rows are bin indices."""
    w, b = np.zeros(width), 0.0
    m = np.zeros(width + 1)
    v = np.zeros(width + 1)

    def grad(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
        per = np.bincount(rows.ravel(), weights=np.repeat(r, rows.shape[1]), minlength=width)
        return np.append(per, r.sum())

    def softplus(z):
        return np.logaddexp(0, z)

    for step in range(1, steps + 1):
        zp, zu = w[pos].sum(1) + b, w[unl].sum(1) + b
        g_plus = grad(pos, prior * (_sigmoid(zp) - 1) / len(pos))
        negative = softplus(zu).mean() - prior * softplus(zp).mean()
        g_minus = grad(unl, _sigmoid(zu) / len(unl)) - grad(pos, prior * _sigmoid(zp) / len(pos))
        g = g_plus + g_minus if negative >= 0 else -g_minus
        g[:-1] += 2 * DECAY * w
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        change = RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - change[:-1], b - change[-1]
    return w, float(b)


def estimate_prior(pos_score: np.ndarray, unl_score: np.ndarray) -> float:
    """Least upper bound, over score thresholds, of the positives' share in
    the unlabelled set; thresholds that keep few positives get a margin."""
    cuts = np.quantile(pos_score, np.linspace(0.0, 0.98, 99))
    share_p = np.asarray([(pos_score >= c).mean() for c in cuts])
    share_u = np.asarray([(unl_score >= c).mean() for c in cuts])
    margin = 0.5 * (np.sqrt(np.log(400) / len(pos_score)) + np.sqrt(np.log(400) / len(unl_score)))
    at = int(np.argmin((share_u + margin) / share_p))
    return float(np.clip(share_u[at] / share_p[at], 0.01, 0.99))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", positive_rows: int = POSITIVE_ROWS,
          unlabelled_rows: int = UNLABELLED_ROWS, id_col: str = "doc_id", text_col: str = "text"):
    """(binner, weights, bias, class prior), or a constant score (float)."""
    positive = labelled_sample(docs, labels, label, positive_rows, only=1, id_col=id_col, text_col=text_col)
    learning = docs.where(F.col(f"`{id_col}`").isNotNull() & (crc_mod(id_col, FOLDS) != 0))
    web = describe(hash_sample(learning, [id_col, text_col], unlabelled_rows, 11), id_col, text_col).distinct()
    get = lambda df: np.asarray(df.select("x").toArrow().column("x").to_pylist(), dtype=np.float32)
    xp, xu = get(describe(positive, None, "text")), get(web.orderBy("doc_id", "x"))
    if not len(xp):
        return 0.0
    if not len(xu):
        return 0.5
    bins = Binner(np.concatenate([xp, xu]), BINS)
    pos, unl = bins(xp), bins(xu)
    # halves: one to train the prior's classifier, one to read the prior off
    half_p, half_u = len(pos) // 2, len(unl) // 2
    prior = 0.5
    if half_p and half_u:
        w, b = fit_nnpu(pos[:half_p], unl[:half_u], bins.width, 0.5, STEPS // 3)
        prior = estimate_prior(w[pos[half_p:]].sum(1) + b, w[unl[half_u:]].sum(1) + b)
    w, b = fit_nnpu(pos, unl, bins.width, prior, STEPS)
    return bins, w, b, prior


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), texts in text_chunks(batches):
            if isinstance(model, float):
                s = np.full(len(texts), model)
            else:
                bins, w, b, _ = model
                s = _sigmoid(w[bins(np.asarray([statistics(t) for t in texts], dtype=np.float32))].sum(1) + b)
            yield pa.RecordBatch.from_arrays([ids, pa.array(s, pa.float64())], names=["doc_id", "score"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double")


def op1_quality(spark: SparkSession, sf_dir: str, threshold: float = 0.3) -> DataFrame:
    bounded_batches(spark)
    docs = pick(load(spark, sf_dir, "documents"), "doc_id", "text")
    model = train(docs, load(spark, sf_dir, "labels"))
    return (score(docs, model).withColumn("held_out", crc_mod("doc_id", FOLDS) == 0)
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "held_out", "score", "predicted"))
