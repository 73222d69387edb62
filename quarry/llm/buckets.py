"""Bucketed pair search: groups of rows that share a key are compared inside
tasks, without emitting pairs; a bucket above a size is split into pieces and
every pair of pieces becomes a task group of its own, so that memory stays
bounded and no bucket, however large, has to be worked off by one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


def split_buckets(rows: DataFrame, member: str, size: int) -> DataFrame:
    """``rows`` (column ``key``, unique per (key, member)) of buckets with at
    least two rows, sorted for ``pairs``: columns key, lo, hi, piece first.

    A bucket of n rows has ceil(n / size) pieces; a row goes to the groups
    (lo, hi) of its piece with every other.  Two rows of different pieces meet
    in one group, two rows of one piece in the group (piece, piece).

    The counts are a table of their own: a join with an aggregate below it is
    one that Spark does not split, so a hot key would reach one task whole."""
    counts = written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    n = F.expr(f"cast(ceil(n / {size}) as int)")
    piece = F.pmod(F.xxhash64(member), F.col("pieces")).cast("int")
    others = [c for c in rows.columns if c != "key"]
    out = (rows.join(counts, "key").withColumn("pieces", n).withColumn("piece", piece)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
           .select("key", F.least("piece", "other").alias("lo"), F.greatest("piece", "other").alias("hi"),
                   "piece", *others))
    return out.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")


def whole_groups(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about ``rows`` rows that hold whole (key, lo, hi) groups, and
    the group number of each row."""
    held: list[pa.Table] = []
    n = 0

    def numbered(t: pa.Table) -> np.ndarray:
        k, lo, hi = (t.column(c).to_numpy() for c in ("key", "lo", "hi"))
        new = (k[1:] != k[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
        return np.append(0, np.cumsum(new))

    for b in batches:
        if not b.num_rows:
            continue
        held.append(pa.Table.from_batches([b]))
        n += b.num_rows
        if n >= rows:
            t = pa.concat_tables(held).combine_chunks()
            g = numbered(t)
            cut = int(np.searchsorted(g, g[-1]))
            if cut:
                yield t.slice(0, cut).combine_chunks(), g[:cut]
            held = [t.slice(cut)]
            n = t.num_rows - cut
    if n:
        t = pa.concat_tables(held).combine_chunks()
        yield t, numbered(t)


class Forest:
    """Union-find over row numbers, fed with arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            ra, rb = root[a], root[b]
            open_ = ra != rb
            a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        a = np.flatnonzero(self.root != np.arange(len(self.root)))
        return a, self.root[a]


def pairs(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, piece: np.ndarray,
          test: Callable[[np.ndarray, np.ndarray], None], most: int = 200_000) -> None:
    """Call ``test(i, j)`` for the row pairs of every group, in runs of at
    most ``most`` pairs (in a group of two pieces: pairs across them)."""
    n = len(group)
    at = np.flatnonzero(group[:-1] == group[1:]) if n > 1 else np.empty(0, dtype=np.int64)
    lag = 1
    while len(at):
        i = at[(lo[at] == hi[at]) | (piece[at] != piece[at + lag])]
        for s in range(0, len(i), most):
            test(i[s:s + most], i[s:s + most] + lag)
        lag += 1
        at = at[at + lag < n]
        at = at[group[at] == group[at + lag]]
