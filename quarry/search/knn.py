"""Top-k search by an inverted file of trained centroids (C5).

The index: centroids are trained on a bounded sample of the vectors; every
vector goes to the cell of its nearest one.  Equal vectors are one entry with
their smallest ids first, so a group of copies, however large, is a row.

A search: a query looks into the cells of its nearest centroids, as many as a
planned share of the true neighbours needs (``planned_probes``: the neighbours
within the sample are known, so is the rank of their cells; the sample is
sparser than the table, which errs to the safe side).
Cells and their queries are cut into pieces, a task multiplies one piece of
vectors with one piece of queries as matrices and keeps the k best of each
query; those lists, not pairs, are merged (Spark drops all but the first k of
a query before the shuffle, too).

Exact mode adds a second look.  A vector of a cell is at most the cell's radius
(an angle) away from the centroid, so a cell can hold a better neighbour only if
the query's angle to the centroid less the radius is below that of its k-th
neighbour so far; all such cells are searched as well, no others.

Vectors that are null, hold null or non-finite numbers, are all zero, or have
not the usual length (the most frequent, the smaller of ties) are neither found
nor searched for.  A query's own row is no neighbour of it; ties go to the
smaller id; null ids are left out, repeated ids count as one row each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.catalog import query
from quarry.session import scratch_path
from quarry.sources.tables import load

K = 5
#: rows of the sample that the centroids are trained on, and their number
TRAIN_ROWS = 20_000
MOST_CELLS = 4096
#: share of the true neighbours that the number of searched cells is planned for
RECALL = 0.95
PLAN_QUERIES = 500
#: vectors and queries of one task's piece
PIECE, QUERY_PIECE = 20_000, 2_000
DIGITS = 6
STEP = 20


def _kept(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "knn", tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec): the vectors that can be compared, as doubles."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec")).where(
        "id is not null and vec is not null and size(vec) > 0 and exists(vec, x -> x <> 0D) "
        "and not exists(vec, x -> x is null or isnan(x) or abs(x) = double('Infinity'))")
    usual = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vec") == (usual.d if usual else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows of a list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(column)
    if not n:
        return np.empty((0, 0))
    x = pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(n, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)                            # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def planned_probes(sample: np.ndarray, centroids: np.ndarray, k: int, recall: float) -> int:
    """Nearest cells that hold a share ``recall`` of the k neighbours, for some
    vectors of the sample among all of it."""
    if len(sample) < 2:
        return 1
    own = (sample @ centroids.T).argmax(axis=1)
    ranks = []
    for s in range(0, min(PLAN_QUERIES, len(sample)), 100):
        at = np.arange(s, min(s + 100, PLAN_QUERIES, len(sample)))
        sims = sample[at] @ sample.T
        sims[np.arange(len(at)), at] = -2
        near = np.argsort(-sims, axis=1)[:, :k]
        place = np.argsort(np.argsort(-(sample[at] @ centroids.T), axis=1, kind="stable"), axis=1, kind="stable")
        ranks.append(np.take_along_axis(place, own[near], axis=1).ravel())
    return int(np.quantile(np.concatenate(ranks), recall, method="higher")) + 1


def train(entries: DataFrame, cells: int, k: int, rows: int = TRAIN_ROWS, recall: float = RECALL, rounds: int = 12) -> tuple[np.ndarray, int]:
    """Spherical k-means over about ``rows`` entries, chosen by their hash, and
    the cells to search for the planned recall."""
    n = entries.count()
    share = int(min(1.0, rows / max(n, 1)) * (1 << 31))
    sample = matrix(entries.where(F.pmod("eid", F.lit(1 << 31)) <= share).select("eid", "vec").orderBy("eid").toArrow().column("vec"))
    if not len(sample):
        return sample, 1
    c = sample[np.random.default_rng(1).permutation(len(sample))[:cells]]
    for _ in range(rounds):
        own = (sample @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, sample)
        norm = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        c = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), c)
    return c, planned_probes(sample, c, k, recall)


class InvertedFile:
    """Entries of distinct vectors by cell, on disk; ``radius``: the greatest
    angle between a centroid and a vector of its cell."""

    def __init__(self, vectors: DataFrame, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
                 cells: int | None = None, train_rows: int = TRAIN_ROWS, recall: float = RECALL):
        self.spark, self.k = vectors.sparkSession, k
        rows = usable(vectors, id_col, vec_col)
        rows = self.rows = _kept(rows.withColumn("eid", F.xxhash64("vec")), "rows")
        first = F.row_number().over(Window.partitionBy("eid", "vec").orderBy("id"))
        entries = _kept(rows.withColumn("at", first).where(F.col("at") <= k + 1).groupBy("eid", "vec")
                        .agg(F.sort_array(F.collect_list("id")).alias("ids")), "entries")       # k + 1 ids at most
        n = entries.count()
        self.centroids, self.probes = train(entries, cells or min(MOST_CELLS, max(1, math.isqrt(n))), k, train_rows, recall)
        shared = self.spark.sparkContext.broadcast(self.centroids)

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    sims = matrix(b.column(1)) @ shared.value.T
                    cell = sims.argmax(axis=1)
                    angle = np.arccos(np.clip(sims[np.arange(len(cell)), cell], -1, 1))
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(angle)],
                                                     names=["eid", "vec", "ids", "cell", "angle"])

        self.entries = _kept(entries.select("eid", "vec", "ids").mapInArrow(
            assign, "eid long, vec array<double>, ids array<long>, cell int, angle double"), "cells")
        stats = self.entries.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).collect()
        self.size = {r.cell: r.n for r in stats}                            # at most MOST_CELLS rows
        self.radius = np.full(len(self.centroids), -1.0)
        for r in stats:
            self.radius[r.cell] = r.radius

    def _pieces(self) -> DataFrame:
        return self.spark.createDataFrame([(c, -(-n // PIECE)) for c, n in self.size.items()], "cell int, pieces int")

    def _search(self, queries: DataFrame) -> DataFrame:
        """(q, sim, id): the first k + 1 ids for rows (q, vec, cell)."""
        k, pieces = self.k + 1, F.broadcast(self._pieces())                 # a row per cell
        left = (self.entries.join(pieces, "cell").withColumn("piece", F.pmod("eid", "pieces").cast("int"))
                .select("cell", "piece", "vec", "ids"))
        per_cell = queries.groupBy("cell").agg(F.count("*").alias("asked"))
        asked = (queries.join(F.broadcast(per_cell), "cell").join(pieces, "cell")
                 .withColumn("block", F.pmod(F.xxhash64("q"), F.ceil(F.col("asked") / QUERY_PIECE)).cast("int")))
        blocks = F.broadcast(per_cell.select("cell", F.ceil(F.col("asked") / QUERY_PIECE).alias("blocks")))
        left = left.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))).drop("blocks")
        right = asked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).select("cell", "piece", "block", "q", "vec")
        key = ["cell", "piece", "block"]

        def best(entries: pa.Table, asked: pa.Table) -> pa.Table:
            q = asked.column("q").to_numpy() if asked.num_rows else np.empty(0, np.int64)
            if not entries.num_rows or not len(q):
                return pa.table({"q": pa.array([], pa.int64()), "sim": pa.array([], pa.float64()), "id": pa.array([], pa.int64())})
            x, y = matrix(asked.column("vec")), matrix(entries.column("vec"))
            ids = entries.column("ids").combine_chunks()
            ends = ids.offsets.to_numpy().astype(np.int64)
            flat = pc.list_flatten(ids).to_numpy()
            ends = ends - ends[0]
            out_q, out_sim, out_id = [], [], []
            for s in range(0, len(q), 256):
                sims = np.round(x[s:s + 256] @ y.T, DIGITS) + 0.0
                keep = min(k, sims.shape[1])
                floor = -np.partition(-sims, keep - 1, axis=1)[:, keep - 1]
                row, col = np.nonzero(sims >= floor[:, None])               # ties of the last one too
                n = (ends[1:] - ends[:-1])[col]
                at = np.repeat(ends[col] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                row, sim, id_ = np.repeat(row, n), np.repeat(sims[row, col], n), flat[at]
                order = np.lexsort((id_, -sim, row))
                row, sim, id_ = row[order], sim[order], id_[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                ok = place < k
                out_q.append(q[s + row[ok]])
                out_sim.append(sim[ok])
                out_id.append(id_[ok])
            return pa.table({"q": np.concatenate(out_q), "sim": np.concatenate(out_sim), "id": np.concatenate(out_id)})

        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(best, "q long, sim double, id long")
        return self._first(found)

    def _first(self, found: DataFrame) -> DataFrame:
        order = Window.partitionBy("q").orderBy(F.desc("sim"), "id")
        return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= self.k + 1).drop("place")

    def _cells(self, queries: DataFrame, probes: int) -> DataFrame:
        """(q, vec, cell) for the ``probes`` nearest cells, with rows (q, vec,
        floor) for all further ones that can hold an angle below ``floor``."""
        radius, shared = self.radius, self.spark.sparkContext.broadcast(self.centroids)
        schema = "q long, vec array<double>, cell int"

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for s in range(0, b.num_rows, 256):
                    part = b.slice(s, 256)
                    angle = np.arccos(np.clip(matrix(part.column(1)) @ shared.value.T, -1, 1))
                    angle[:, radius < 0] = np.inf                           # empty cells
                    near = np.zeros(angle.shape, dtype=bool)
                    nearest = np.argsort(angle, axis=1, kind="stable")[:, :probes]
                    np.put_along_axis(near, nearest, True, axis=1)
                    if part.num_columns == 3:
                        floor = part.column(2).to_numpy()
                        near = ~near & (angle - radius[None, :] <= floor[:, None])
                    row, cell = np.nonzero(near & np.isfinite(angle))
                    at = pa.array(row)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(cell.astype(np.int32))],
                                                     names=["q", "vec", "cell"])

        return queries.mapInArrow(look, schema)

    def search(self, wanted, probes: int | None = None, exact: bool = False) -> DataFrame:
        """(query_id, rank, neighbour_id, cosine): the k nearest other rows of
        every indexed row for which the condition ``wanted`` on ``id`` holds."""
        asked = self.rows.where(wanted)
        queries = _kept(asked.groupBy(F.col("eid").alias("q"), "vec").agg(F.count("*").alias("n")).select("q", "vec"), "queries")
        probes = probes or self.probes
        found = _kept(self._search(_kept(self._cells(queries, probes), "probes")), "found")
        if exact:
            worst = found.groupBy("q").agg(F.when(F.count("*") > self.k, F.min("sim")).otherwise(-1.0).alias("sim"))
            # half a unit of the last digit: sims are rounded
            floor = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce("sim", F.lit(-1.0)) - 10.0 ** -DIGITS))) + 1e-7
            more = queries.join(worst, "q", "left").select("q", "vec", floor.alias("floor"))
            found = _kept(self._first(found.unionByName(self._search(_kept(self._cells(more, probes), "more")))), "all")
        others = (asked.select(F.col("id").alias("query_id"), F.col("eid").alias("q")).join(found, "q")
                  .where("query_id <> id"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("sim"), "id"))
        return (others.withColumn("rank", rank.cast("long")).where(F.col("rank") <= self.k)
                .select("query_id", "rank", F.col("id").alias("neighbour_id"), F.col("sim").alias("cosine")))


@query("knn_vectors")
def knn_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every 20th vector, by the inverted file: recall 0.9 and
    more (measured in the tests against all pairs)."""
    return InvertedFile(load(spark, sf_dir, "embeddings"), K).search(f"id % {STEP} = 0")


EXACT_SQL = f"""
WITH v AS (
  SELECT CAST(vec_id AS BIGINT) AS id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
usual AS (SELECT len(e) AS d FROM v GROUP BY d ORDER BY COUNT(*) DESC, d LIMIT 1),
u AS (SELECT v.* FROM v JOIN usual ON len(v.e) = usual.d),
pairs AS (
  SELECT q.id AS query_id, u.id AS neighbour_id, round(list_cosine_similarity(q.e, u.e), {DIGITS}) + 0.0 AS cosine
  FROM u q JOIN u ON q.id <> u.id WHERE q.id % {STEP} = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, neighbour_id) AS rank, neighbour_id, cosine
FROM pairs QUALIFY rank <= {K}
"""


@query("knn_exact", oracle=EXACT_SQL)
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same without error: cells that can hold a nearer vector are searched too."""
    return InvertedFile(load(spark, sf_dir, "embeddings"), K).search(f"id % {STEP} = 0", exact=True)
