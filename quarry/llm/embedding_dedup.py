"""Operator 7, embedding near-duplicates with randomised-rotation codes.

Every distinct vector is scaled to unit length and turned by seeded random
rotations.  The signs of the turned components are its binary code; with the
code a correction factor f = <code, vector> is stored once per vector, so that
<code_x, y> / f_x is an unbiased estimate of <x, y> whose error is of the order
sqrt(1 / f^2 - 1) / sqrt(dimensions - 1).  Runs of code bits are also the keys
of the bucket tables in which pairs meet.  The number of bits grows with the
logarithm of the number of vectors (buckets stay of bounded mean size) and the
number of tables follows from the wanted recall at the threshold itself, so
closer pairs are found with far greater certainty.  A pair that meets in
several tables is worked on in the first one only.  If the estimate's upper
confidence bound is below the threshold the pair is dropped, else its cosine
is computed from the stored vectors in double precision.

Equal vectors are collapsed first and count with their multiplicity; tasks
emit link counts and a spanning forest, never pairs; large buckets are split
(``buckets.split_buckets``).

Edge cases: null or zero vectors and vectors with a null or non-finite
component link with nothing (their own component, no links); vectors of
different lengths never link; repeated ids are separate vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.buckets import Forest, pairs, split_buckets, whole_groups
from quarry.llm.common import bounded_batches, pick, written
from quarry.llm.components import components
from quarry.sources.tables import load

THRESHOLD = 0.95
#: chance to meet in some table of a pair exactly at the threshold
RECALL = 0.9995
#: standard errors that the confidence bound adds to an estimate
CONFIDENCE = 5.0
#: mean number of unrelated vectors per bucket aimed at
BUCKET_MEAN = 8
BUCKET_ROWS = 2048
SEED = 20_240_607


def plan(n: int, threshold: float, recall: float) -> tuple[int, int]:
    """Key bits and number of tables for n vectors."""
    bits = min(30, max(6, round(math.log2(max(n, 2) / BUCKET_MEAN))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - agree))


def rotation(dim: int, number: int) -> np.ndarray:
    """The ``number``-th random rotation of ``dim`` dimensions (seeded)."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dim, number]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Codes:
    """Rotations of one dimension and the codes they give."""

    def __init__(self, dim: int, bits: int, tables: int):
        self.dim, self.bits, self.tables = dim, bits, tables
        self.turns = [rotation(dim, k) for k in range(-(-bits * tables // dim))]

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """Bucket keys (rows, tables): consecutive runs of code bits."""
        signs = np.concatenate([unit @ t.T for t in self.turns], axis=1)[:, :self.bits * self.tables] > 0
        return signs.reshape(len(unit), self.tables, self.bits) @ (1 << np.arange(self.bits, dtype=np.int64))

    def signs(self, packed: pa.ChunkedArray) -> np.ndarray:
        """Stored codes as rows of +-1/sqrt(dim)."""
        bits = np.frombuffer(b"".join(packed.to_pylist()), dtype=np.uint8).reshape(len(packed), -1)
        return (np.unpackbits(bits, axis=1, count=self.dim) * 2.0 - 1) / math.sqrt(self.dim)

    def factors(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First rotation: turned vectors, codes (+-1/sqrt(dim)), factors."""
        turned = unit @ self.turns[0].T
        code = np.where(turned > 0, 1.0, -1.0) / math.sqrt(self.dim)
        return turned, code, (code * turned).sum(axis=1)


def unit_rows(raw: np.ndarray) -> np.ndarray:
    big = np.abs(raw).max(axis=1, keepdims=True)
    scaled = raw / big
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def clean_vectors(table: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, str]:
    """(vec_id, vec): components as little-endian bytes, null if unusable; and
    the numpy type of the components."""
    single = table.schema[vec_col].dataType.elementType == T.FloatType()
    kind = "<f4" if single else "<f8"
    source = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(1)
            size = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)       # a null component is a NaN
            ends = np.cumsum(size)
            starts = ends - size

            def number(which: np.ndarray) -> np.ndarray:
                total = np.append(0, np.cumsum(which))
                return total[ends] - total[starts]

            usable = (number(~np.isfinite(x)) == 0) & (number(x != 0) > 0)
            raw, wide = (x + 0.0).astype(kind).tobytes(), np.dtype(kind).itemsize        # -0.0 equals 0.0
            out = [raw[a:z] if ok else None for a, z, ok in zip((starts * wide).tolist(), (ends * wide).tolist(), usable.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["vec_id", "vec"])

    return source.mapInArrow(run, f"vec_id {source.schema['vec_id'].dataType.simpleString()}, vec binary"), kind


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype=kind).reshape(len(column), -1).astype(np.float64)


def by_dimension(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """The rows of every length of ``vec``, and their vectors."""
    sizes = pa.compute.binary_length(batch.column("vec")).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        b = batch.filter(pa.array(sizes == size))
        yield b, _matrix(b.column("vec"), kind)


def coded(distinct: DataFrame, kind: str) -> DataFrame:
    """``distinct`` with the code of every vector (the signs of the first
    rotation, packed) and its correction factor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Codes] = {}
        for batch in batches:
            for b, raw in by_dimension(batch, kind):
                dim = raw.shape[1]
                turned, _, f = codes.setdefault(dim, Codes(dim, 1, 1)).factors(unit_rows(raw))
                signs = [row.tobytes() for row in np.packbits(turned > 0, axis=1)]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(signs, pa.binary()), pa.array(f)],
                                                 names=[*b.schema.names, "code", "factor"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in distinct.schema.fields)
    return distinct.mapInArrow(run, fields + ", code binary, factor double")


def links(distinct: DataFrame, kind: str, n: int, threshold: float, recall: float,
          bucket_rows: int) -> DataFrame:
    """Rows (a, b, w): a spanning forest (b set) and link counts (b null), of
    the vectors of ``coded``."""
    bits, tables = plan(n, threshold, recall)
    carried = ["uid", "copies", "vec", "code", "factor"]

    def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Codes] = {}
        for batch in batches:
            for b, raw in by_dimension(batch, kind):
                dim = raw.shape[1]
                code = codes.setdefault(dim, Codes(dim, bits, tables))
                keys = code.keys(unit_rows(raw))
                # dimension, table and code bits make up the key
                keys |= (np.arange(tables, dtype=np.int64) << 30) | (np.int64(dim) << 44)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[:, t]), *[b.column(c) for c in carried]], names=["key", *carried])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, Codes] = {}
        for t, group in whole_groups(batches, 20_000):
            key, lo, hi, piece, uid, copies, factor = (t.column(c).to_numpy() for c in
                                                       ("key", "lo", "hi", "piece", "uid", "copies", "factor"))
            dims = key >> 44
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                code = codes.setdefault(int(dim), Codes(int(dim), bits, tables))
                unit = unit_rows(_matrix(t.column("vec").take(pa.array(at)), kind))
                turned = unit @ code.turns[0].T
                signs, f = code.signs(t.column("code").take(pa.array(at))), factor[at]
                keys = code.keys(unit)
                table = ((key[at] >> 30) & 0x3FFF).astype(np.int64)
                spread = CONFIDENCE * np.sqrt(np.maximum(1 / f ** 2 - 1, 0)) / math.sqrt(max(dim - 1, 1))
                forest = Forest(len(at))
                weight = np.zeros(len(at), dtype=np.int64)
                mult = copies[at]

                def test(i, j):
                    # in the first table where a pair meets, there only
                    met = (keys[i] == keys[j]).argmax(axis=1) == table[i]
                    i, j = i[met], j[met]
                    guess = np.einsum("ij,ij->i", signs[i], turned[j]) / f[i]
                    open_ = guess + spread[i] >= threshold
                    i, j = i[open_], j[open_]
                    linked = np.einsum("ij,ij->i", unit[i], unit[j]) >= threshold
                    i, j = i[linked], j[linked]
                    np.add.at(weight, i, mult[j])
                    np.add.at(weight, j, mult[i])
                    forest.add(i, j)

                pairs(group[at], lo[at], hi[at], piece[at], test, most=20_000)
                a, b = forest.edges()
                some = np.flatnonzero(weight)
                own = uid[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([own[a], own[some]])),
                     pa.array([*own[b].tolist(), *[None] * len(some)], pa.int64()),
                     pa.array(np.concatenate([np.zeros(len(a), dtype=np.int64), weight[some]]))], names=["a", "b", "w"])

    rows = distinct.select(*carried).mapInArrow(
        key_rows, "key long, uid long, copies long, vec binary, code binary, factor double")
    return split_buckets(rows, "uid", bucket_rows).mapInArrow(search, "a long, b long, w long")


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                    recall: float = RECALL, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    clean, kind = clean_vectors(table, id_col, vec_col)
    rows = written(clean, "vectors")
    classes = (rows.where("vec is not null").groupBy("vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
               .withColumn("uid", F.monotonically_increasing_id()))
    distinct = written(coded(classes, kind), "distinct")
    found = written(links(distinct, kind, distinct.count(), threshold, recall, bucket_rows), "links")
    label = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "uid")
    count = found.where("b is null").groupBy(F.col("a").alias("uid")).agg(F.sum("w").alias("others"))
    labelled = written(distinct.join(label, "uid", "left").join(count, "uid", "left")
                       .select("vec", F.coalesce("label", "uid").alias("label"), "least",
                               (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "labelled")
    least = written(labelled.groupBy("label").agg(F.min("least").alias("component_id")), "components")
    classes = written(labelled.join(least, "label").select("vec", "n_links", "component_id"), "classes")
    linked = rows.where("vec is not null").join(classes, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return near_duplicates(pick(load(spark, sf_dir, "embeddings"), "vec_id", "embedding"))
