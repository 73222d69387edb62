"""Operator 4, SimHash near-duplicates through pivot distance tables.

Every distinct fingerprint gets its Hamming distances to 65 reference
fingerprints: the zero word and, for each of seven blocks of bits, the growing
prefixes of the block.  By |d(x,p) - d(y,p)| <= d(x,y) two fingerprints within
``bits`` of each other differ by at most ``bits`` in every coordinate.  Random
references alone give no key to join on; these references do: four differing
bits touch at most four of the seven blocks, so in at least three blocks all
coordinates (taken relative to the zero reference) agree exactly.  Each
choice of three blocks is therefore one bucket table (35 in all); inside a
bucket pairs with too large a maximum coordinate difference are discarded and
survivors verified by the bit count of their XOR.  No link is lost.

Equal fingerprints are collapsed before the search, tasks emit a spanning
forest of each bucket and never its pairs, and buckets above a size are split
(``buckets.split_buckets``).  Work per bucket table grows with the square of
the bucket, so ``blocks`` should grow with the corpus (seven blocks: keys of
27 bits; more blocks: longer keys and more tables).

Edge cases: null and word-free texts have fingerprint zero and link like any
other; repeated rows share a fingerprint; a null id never becomes a component
id unless the whole component has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.buckets import Forest, pairs, split_buckets, whole_groups
from quarry.llm.common import bounded_batches, pick, text_chunks, written
from quarry.llm.components import components
from quarry.sources.tables import load

SHINGLE = 4
BITS = 4
SEED = 42
BLOCKS = 7
BUCKET_ROWS = 2048


def fingerprint(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints (uint64): ASCII-lower-cased words, shingles with
    repeats, a bit set if set in over half of the shingles' XXH64 values."""
    digest = xxhash.xxh64_digest
    out = np.zeros(len(texts), dtype=np.uint64)
    hashes: list[bytes] = []
    counts, rows, size = [], [], 0

    def flush():
        bits = np.unpackbits(np.frombuffer(b"".join(hashes), dtype=np.uint8).reshape(-1, 8), axis=1)
        n = np.asarray(counts)
        ones = np.add.reduceat(bits, np.append(0, np.cumsum(n)[:-1]), axis=0, dtype=np.int64)
        out[rows] = np.packbits(2 * ones > n[:, None], axis=1).view(">u8").ravel()
        hashes.clear()
        counts.clear()
        rows.clear()

    for r, t in enumerate(texts):
        ws = t.encode().lower().split() if t else None
        if not ws:
            continue
        if len(ws) > shingle:
            got = [digest(b" ".join(s), SEED) for s in zip(*(ws[k:] for k in range(shingle)))]
        else:
            got = [digest(b" ".join(ws), SEED)]
        hashes.extend(got)
        counts.append(len(got))
        rows.append(r)
        size += len(got)
        if size > 100_000:
            flush()
            size = 0
    if hashes:
        flush()
    return out


class PivotTable:
    """References, block coordinates and bucket keys for 64-bit words."""

    def __init__(self, bits: int, blocks: int):
        if not bits < blocks:
            raise ValueError("more blocks than differing bits are needed")
        edges = [64 * b // blocks for b in range(blocks + 1)]
        self.bits = bits
        self.spans = list(zip(edges, edges[1:]))
        refs = [0]
        for lo, hi in self.spans:
            refs += [((1 << (k + 1)) - 1) ^ ((1 << lo) - 1) for k in range(lo, hi)]
        self.refs = np.asarray(refs, dtype=np.uint64)
        self.tables = list(combinations(range(blocks), blocks - bits))

    def distances(self, fp: np.ndarray) -> np.ndarray:
        return np.bitwise_count(fp[:, None] ^ self.refs[None, :])

    def keys(self, fp: np.ndarray) -> np.ndarray:
        """A bucket key for every table: the block coordinates, which are the
        distances to a block's references less that to the zero reference."""
        d = self.distances(fp).astype(np.int64)
        # successive prefixes differ by one bit, so coordinates step by +-1:
        # one binary digit per reference holds a block's whole coordinate vector
        coord = d[:, 1:] - d[:, :1]
        block = []
        for lo, hi in self.spans:
            step = np.diff(coord[:, lo:hi], axis=1, prepend=0) < 0
            block.append(step @ (1 << np.arange(hi - lo, dtype=np.int64)))
        out = np.empty((len(fp), len(self.tables)), dtype=np.int64)
        for t, chosen in enumerate(self.tables):
            key = np.full(len(fp), t, dtype=np.int64)
            for b in chosen:
                key = (key << (self.spans[b][1] - self.spans[b][0])) | block[b]
            out[:, t] = key
        return out


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), texts in text_chunks(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array(fingerprint(texts, shingle).view(np.int64))], names=["doc_id", "fp"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, fp long")


def links(distinct_fp: DataFrame, bits: int, blocks: int, bucket_rows: int) -> DataFrame:
    """Edges (a, b) between fingerprints that span all links of ``bits`` or
    fewer differing bits."""

    def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PivotTable(bits, blocks)
        for b in batches:
            fp = b.column(0).to_numpy()
            keys = table.keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(fp, keys.shape[1]))], names=["key", "fp"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PivotTable(bits, blocks)
        for t, group in whole_groups(batches, 100_000):
            fp = t.column("fp").to_numpy().view(np.uint64)
            lo, hi, piece = (t.column(c).to_numpy() for c in ("lo", "hi", "piece"))
            coords = table.distances(fp).astype(np.int8)
            forest = Forest(len(fp))

            def test(i, j):
                near = np.abs(coords[i] - coords[j]).max(axis=1) <= bits
                i, j = i[near], j[near]
                same = np.bitwise_count(fp[i] ^ fp[j]) <= bits
                forest.add(i[same], j[same])

            pairs(group, lo, hi, piece, test, most=50_000)
            a, b = forest.edges()
            signed = fp.view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(signed[a]), pa.array(signed[b])], names=["a", "b"])

    rows = distinct_fp.select("fp").mapInArrow(key_rows, "key long, fp long")
    return split_buckets(rows, "fp", bucket_rows).mapInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    bits: int = BITS, blocks: int = BLOCKS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest
    id reachable over links."""
    marked = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    label = components(links(distinct, bits, blocks, bucket_rows)).withColumnRenamed("node", "fp")
    labelled = written(distinct.join(label, "fp", "left").withColumn("label", F.coalesce("label", "fp")), "labelled")
    least = written(labelled.groupBy("label").agg(F.min("least").alias("component_id")), "components")
    classes = written(labelled.join(least, "label").select("fp", "component_id"), "classes")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = near_duplicates(pick(load(spark, sf_dir, "documents"), "doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
