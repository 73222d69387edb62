"""Which documents hold which items word for word (C3): a containment join by
an inverted index of rare grams.

A gram is a run of bytes, of the greatest length of ``GRAMS`` that fits the
item, so no item is too short.  A document that holds an item holds each of its
grams; it is enough to look for one, the item's rarest.  So:

1. One scan counts the documents of every gram that occurs in an item.
2. The key of an item is its gram in the fewest documents.  A gram that is
   common never becomes a key unless the item has no other, and an item with a
   gram in no document is in none.
3. A second scan finds the keys in the documents and passes on only documents
   with one; they meet the items of their keys by hash, and the text is
   compared in full.

What goes to every task is a bit map of fixed size; a full one lets more grams
through to the joins, which are exact.  Items are sent along with the key only
behind a check of their bytes.

Null texts hold nothing and are in nothing, as are items without a character;
repeated documents and items give a row each, null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.search.bitmap import bit_map, in_bit_map, mixed
from quarry.session import scratch_path
from quarry.sources.tables import load

GRAMS = (8, 4, 2, 1)
BITS = 26
WINDOW = 2 << 20
#: items that are sent to every task: their number and bytes
SENT_ITEMS, SENT_BYTES = 100_000, 32 << 20


def _kept(df: DataFrame, tag: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "containment", tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gram_keys(data: np.ndarray, lengths) -> Iterator[tuple[int, np.ndarray]]:
    """(length, keys): of every position, the key of the gram that begins there
    (behind the end, zeros)."""
    padded = np.append(data, np.zeros(8, dtype=np.uint8)).astype(np.uint64)
    wide = padded[:len(data)].copy()
    for k in range(1, 8):
        wide |= padded[k:k + len(data)] << np.uint64(8 * k)
    for n in lengths:
        value = wide if n == 8 else wide & np.uint64((1 << 8 * n) - 1)
        yield n, mixed(value + np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64)))


def _flat(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and the last one ends."""
    raw = text.cast(pa.large_binary())
    at = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    return np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def item_grams(items: DataFrame) -> DataFrame:
    """(tid, gram, key): the distinct grams of every item text (tid, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for tid, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = np.frombuffer(text.encode(), dtype=np.uint8)
                n = next(g for g in GRAMS if g <= len(data))
                for _, keys in gram_keys(data, (n,)):
                    keys = np.unique(keys[:len(data) - n + 1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), tid)), pa.array(np.full(len(keys), n, dtype=np.int32)),
                                                      pa.array(keys.view(np.int64))], names=["tid", "gram", "key"])

    return items.mapInArrow(run, "tid long, gram int, key long")


def _hits(text: pa.Array, bits_of: np.ndarray, lengths) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document numbers, keys) of grams that the map takes in, each once per
    document and window."""
    data, at = _flat(text)
    for pos in range(0, len(data), WINDOW):
        part = data[pos:pos + WINDOW + 7]
        n = min(WINDOW, len(data) - pos)
        for g, keys in gram_keys(part, lengths):
            hit = np.flatnonzero(in_bit_map(bits_of, BITS, keys[:n]))
            doc = np.searchsorted(at, hit + pos, side="right") - 1
            inside = at[doc + 1] - (hit + pos) >= g
            doc, key = doc[inside], keys[hit[inside]]
            order = np.lexsort((key, doc))
            doc, key = doc[order], key[order]
            first = np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))[:len(doc)]
            yield doc[first], key[first]


def document_counts(docs: DataFrame, shared, lengths) -> DataFrame:
    """(key, n): documents (windows of long ones) that hold a gram of the map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = np.frombuffer(shared.value, dtype=np.uint8)
        held, size = [], 0

        def out():
            key = np.concatenate([k for k, _ in held])
            u, inv = np.unique(key, return_inverse=True)
            n = np.bincount(inv, weights=np.concatenate([c for _, c in held])).astype(np.int64)
            return u, n

        for b in batches:
            for _, key in _hits(b.column(0), bits_of, lengths):
                held.append(np.unique(key, return_counts=True))
                size += len(held[-1][0])
                if size > 1_000_000:
                    held = [out()]
                    size = len(held[0][0])
        if held:
            u, n = out()
            for s in range(0, len(u), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(u[s:s + 50_000].view(np.int64)), pa.array(n[s:s + 50_000])], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def with_keys(docs: DataFrame, shared, lengths) -> DataFrame:
    """(doc_id, text, keys) of documents that hold a key of the map."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = np.frombuffer(shared.value, dtype=np.uint8)
        for b in batches:
            found = list(_hits(b.column(1), bits_of, lengths))
            if not found:
                continue
            doc, key = (np.concatenate(x) for x in zip(*found))
            order = np.lexsort((key, doc))
            doc, key = doc[order], key[order]
            first = np.append(True, (doc[1:] != doc[:-1]) | (key[1:] != key[:-1]))[:len(doc)]
            doc, key = doc[first], key[first]
            rows, begins = np.unique(doc, return_index=True)
            keys = pa.ListArray.from_arrays(pa.array(np.append(begins, len(key)).astype(np.int32)), pa.array(key.view(np.int64)))
            part = b.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), keys], names=["doc_id", "text", "keys"])

    return docs.mapInArrow(run, f"doc_id {kind}, text string, keys array<long>")


def containment(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) for documents (doc_id, text) whose text holds the text
    of an item (item_id, text)."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    items = items.where("text <> ''").select("item_id", F.col("text").cast("string").alias("text")).withColumn("tid", F.xxhash64("text"))
    texts = _kept(items.select("tid", "text").distinct(), "texts")
    grams = _kept(item_grams(texts), "grams")
    lengths = sorted(r[0] for r in grams.select("gram").distinct().collect())       # at most four
    index = spark.sparkContext.broadcast(bit_map(grams, BITS).tobytes())
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key")).alias("m")
    chosen = _kept(grams.join(document_counts(docs, index, lengths), "key", "left").groupBy("tid").agg(rarest)
                   .where("m.n > 0").select("tid", F.col("m.key").alias("key")).join(texts, "tid"), "keys")
    size = chosen.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    right = chosen.select("tid", "key", F.col("text").alias("item"))
    if size.n <= SENT_ITEMS and size.bytes <= SENT_BYTES:
        right = F.broadcast(right)
    keys = spark.sparkContext.broadcast(bit_map(chosen, BITS).tobytes())
    pairs = (with_keys(docs, keys, lengths).withColumn("key", F.explode("keys")).join(right, "key")
             .where(F.contains("text", "item")).select("doc_id", "tid"))
    return pairs.join(items.select("tid", "item_id"), "tid").select("doc_id", "item_id")


@query("contamination", oracle="""
SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) WHERE b.text <> ''
""")
def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item word for word."""
    return containment(load(spark, sf_dir, "documents").select("doc_id", "text"),
                       load(spark, sf_dir, "benchmark").select("item_id", "text"))
