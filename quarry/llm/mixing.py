"""Operator 11, mixing sources to target weights: a low-discrepancy schedule.

Targets: source s shares the words of all documents by its weight, but takes
at most ``most`` times its own words; what is above goes to the others by
weight until none is above (``targets``, in exact integers).

Schedule: slot i has the golden-ratio point ``i * phi mod 1`` (a Weyl sequence
in 64-bit integers).  Cumulative targets map the point to a source, so every
run of slots holds each source in proportion, off by a few slots.  The r-th
slot of a source gets its r-th block.

Blocks: the documents of a source, shuffled by a hash of id and text, form a
stream of words that starts again after the last document (a pass).  The first
``target`` words of it are cut into as many equal blocks (one word more or
less) as the source has slots; so a source takes its target to the word, and a
document at most ``most`` times its size.

Everything is joined by number, no text moves: one row of a few numbers per
document, slot and piece.  Ranks of slots are counts per run of slots, summed
up; offsets of documents are sums per hash range of a source, summed up, so a
source with a third of the rows is spread over as many tasks as its rows need.
The list of sources is small by its nature (they are named and weighted) and is
checked: above ``MAX_SOURCES`` the operator raises.

Edge cases: null text has size 0 and takes nothing, null source is a source of
its own (the last), repeated rows are documents each, null ids are kept; an
empty table, or one without words, gives its rows with target 0 and no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import bounded_batches, pick, written
from quarry.sources.tables import load

WEIGHTS = (1, 2, 3)
MOST = 3
BLOCK_WORDS = 1024
#: sources of one mix: a list of this size is a few MB in every task
MAX_SOURCES = 100_000
#: documents of one hash range of a source (a window of one task)
RANGE_ROWS = 16_384
SLOT_RUN = 1 << 16
HASH_BITS = 60
#: the golden ratio as a 64-bit fraction
PHI = 0x9E3779B97F4A7C15

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_counts(text: pa.Array) -> np.ndarray:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text (null: 0)."""
    raw = text.cast(pa.large_binary())
    n = len(raw)
    offset = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + n + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offset[0]:offset[-1]]
    at = offset - offset[0]
    word = ~SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    first = at[:-1][at[:-1] < len(data)]
    begins[first] = word[first]
    upto = np.zeros(len(data) + 1, dtype=np.int32)
    np.cumsum(begins, out=upto[1:])
    sizes = (upto[at[1:]] - upto[at[:-1]]).astype(np.int64)
    if raw.null_count:
        sizes[raw.is_null().to_numpy(zero_copy_only=False)] = 0
    return sizes


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, h, size) of documents (doc_id, source, text)."""
    h = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                                          F.coalesce("text", F.lit(""))).cast("binary")), 1, HASH_BITS // 4), 16, 10)
    source = docs.select("doc_id", F.col("source").cast("string").alias("source"), h.cast("long").alias("h"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(3)], pa.array(word_counts(b.column(3)))],
                                             names=["doc_id", "source", "h", "size"])

    return source.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, h long, size long")


def targets(sizes: list[int], weights: list[int], most: int = MOST) -> list[float]:
    """Shares of sum(sizes) by weight, at most ``most`` times the size, the
    excess shared again by weight until none is above."""
    total = sum(sizes)
    capped: set[int] = set()
    while True:
        left = total - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        above = [i for i, w in enumerate(weights) if i not in capped and w * left > most * sizes[i] * weight]
        if not above:
            break
        capped.update(above)
    return [float(most * s) if i in capped else w * (left / weight) for i, (s, w) in enumerate(zip(sizes, weights))]


def source_table(base: DataFrame, weights=WEIGHTS, most: int = MOST) -> list[tuple]:
    """(source, size, target) in the order of code points, null last."""
    rows = base.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: a mix is over named sources")
    rows.sort(key=lambda r: (r.source is None, (r.source or "").encode()))
    goal = targets([r["size"] for r in rows], [weights[i % len(weights)] for i in range(len(rows))], most)
    return [(r.source, r["size"], t) for r, t in zip(rows, goal)]


def schedule(spark: SparkSession, words: list[int], slots: int) -> tuple[DataFrame, list[int]]:
    """(ix, block, slot): the block of source number ``ix`` that every slot
    takes, and the slots of each source.  A source too small for any point of
    the sequence gets one slot after the others."""
    total = sum(words)
    cum = np.asarray([min((c << 64) // total, (1 << 64) - 1) for c in np.cumsum(np.asarray(words, dtype=object))][:-1], dtype=np.uint64)
    runs = -(-slots // SLOT_RUN)

    def sources(run: int) -> tuple[np.ndarray, np.ndarray]:
        slot = np.arange(run * SLOT_RUN, min((run + 1) * SLOT_RUN, slots), dtype=np.int64)
        return slot, np.searchsorted(cum, (slot + 1).astype(np.uint64) * np.uint64(PHI), side="right")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for run in b.column(0).to_pylist():
                n = np.bincount(sources(run)[1], minlength=len(words))
                ix = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ix), run)), pa.array(ix), pa.array(n[ix])],
                                                 names=["run", "ix", "n"])

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for run, ix, before in zip(*(b.column(i).to_pylist() for i in range(3))):
                base = np.zeros(len(words), dtype=np.int64)
                base[np.asarray(ix)] = before
                slot, of = sources(run)
                order = np.argsort(of, kind="stable")
                first = np.searchsorted(of[order], of[order], side="left")
                block = np.empty(len(of), dtype=np.int64)
                block[order] = np.arange(len(of)) - first
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(base[of] + block), pa.array(slot)],
                                                 names=["ix", "block", "slot"])

    counts = written(spark.range(runs, numPartitions=min(runs, 2 * spark.sparkContext.defaultParallelism))
                     .mapInArrow(count, "run long, ix long, n long"), "slots")
    per = dict(counts.groupBy("ix").agg(F.sum("n")).collect())              # one row per source
    earlier = Window.partitionBy("ix").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = (counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
              .groupBy("run").agg(F.collect_list(F.struct("ix", "before")).alias("m"))
              .select("run", "m.ix", "m.before"))
    late = [i for i, w in enumerate(words) if w and not per.get(i)]
    table = before.mapInArrow(rank, "ix long, block long, slot long").unionByName(
        spark.createDataFrame([(i, 0, slots + k) for k, i in enumerate(late)], "ix long, block long, slot long"))
    return table, [per.get(i, int(bool(w))) for i, w in enumerate(words)]


class Mix:
    """One mix of a corpus: ``sources`` (small list), ``documents`` (one row
    per document with its place in the stream of its source) and ``pieces``."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 weights=WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS):
        spark = docs.sparkSession
        base = written(sized(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                                         F.col(f"`{text_col}`").cast("string").alias("text"))), "sizes")
        self.sources = source_table(base, weights, most)
        words = [int(t) for _, _, t in self.sources]
        total = sum(words)
        slots = max(total // block_words, min(total, 64 * len(words)))
        plan, n_slots = schedule(spark, words, slots) if total else (
            spark.createDataFrame([], "ix long, block long, slot long"), [0] * len(words))
        small = F.broadcast(spark.createDataFrame(
            [(i, s, size, goal, words[i], n_slots[i]) for i, (s, size, goal) in enumerate(self.sources)],
            "ix long, name string, source_size long, target double, words long, slots long"))
        bits = max(0, (base.count() // RANGE_ROWS).bit_length())
        placed = (base.join(small, F.col("source").eqNullSafe(F.col("name")))
                  .withColumn("part", F.shiftright("h", HASH_BITS - bits)))
        sums = placed.groupBy("ix", "part").agg(F.sum("size").alias("s"))
        earlier = Window.partitionBy("ix").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("ix", "part", F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("before"))
        order = Window.partitionBy("ix", "part").orderBy("h", F.col("doc_id").asc_nulls_first(), "size")
        inside = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        self.documents = written(
            placed.withColumn("inside", inside).withColumn("row", F.row_number().over(order)).join(sums, ["ix", "part"])
            .select("ix", "part", "row", "doc_id", "source", "size", "source_size", "target", "words", "slots",
                    (F.col("before") + F.col("inside")).alias("at")), "places")
        self.pieces = self._pieces(plan, most)

    def _pieces(self, plan: DataFrame, most: int) -> DataFrame:
        """(slot, ix, part, row, doc_id, source, pass, start, n_words): words
        [start, start + n_words) of a document go to a slot."""
        wide = "(words div greatest(slots, 1L))"                                # the first `more` blocks: one word more
        more = "(words % greatest(slots, 1L))"
        block = lambda x: (f"if({x} < {more} * ({wide} + 1), {x} div ({wide} + 1), "           # noqa: E731
                           f"{more} + ({x} - {more} * ({wide} + 1)) div greatest({wide}, 1L))")
        begin = lambda b: f"({b} * {wide} + least({b}, {more}))"                # noqa: E731
        return (self.documents.where("size > 0 and words > 0")
                .withColumn("pass", F.explode(F.array(*[F.lit(k).cast("long") for k in range(most)])))
                .withColumn("lo", F.expr("at + pass * source_size"))
                .withColumn("hi", F.expr("least(lo + size, words)")).where("lo < hi")
                .withColumn("block", F.explode(F.expr(f"sequence({block('lo')}, {block('(hi - 1)')})")))
                .withColumn("a", F.expr(f"greatest(lo, {begin('block')})"))
                .withColumn("b", F.expr(f"least(hi, {begin('(block + 1)')})"))
                .join(plan, ["ix", "block"])
                .select("slot", "ix", "part", "row", "doc_id", "source", "pass",
                        F.expr("a - lo").alias("start"), F.expr("b - a").alias("n_words")))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the words that the mix takes of it."""
    bounded_batches(spark)
    mix = Mix(pick(load(spark, sf_dir, "documents"), "doc_id", "text", "source"))
    key = ["ix", "part", "row"]
    taken = mix.pieces.groupBy(*key).agg(F.sum("n_words").alias("taken"))
    return mix.documents.join(taken, key, "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


#: the same by a running sum per source: the first `target` words of its
#: shuffled stream, passes included, are taken
OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, source, COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(COALESCE(doc_id::VARCHAR, '') || ':' || COALESCE(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s0 AS (SELECT source, SUM(size)::HUGEINT AS size FROM d GROUP BY source),
s1 AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM s0),
s2 AS (
  SELECT *, SUM(size) OVER () - COALESCE(SUM(3 * size) OVER (
              ORDER BY 3 * size / w::DOUBLE, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         SUM(w) OVER (ORDER BY 3 * size / w::DOUBLE, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight,
         row_number() OVER (ORDER BY 3 * size / w::DOUBLE, source NULLS LAST) AS k
  FROM s1),
level AS (SELECT rest::DOUBLE / weight::DOUBLE AS share, k FROM s2 WHERE 3 * size * weight >= rest * w
          ORDER BY k LIMIT 1),
goal AS (SELECT source, size::BIGINT AS source_size,
                CASE WHEN s2.k < level.k THEN (3 * size)::DOUBLE ELSE w * share END AS target
         FROM s2, level),
placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, floor(g.target)::BIGINT AS words,
         COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id NULLS FIRST, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begins
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, words - begins)) + greatest(0, least(size, words - begins - source_size))
        + greatest(0, least(size, words - begins - 2 * source_size)))::BIGINT AS taken
FROM placed
"""
