"""Operator 5, repeated substrings by column-wise construction of a
multi-document Burrows-Wheeler transform with common prefixes.

A byte goes if a string of ``length`` bytes that covers it also starts earlier
(smaller document id, or earlier in the same document).

*Cutting.*  Every window of ``length`` bytes has an anchor: its k-byte
substring of least hash (the leftmost of equals), so equal windows have equal
anchors at equal places.  Maximal runs of windows with one anchor are
"pieces": strings of at most 2 * length - k bytes, the short documents whose
collection is indexed.  Pieces whose anchor occurs once can hold no repeat and
are left out; every other piece is inserted, copies too.

*Construction.*  Pieces come to the tasks by anchor, with their bytes.  A task
takes blocks of whole anchor groups, lays their pieces out as columns relative
to the anchor and goes through the columns from right to left: each round
inserts one symbol of every piece.  The symbols in the order of the suffixes so
far are the round's segment of the Burrows-Wheeler transform; its stable sort by
symbol gives the order of the extended suffixes, and the common prefix of
neighbours grows by one or falls to zero, by range minima over the previous
round's array.  Runs of common prefixes of at least ``length`` are equal
windows, and all but the earliest of them are repeats: no hash decides what is
equal.  What the method keeps in sequential external files (columns in, segments
out) are here Spark's shuffle files, sorted by anchor and read through once; a
task holds one block, of bounded size, in memory.

*Hot anchors.*  The pieces of an anchor that occurs more than ``group_rows``
times are first collapsed by their bytes, with partial aggregation: the first
piece of each class stands for all, later ones repeat it entirely.  What is left
is inserted like any piece; only an anchor with more than ``group_rows``
different pieces is not given to one task, and its windows are exploded and
grouped by their bytes.

The filters sent to the tasks are bit maps of fixed size (``filter_bits``);
a fuller one only prunes less.

Edge cases: null text counts as empty; texts shorter than ``length`` are never
touched; rows of one id with different texts are separate documents (ordered
by a hash of the text), identical rows are one document; a null id comes after
all others; texts of any length are cut into overlapping segments.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, pick, text_chunks, written
from quarry.llm.hashing import Powers, prefix_hashes, scramble
from quarry.sources.tables import load

LENGTH = 100
ANCHOR = 32
GROUP_ROWS = 50_000
BLOCK_ROWS = 20_000
FILTER_BITS = 27
SEGMENT = 2 << 20
PIECE = ["anchor", "did", "h", "start", "off", "bytes"]


class Pieces:
    """Pieces of documents laid end to end in ``data``."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int, k: int, powers: Powers):
        n = len(data)
        up, _ = powers.upto(n + 1)
        prefix = prefix_hashes(data, powers)
        grams = scramble((prefix[k:] - prefix[:-k]) * up[:n + 1 - k]) if n >= k else np.empty(0, dtype=np.uint64)
        # least hash of each window, position in the low bits: leftmost wins
        low = np.uint64((1 << 25) - 1)
        best = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width, have = length - k + 1, 1
        while have < width:
            step = min(have, width - have)
            best = np.minimum(best[:-step], best[step:]) if len(best) > step else best[:0]
            have += step
        begins = np.append(0, ends[:-1])
        starts = np.concatenate([np.arange(b, e - length + 1) for b, e in zip(begins, ends)] or [np.empty(0, np.int64)]).astype(np.int64)
        doc = np.repeat(np.arange(len(ends)), np.maximum(ends - begins - length + 1, 0))
        anchor_at = (best[starts] & low).astype(np.int64)
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (anchor_at[1:] != anchor_at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        self.doc = doc[first]
        self.at = starts[first]                                     # in data
        self.start = self.at - begins[self.doc]                     # in the document
        self.n = np.diff(np.append(first, len(starts)))             # windows
        self.off = anchor_at[first] - self.at
        self.anchor = grams[anchor_at[first]]


def segments(texts: list[str | None], length: int):
    """Bytes of documents in runs of about SEGMENT: (data, ends, document,
    offset of the segment in it); segments of one document overlap so that
    every window lies in exactly one."""
    parts, doc, offset, size = [], [], [], 0

    def out():
        return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum([len(p) for p in parts]), np.asarray(doc), np.asarray(offset)

    for d, t in enumerate(texts):
        raw = t.encode() if t else b""
        at = 0
        while len(raw) - at >= length:
            part = raw[at:at + SEGMENT + length - 1]
            parts.append(part)
            doc.append(d)
            offset.append(at)
            size += len(part)
            at += SEGMENT
            if size >= SEGMENT:
                yield out()
                parts, doc, offset, size = [], [], [], 0
    if parts:
        yield out()


def _pieces(batches: Iterator[pa.RecordBatch], length: int, k: int):
    """Of (did, h, text) batches: pieces, their document numbers and offsets,
    and the two document key columns."""
    powers = Powers()
    for (did, h), texts in text_chunks(batches, limit=SEGMENT):
        did, h = did.to_numpy(), h.to_numpy()
        for data, ends, doc, offset in segments(texts, length):
            p = Pieces(data, ends, length, k, powers)
            p.start = p.start + offset[p.doc]
            p.doc = doc[p.doc]
            yield p, data, did[p.doc], h[p.doc]


def bit_maps(keys: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit maps over the low ``bits`` bits of the long column ``key`` (the
    high ones of anchors, which are least hashes, are nearly all zero): all
    keys, and those with ``hot``; built in slices by Spark, of fixed size
    whatever the number of keys."""
    slices = 64
    width = (1 << bits) // slices

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for b in batches:
            pos, hot = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False)
            part = pos // width
            for s in np.unique(part):
                m = maps.setdefault(int(s), np.zeros((2, width), dtype=bool))
                m[0, pos[part == s] - s * width] = True
                m[1, pos[(part == s) & hot] - s * width] = True
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(maps), pa.int32()), *[pa.array([np.packbits(m[k]).tobytes() for m in maps.values()], pa.binary()) for k in (0, 1)]],
            names=["slice", "all", "hot"])

    pos = (keys.groupBy(F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).alias("pos")).agg(F.max("hot").alias("hot")))
    rows = (pos.repartition(F.col("pos") - F.col("pos") % width)
            .mapInArrow(fill, "slice int, all binary, hot binary").collect())
    out = np.zeros((2, (1 << bits) // 8), dtype=np.uint8)
    for r in rows:                      # 64 slices of fixed size
        at = slice(r.slice * width // 8, (r.slice + 1) * width // 8)
        out[0, at], out[1, at] = np.frombuffer(r["all"], dtype=np.uint8), np.frombuffer(r.hot, dtype=np.uint8)
    return out[0], out[1]


def in_map(bits_of: np.ndarray, bits: int, key: np.ndarray) -> np.ndarray:
    pos = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bits_of[pos >> 3] >> (7 - (pos & 7)).astype(np.uint8)) & 1 == 1


def anchors(docs: DataFrame, length: int, k: int) -> DataFrame:
    """(anchor, n): occurrences of anchors, summed per segment already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, _, _, _ in _pieces(batches, length, k):
            a, n = np.unique(p.anchor, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    return docs.mapInArrow(run, "anchor long, n long")


def pieces(docs: DataFrame, maps, bits: int, length: int, k: int, hot: bool) -> DataFrame:
    """Pieces with a repeated anchor, hot or not, with their bytes.  The few
    others that the maps let through are pieces like any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, often = (np.frombuffer(m, dtype=np.uint8) for m in maps.value)
        for p, data, did, h in _pieces(batches, length, k):
            at = np.flatnonzero(in_map(often, bits, p.anchor) if hot else
                                in_map(repeated, bits, p.anchor) & ~in_map(often, bits, p.anchor))
            raw = data.tobytes()
            for s in range(0, len(at), 20_000):
                some = at[s:s + 20_000]
                begin = p.at[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.anchor[some].view(np.int64)), pa.array(did[some]), pa.array(h[some]), pa.array(p.start[some]),
                     pa.array(p.off[some].astype(np.int32)),
                     pa.array([raw[a:b] for a, b in zip(begin.tolist(), (begin + p.n[some] + length - 1).tolist())], pa.binary())],
                    names=PIECE)

    return docs.mapInArrow(run, "anchor long, did long, h long, start long, off int, bytes binary")


def collapsed(hot: DataFrame, bits: int) -> tuple[DataFrame, DataFrame]:
    """Of (written) pieces: the first of every class of equal bytes, and the
    spans of the later ones.  The places of the first ones are a bit map: what
    lies outside it is a later copy, the few later copies that it lets through
    are inserted like any piece."""
    place = ["did", "h", "start"]
    first = hot.groupBy("anchor", "off", "bytes").agg(F.min(F.struct(*place)).alias("first")).select("first.*")
    taken, _ = bit_maps(first.select(F.xxhash64(*place).alias("key"), F.lit(False).alias("hot")), bits)
    shared = hot.sparkSession.sparkContext.broadcast(taken.tobytes())

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits_of = np.frombuffer(shared.value, dtype=np.uint8)
        for b in batches:
            *fields, raw, key = b.columns
            inside = pa.array(in_map(bits_of, bits, key.to_numpy().view(np.uint64)))
            stop = pa.compute.add(b.column("start"), pa.compute.binary_length(raw).cast(pa.int64()))
            yield pa.RecordBatch.from_arrays([*fields, pa.compute.if_else(inside, raw, pa.scalar(None, pa.binary())), stop],
                                             names=[*PIECE, "stop"])

    told = written(hot.select(*PIECE, F.xxhash64(*place).alias("key")).mapInArrow(
        tell, "anchor long, did long, h long, start long, off int, bytes binary, stop long"), "told")
    # a repeated row has its pieces at the same places: they count once
    return (told.where("bytes IS NOT NULL").dropDuplicates(place).select(*PIECE),
            told.where("bytes IS NULL").select(*place, "stop"))


def repeated_windows(pieces: list[bytes], off: np.ndarray, rank: np.ndarray, length: int, k: int) -> np.ndarray:
    """For every piece and window start relative to its anchor (columns
    -(length-k) .. 0): does an equal window of a piece of lower rank exist?

    The core of the construction: one symbol per piece and round, from the
    right; ``order`` lists the pieces by their suffixes from the column on,
    ``common`` the common prefix of each with the one before it."""
    m = len(pieces)
    left = length - k
    sizes = np.asarray([len(p) for p in pieces])
    columns = np.zeros((left + length, m), dtype=np.uint16)         # one row per round; 0: outside the piece
    flat = np.frombuffer(b"".join(pieces), dtype=np.uint8)
    piece = np.repeat(np.arange(m), sizes)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + left - np.repeat(off, sizes)
    columns[column, piece] = flat.astype(np.uint16) + np.uint16(1)
    order = np.arange(m)
    common = np.zeros(m, dtype=np.int16)
    out = np.zeros((m, left + 1), dtype=bool)
    big = np.iinfo(np.int64).max
    for c in range(left + length - 1, -1, -1):
        # the segment of the transform: symbols before the sorted suffixes
        segment = columns[c][order]
        by = np.argsort(segment, kind="stable")
        order = order[by]
        symbol = segment[by]
        same = np.zeros(m, dtype=bool)
        same[1:] = symbol[1:] == symbol[:-1]
        grown = np.zeros(m, dtype=np.int16)
        i = np.flatnonzero(same)
        if len(i):
            # least common prefix between the two in the order before
            bounds = np.empty(2 * len(i), dtype=np.int64)
            bounds[0::2] = by[i - 1] + 1
            bounds[1::2] = by[i] + 1
            least = np.minimum.reduceat(np.append(common, 0), bounds)[0::2]
            grown[i] = np.minimum(least + 1, length)
        common = grown
        if c <= left:
            head = np.flatnonzero(common < length)
            valid = (left - off[order] <= c) & (c + length <= left - off[order] + sizes[order])
            r = np.where(valid, rank[order], big)
            least_rank = np.minimum.reduceat(r, head)
            out[order, c] = valid & (r > np.repeat(least_rank, np.diff(np.append(head, m))))
    return out


def construct(rows: DataFrame, length: int, k: int, block_rows: int) -> DataFrame:
    """Spans (did, h, start, stop) of repeats among pieces with bytes, which
    come partitioned and sorted by anchor."""

    def block(parts: list[pa.Table]) -> pa.RecordBatch | None:
        t = pa.concat_tables(parts).combine_chunks()
        did, h, start, off = (t.column(c).to_numpy() for c in ("did", "h", "start", "off"))
        place = start + off
        by = np.lexsort((place, h, did))
        step = np.zeros(len(by), dtype=np.int64)        # the same place twice (a repeated row): the same rank
        step[1:] = (did[by][1:] != did[by][:-1]) | (h[by][1:] != h[by][:-1]) | (place[by][1:] != place[by][:-1])
        rank = np.empty(len(by), dtype=np.int64)
        rank[by] = np.cumsum(step)
        flags = repeated_windows(t.column("bytes").to_pylist(), off.astype(np.int64), rank, length, k)
        p, c = np.nonzero(flags)
        begin = place[p] + c - (length - k)
        cut = np.ones(len(p), dtype=bool)
        cut[1:] = (p[1:] != p[:-1]) | (begin[1:] > begin[:-1] + length)
        at = np.flatnonzero(cut)
        last = np.append(at[1:], len(p))[:len(at)] - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(did[p[at]]), pa.array(h[p[at]]), pa.array(begin[at]), pa.array(begin[last] + length)], names=["did", "h", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        n = 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(pa.Table.from_batches([b]))
            n += b.num_rows
            if n >= block_rows:
                t = pa.concat_tables(held).combine_chunks()
                anchor = t.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchor, anchor[-1]))      # the last group may go on
                if cut:
                    yield block([t.slice(0, cut)])
                held, n = [t.slice(cut)], t.num_rows - cut
        if n:
            yield block(held)

    return rows.mapInArrow(run, "did long, h long, start long, stop long")


def exploded(rows: DataFrame, length: int) -> DataFrame:
    """Spans of repeats among pieces of hot anchors: their windows grouped by
    their bytes."""
    at = F.sequence(F.lit(1), F.length("bytes") - (length - 1))
    windows = (rows.select("did", "h", "start", "bytes", F.explode(at).alias("i"))
               .select("did", "h", (F.col("start") + F.col("i") - 1).alias("start"), F.substring("bytes", F.col("i"), F.lit(length)).alias("w")))
    first = windows.groupBy("w").agg(F.min(F.struct("did", "h", "start")).alias("first"), F.count("*").alias("c")).where("c > 1")
    return (windows.join(first.select("w", "first"), "w").where(F.struct("did", "h", "start") != F.col("first"))
            .select("did", "h", "start", (F.col("start") + length).alias("stop")))


def repeats(docs: DataFrame, length: int, k: int, group_rows: int, block_rows: int, filter_bits: int) -> DataFrame:
    """Spans (did, h, start, stop) to remove, for docs (did, h, text)."""
    sc = docs.sparkSession.sparkContext
    often = anchors(docs, length, k).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    every, hot = bit_maps(often.select(F.col("anchor").alias("key"), (F.col("n") > group_rows).alias("hot")), filter_bits)
    maps = sc.broadcast((every.tobytes(), hot.tobytes()))
    rows = pieces(docs, maps, filter_bits, length, k, hot=False)
    others = []
    if hot.any():
        first, later = collapsed(written(pieces(docs, maps, filter_bits, length, k, hot=True), "hot"), filter_bits)
        first = written(first, "first")
        crowd = written(first.groupBy("anchor").count().where(F.col("count") > group_rows).select("anchor"), "crowd")
        rows = rows.unionByName(first.join(crowd, "anchor", "left_anti"))
        others = [later, exploded(first.join(crowd, "anchor", "left_semi"), length)]
    spans = construct(rows.repartition("anchor").sortWithinPartitions("anchor"), length, k, block_rows)
    for more in others:
        spans = spans.unionByName(more)
    return spans


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR,
               group_rows: int = GROUP_ROWS, block_rows: int = BLOCK_ROWS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: removed spans (start,
    stop; disjoint and ordered) and the bytes that stay."""
    id_type = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    did = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1))
    # documents are told apart by id; only if ids repeat also by a hash of the text
    repeated = not docs.select(did.alias("did")).groupBy("did").count().where("count > 1").isEmpty()
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), did.alias("did"),
                        (F.xxhash64(text) if repeated else F.lit(0).cast("long")).alias("h"), text.alias("text"))
    spans = (repeats(keyed.select("did", "h", "text"), length, anchor, group_rows, block_rows, filter_bits)
             .groupBy("did", "h").agg(F.collect_list(F.struct("start", "stop")).alias("spans")))     # one document's own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids, lists), texts in text_chunks(batches, limit=SEGMENT):
            sizes, merged, kept = [], [], []
            for spans, t in zip(lists.to_pylist(), texts):
                raw = t.encode() if t else b""
                sizes.append(len(raw))
                joined: list[dict] = []
                for a, b in sorted((s["start"], s["stop"]) for s in spans or ()):
                    if joined and a <= joined[-1]["stop"]:
                        joined[-1]["stop"] = max(joined[-1]["stop"], b)
                    else:
                        joined.append({"start": a, "stop": b})
                merged.append(joined)
                edges = [0, *[x for s in joined for x in (s["start"], s["stop"])], len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(merged, span), pa.array(kept, pa.binary())],
                                             names=["doc_id", "n_bytes", "spans", "kept"])

    return (keyed.join(spans, ["did", "h"], "left").select("doc_id", "spans", "text")
            .mapInArrow(run, f"doc_id {id_type}, n_bytes long, spans array<struct<start:bigint,stop:bigint>>, kept binary"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = keep_first(pick(load(spark, sf_dir, "documents"), "doc_id", "text"))
    return found.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
