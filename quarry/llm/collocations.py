"""Operator 12, phrase collocations: suffix subtrees by vertical partitioning.

All phrases of up to ``MOST_WORDS`` words are prefixes of the word suffixes of
the pieces, truncated at that depth.  The suffixes are never sorted as a whole:

1. Words are counted, then pairs of frequent neighbours by hashed slots.  A
   phrase is at most as frequent as its rarest word or pair, so a suffix ends
   before the first of them below ``min_count``.
2. Word prefixes are grouped by memory budget: prefixes are the frequent words;
   one with more suffixes than ``budget`` is replaced by its extensions by one
   word, counted in a scan of their own, and so on.  Prefixes fall into hashed
   buckets, and buckets are packed into groups of at most about ``budget``
   suffixes.
3. Each run of documents sends every group the suffixes that begin with its
   prefixes, equal ones counted, as a front-coded sorted list.  The group
   builds the subtree of its suffixes on its own: sorted, cut at the depths
   where neighbours part; the count of a node is the total of its leaves.
   Phrases shorter than the prefix of their group get a part of their count
   from each group, which are summed up.

Then every cut of a candidate is looked up in the table of counts, the score is
an exact decimal division, and candidates with an equally frequent extension by
one word go (a longer one that contains the phrase as often contains such an
extension).  Only candidates that can be among the first ``top`` of their
language get their words back as text.

Words are 64 hashed bits, salted with the language.  The filters and the bucket
table have a fixed size; a filter that takes in too much prunes less or splits
a prefix needlessly, and never changes a count.

Edge cases: null text is empty, null language is ``und``; texts without words
give nothing; repeated rows count each; empty tables give no rows.  A piece (no
delimiter) must fit a task.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import bounded_batches, pick, written
from quarry.llm.hashing import Powers, prefix_hashes, scramble
from quarry.llm.suffix_dedup import bit_maps, in_map
from quarry.sources.tables import load

MIN_COUNT = 100
MOST_WORDS = 5
TOP = 2000
SCALE = 1000
#: suffixes of one group: their words are 40 bytes each in the task
BUDGET = 2_000_000
#: bytes of text whose words are found at once, and words held before suffixes
#: are sent or word counts are given out
WINDOW_BYTES = 2 << 20
RUN_WORDS = 1_500_000
FILTER_BITS = 27
LEAST_BUCKET_BITS, MOST_BUCKET_BITS = 12, 22

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
DELIMITER = np.zeros(256, dtype=bool)
DELIMITER[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~DELIMITER
IN_WORD[[0x20, 0x09]] = False


def language_salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Tokens:
    """Words of a window of text: ``data[start:stop]`` each, their salted
    hashes, the number of the piece, and the language's number."""

    def __init__(self, data: np.ndarray, fresh: np.ndarray, doc_lang: np.ndarray, salts: np.ndarray, powers: Powers):
        """``fresh``: where documents begin, with the language of each."""
        self.data = data = LOWER[data]
        inside = IN_WORD[data]
        begin, end = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        begin[fresh] = inside[fresh]
        before = fresh[fresh > 0] - 1
        end[before] = inside[before]
        self.start, self.stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
        border = DELIMITER[data]
        border[fresh] = True
        self.piece = np.cumsum(border, dtype=np.int32)[self.start]
        self.lang = doc_lang[np.searchsorted(fresh, self.start, side="right") - 1]
        prefix = prefix_hashes(data, powers)
        up, _ = powers.upto(len(data) + 1)
        plain = scramble((prefix[self.stop] - prefix[self.start]) * up[self.start])
        self.hash = np.maximum(scramble(plain ^ salts[self.lang]), np.uint64(1))

    def words(self, at: np.ndarray) -> pa.Array:
        n = (self.stop - self.start)[at]
        ends = np.append(0, np.cumsum(n))
        flat = self.data[np.repeat(self.start[at] - ends[:-1], n) + np.arange(ends[-1])]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)).cast(pa.string())


def tokens(batches: Iterator[pa.RecordBatch], langs: list[str]) -> Iterator[Tokens]:
    """Words of (lang, text) batches, window by window; ``langs`` takes in the
    languages seen, in the order of their numbers.  Windows end where pieces do."""
    powers, known, salts = Powers(), {}, np.empty(0, dtype=np.uint64)
    for b in batches:
        coded = b.column(0).fill_null("und").dictionary_encode()
        for lang in coded.dictionary.to_pylist():
            if lang not in known:
                known[lang] = len(langs)
                langs.append(lang)
                salts = np.append(salts, np.uint64(language_salt(lang)))
        numbers = np.asarray([known[x] for x in coded.dictionary.to_pylist()], dtype=np.int64)
        doc_lang = numbers[coded.indices.to_numpy()] if b.num_rows else numbers
        raw = b.column(1).cast(pa.large_binary())
        offset = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
        data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offset[0]:offset[-1]]
        at = offset - offset[0]
        full = at[1:] > at[:-1]
        at, doc_lang = at[:-1][full], doc_lang[full]
        pos = 0
        while pos < len(data):
            cut = pos + WINDOW_BYTES
            nxt = np.searchsorted(at, cut)
            cut_doc = int(at[nxt]) if nxt < len(at) else len(data)
            if cut < cut_doc:                                               # inside a document: after a delimiter
                while cut < cut_doc:
                    found = np.flatnonzero(DELIMITER[data[cut:min(cut + 65536, cut_doc)]])
                    if len(found):
                        cut += int(found[0]) + 1
                        break
                    cut += 65536
            cut = min(cut, cut_doc)
            first = np.searchsorted(at, pos, side="right") - 1
            last = np.searchsorted(at, cut)
            fresh = np.maximum(at[first:last] - pos, 0)
            yield Tokens(data[pos:cut], fresh, doc_lang[first:last], salts, powers)
            pos = cut


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, hash, n), summed per run of documents; with null word the
    number of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: list[str] = []
        totals: dict[int, int] = {}
        held: list[tuple] = []

        def merged():
            h, n, lang = (np.concatenate([x[i] for x in held]) for i in range(3))
            u, at, inv = np.unique(h, return_index=True, return_inverse=True)
            words = pa.concat_arrays([x[3] for x in held]).take(pa.array(at))
            return u, np.bincount(inv, weights=n).astype(np.int64), lang[at], words

        def out():
            u, n, lang, words = merged()
            names = pa.array(langs).take(pa.array(lang))
            for s in range(0, len(u), 50_000):
                e = slice(s, s + 50_000)
                yield pa.RecordBatch.from_arrays([names[e], words[e], pa.array(u[e].view(np.int64)), pa.array(n[e])],
                                                 names=["lang", "word", "hash", "n"])

        size = 0
        for t in tokens(batches, langs):
            for lang, n in zip(*map(np.ndarray.tolist, np.unique(t.lang, return_counts=True))):
                totals[lang] = totals.get(lang, 0) + n
            u, at, n = np.unique(t.hash, return_index=True, return_counts=True)
            held.append((u, n, t.lang[at], t.words(at)))
            size += len(u)
            if size >= RUN_WORDS:
                held = [merged()]
                size = len(held[0][0])
                if size >= RUN_WORDS // 3:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs[x] for x in totals]), pa.nulls(len(totals), pa.string()), pa.array([0] * len(totals), pa.int64()),
                 pa.array(list(totals.values()), pa.int64())], names=["lang", "word", "hash", "n"])

    return docs.mapInArrow(run, "lang string, word string, hash long, n long")


def neighbours(frequent: np.ndarray, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Words that the filter takes in, and which of these have such a word
    after them in their piece."""
    good = in_map(frequent, FILTER_BITS, t.hash)
    linked = good.copy()
    linked[-1:] = False
    linked[:-1] &= good[1:] & (t.piece[1:] == t.piece[:-1])
    return good, linked


PAIR_SLICES = 64


def pair_filter(docs: DataFrame, shared, min_count: int) -> np.ndarray:
    """Bit map of the slots (hashed pairs of frequent neighbours) with at least
    ``min_count`` pairs.  Runs send the slots of each slice as differences,
    byte plane by byte plane, which the shuffle compresses to a byte or two."""
    width = (1 << FILTER_BITS) // PAIR_SLICES
    planes = lambda x: x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    plain = lambda b: np.frombuffer(b, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        held, size = [], 0

        def out():
            slot, n = np.unique(np.concatenate(held), return_counts=True)
            ends = np.searchsorted(slot, np.arange(PAIR_SLICES + 1) * width)
            rows = [(k, planes(np.diff(slot[a:b], prepend=k * width)), planes(n[a:b]))
                    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])) if a < b]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *[
                pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2)]], names=["slice", "slots", "counts"])

        for t in tokens(batches, []):
            _, linked = neighbours(frequent, t)
            at = np.flatnonzero(linked)
            held.append((longer(t.hash[at], t.hash[at + 1]) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64))
            size += len(at)
            if size >= RUN_WORDS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, np.zeros(width, dtype=np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(sums >= min_count).tobytes()], pa.binary())],
                                              names=["slice", "bits"])

        for b in batches:
            for k, slots, n in zip(*(b.column(i).to_pylist() for i in range(3))):
                if k != at:
                    if at is not None:
                        yield out()
                    at, sums[:] = k, 0
                sums[np.cumsum(plain(slots))] += plain(n)                   # slots of one run differ
        if at is not None:
            yield out()

    rows = (docs.mapInArrow(run, "slice int, slots binary, counts binary").repartition("slice").sortWithinPartitions("slice")
            .mapInArrow(add, "slice int, bits binary").collect())           # a bit map of fixed size
    out = np.zeros((PAIR_SLICES, width // 8), dtype=np.uint8)
    for r in rows:
        out[r["slice"]] = np.frombuffer(r.bits, dtype=np.uint8)
    return out.reshape(-1)


class Prefixes:
    """The prefix of a suffix: its first word, one word more as long as the
    prefix is over the budget (``over[k]``: filter of prefixes of k + 1 words)."""

    def __init__(self, frequent: np.ndarray, pairs: np.ndarray, over: list[np.ndarray]):
        self.frequent, self.pairs, self.over = frequent, pairs, over

    def depths(self, t: Tokens, most: int) -> np.ndarray:
        """Words of the suffix at every word, up to the first rare word or pair."""
        good, linked = neighbours(self.frequent, t)
        at = np.flatnonzero(linked)
        linked[at] = in_map(self.pairs, FILTER_BITS, longer(t.hash[at], t.hash[at + 1]))
        return suffix_depths(good, linked, most)

    def keys(self, word, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key and length of each prefix; ``word(k, rows)``: hash of the k-th
        word of the suffixes ``rows``."""
        key = word(0, np.arange(len(depth))).copy()
        length = np.ones(len(depth), dtype=np.int8)
        rows = np.arange(len(depth))
        for k, over in enumerate(self.over, start=1):
            rows = rows[depth[rows] > k]
            rows = rows[in_map(over, FILTER_BITS, key[rows])]
            key[rows] = longer(key[rows], word(k, rows))
            length[rows] += 1
        return key, length


def longer(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return scramble(key * np.uint64(0x9E3779B97F4A7C15) + word)


def suffix_depths(good: np.ndarray, linked: np.ndarray, most: int) -> np.ndarray:
    """How many words from each good one on are linked, up to ``most``."""
    depth = good.astype(np.int8)
    run = good.copy()
    for k in range(min(most - 1, len(good))):
        run[:len(good) - k] &= linked[k:]
        run[len(good) - k:] = False
        depth += run
    return depth


def extensions(docs: DataFrame, shared, most: int) -> DataFrame:
    """(key, n): the extensions by one word of the prefixes over the budget."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Prefixes(*shared.value)
        held, size = [], 0

        def out():
            u, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], names=["key", "n"])

        for t in tokens(batches, []):
            depth = p.depths(t, most)
            at = np.flatnonzero(depth > len(p.over))
            key, length = p.keys(lambda k, rows: t.hash[at[rows] + k], depth[at])
            held.append(key[length > len(p.over)])
            size += len(held[-1])
            if size >= RUN_WORDS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return docs.mapInArrow(run, "key long, n long")


def packed(weights: np.ndarray, groups: int) -> np.ndarray:
    """A group for every bucket: heaviest first, to the lightest group."""
    out = np.zeros(len(weights), dtype=np.int32)
    load_of = [(0, g) for g in range(groups)]
    for b in np.argsort(-weights, kind="stable"):
        w, g = load_of[0]
        out[b] = g
        heapq.heapreplace(load_of, (w + int(weights[b]), g))
    return out


LIST = "`group` int, shared binary, depths binary, words binary, counts binary"


def suffix_lists(docs: DataFrame, shared, pack, most: int) -> DataFrame:
    """Per run of documents and group: the sorted suffixes that begin with its
    prefixes, front-coded (words in common with the one before, all words, the
    words that are not in common, occurrences)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, group_of = Prefixes(*shared.value), np.frombuffer(pack.value, dtype=np.int32)
        held, size = [], 0

        def out():
            words = np.concatenate([h for h, _ in held])
            depth = np.concatenate([d for _, d in held])
            at = np.flatnonzero(depth > 1)
            depth = depth[at]
            cols = [np.where(depth > k, words[np.minimum(at + k, len(words) - 1)], np.uint64(0)) for k in range(most)]
            key, _ = p.keys(lambda k, rows: cols[k][rows], depth)
            group = group_of[(key & np.uint64(len(group_of) - 1)).astype(np.int64)]
            order = np.lexsort((*cols[::-1], group))
            group, depth, cols = group[order], depth[order], [c[order] for c in cols]
            same = np.zeros(len(order), dtype=np.int8)                      # words in common with the one before
            equal = np.append(False, group[1:] == group[:-1])
            for c in cols:
                equal[1:] &= c[1:] == c[:-1]
                same += equal
            first = np.flatnonzero(~equal)                                  # equal suffixes are one, counted
            counts = np.diff(np.append(first, len(order))).astype("<u4")
            group, depth, same = group[first], depth[first], np.minimum(same[first], depth[first])
            n_new = (depth - same).astype(np.int64)
            new = np.empty(int(n_new.sum()), dtype="<u8")
            base = np.cumsum(n_new) - n_new
            for k, c in enumerate(cols):
                own = (same <= k) & (depth > k)
                new[base[own] + k - same[own]] = c[first][own]
            begin = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.empty(0, np.int64)
            ends = np.append(begin[1:], len(group))
            new_ends = np.append(base, len(new))[ends]

            def lists(values: np.ndarray, stop: np.ndarray) -> pa.Array:
                offset = np.append(0, stop * values.itemsize).astype(np.int32)
                return pa.BinaryArray.from_buffers(pa.binary(), len(stop), [None, pa.py_buffer(offset), pa.py_buffer(np.ascontiguousarray(values))])

            return pa.RecordBatch.from_arrays(
                [pa.array(group[begin]), lists(same.view(np.uint8), ends), lists(depth.view(np.uint8), ends),
                 lists(new, new_ends), lists(counts, ends)], names=["group", "shared", "depths", "words", "counts"])

        for t in tokens(batches, []):
            depth = p.depths(t, most)
            keep = (depth > 1) | np.append(False, depth[:-1] > 1)           # words of suffixes of two words and more
            for k in range(2, most):
                keep[k:] |= depth[:-k] > k
            held.append((t.hash[keep], depth[keep]))
            size += int(keep.sum())
            if size >= RUN_WORDS:
                yield out()
                held, size = [], 0
        if size:
            yield out()

    return docs.mapInArrow(run, LIST)


def decoded(rows: pa.Table, most: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Columns of word hashes (0: none), depths and counts of front-coded lists."""
    cols: list[list[np.ndarray]] = [[] for _ in range(most)]
    depths, counts = [], []
    for same, depth, words, n in zip(*(rows.column(c).to_pylist() for c in ("shared", "depths", "words", "counts"))):
        same, depth = np.frombuffer(same, dtype=np.uint8).astype(np.int64), np.frombuffer(depth, dtype=np.uint8)
        words = np.frombuffer(words, dtype="<u8")
        base = np.cumsum(depth - same) - (depth - same)
        line = np.arange(len(depth))
        for k in range(most):
            last = np.maximum.accumulate(np.where(same <= k, line, 0))      # the line that states the k-th word
            got = np.zeros(len(depth), dtype=np.uint64)
            has = depth > k
            got[has] = words[(base[last] + k - same[last])[has]]
            cols[k].append(got)
        depths.append(depth)
        counts.append(np.frombuffer(n, dtype="<u4"))
    return [np.concatenate(c) for c in cols], np.concatenate(depths), np.concatenate(counts).astype(np.int64)


def subtree_counts(lists: DataFrame, shared, min_count: int, most: int) -> DataFrame:
    """(words, n): the nodes of every group's subtree with at least
    ``min_count`` suffixes below, and all nodes above the group's prefixes."""

    def build(rows: pa.Table) -> pa.Table:
        p = Prefixes(*shared.value)
        cols, depth, n = decoded(rows, most)
        order = np.lexsort(cols[::-1])
        cols, depth, n = [c[order] for c in cols], depth[order], n[order]
        new = np.zeros(len(order), dtype=bool)
        new[:1] = True
        found, total, sizes = [], [], []
        for d in range(1, most + 1):
            new[1:] |= cols[d - 1][1:] != cols[d - 1][:-1]                  # a node of depth d begins
            if d == 1:
                continue
            at = np.flatnonzero(new)
            sums = np.add.reduceat(n, at)
            good = depth[at] >= d
            at, sums = at[good], sums[good]
            keep = sums >= min_count
            if d < len(p.over) + 1:                                         # may be above the prefix of its group
                _, length = p.keys(lambda k, r: cols[k][at[r]], np.full(len(at), d + 1))   # noqa: B023
                keep |= length > d
            at = at[keep]
            total.append(sums[keep])
            found.append(np.stack([c[at] for c in cols[:d]], axis=1).reshape(-1) if len(at) else np.empty(0, np.uint64))
            sizes.append(np.full(len(at), d))
        words = np.concatenate(found).view(np.int64)
        ends = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
        return pa.table({"words": pa.ListArray.from_arrays(pa.array(ends), pa.array(words)), "n": pa.array(np.concatenate(total))})

    return lists.groupBy("group").applyInArrow(build, "words array<long>, n long")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, most: int = MOST_WORDS,
                  budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of documents (lang, text): the frequent words (lang, word, hash, n), the
    frequent phrases of two words and more (words: hashes, n), and the number
    of all words (lang, total)."""
    spark = docs.sparkSession
    counted = written(word_counts(docs).groupBy("lang", "word").agg(F.min("hash").alias("hash"), F.sum("n").alias("n"))
                      .where(F.col("word").isNull() | (F.col("n") >= min_count)), "words")
    words = counted.where("word is not null")
    totals = counted.where("word is null").select("lang", F.col("n").alias("total"))
    n_all = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(MOST_BUCKET_BITS, max(LEAST_BUCKET_BITS, (4 * n_all // budget).bit_length()))
    weights = np.zeros(1 << bits, dtype=np.int64)
    level = words.select(F.col("hash").alias("key"), "n")
    over: list[np.ndarray] = []
    frequent = None                                                         # filters come with the first level
    while True:
        last = len(over) == most - 1
        fits = level if last else level.where(F.col("n") <= budget)
        for r in fits.groupBy(F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).alias("b")).agg(F.sum("n").alias("n")).collect():
            weights[r.b] += r.n                                             # a row per bucket
        if frequent is None:
            frequent, hot = bit_maps(level.select("key", (F.col("n") > budget).alias("hot")), FILTER_BITS)
            pairs = pair_filter(docs, spark.sparkContext.broadcast(frequent), min_count)
        elif not last:
            _, hot = bit_maps(level.select("key", (F.col("n") > budget).alias("hot")), FILTER_BITS)
        if last or not hot.any():
            break
        over.append(hot)
        shared = spark.sparkContext.broadcast((frequent, pairs, over))
        level = written(extensions(docs, shared, most).groupBy("key").agg(F.sum("n").alias("n")), "prefixes")
    groups = max(1, -(-int(weights.sum()) // budget), min(2 * spark.sparkContext.defaultParallelism, int(weights.sum()) // 10_000))
    pack = spark.sparkContext.broadcast(packed(weights, min(groups, len(weights))).tobytes())
    shared = spark.sparkContext.broadcast((frequent, pairs, over))
    parts = subtree_counts(suffix_lists(docs, shared, pack, most), shared, min_count, most)
    phrases = written(parts.groupBy("words").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count), "phrases")
    return words, phrases, totals


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT,
                 most: int = MOST_WORDS, top: int = TOP, budget: int = BUDGET) -> DataFrame:
    """The first ``top`` phrases of every language by the score of their
    weakest cut: lang, rank, phrase, a, l, r, n, score."""
    source = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"))
    words, phrases, totals = phrase_counts(source, min_count, most, budget)
    every = phrases.unionByName(words.select(F.array("hash").alias("words"), "n"))
    left = every.select(F.col("words").alias("left"), F.col("n").alias("l"))
    right = every.select(F.col("words").alias("right"), F.col("n").alias("r"))
    cuts = written(
        phrases.withColumnRenamed("n", "a").withColumn("k", F.explode(F.expr("sequence(1, size(words) - 1)")))
        .withColumn("left", F.expr("slice(words, 1, k)")).withColumn("right", F.expr("slice(words, k + 1, size(words) - k)"))
        .join(left, "left").join(right, "right").select("words", "k", "left", "right", "a", "l", "r"), "cuts")
    # as frequent with one word more
    part_of = (cuts.where("l = a and k = size(words) - 1").select(F.col("left").alias("words"))
               .unionByName(cuts.where("r = a and k = 1").select(F.col("right").alias("words"))).distinct())
    big = lambda c: f"cast({c} as decimal(19, 0))"
    score = F.expr(f"({big('a')} * {big('total')} * cast({SCALE} as decimal(4, 0))) div ({big('l')} * {big('r')})")
    names = words.select(F.col("hash").alias("first"), "lang").join(totals, "lang")
    scored = (cuts.join(part_of, "words", "left_anti").withColumn("first", F.col("words")[0]).join(names, "first")
              .withColumn("score", score).groupBy("words", "lang", "a", "total")
              .agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("words", "lang", "a", F.col("total").alias("n"), "m.score", "m.l", "m.r"))
    order = [F.desc("score"), F.desc("a")]
    best = written(scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top), "best")
    text = (best.select("words", F.posexplode("words").alias("pos", "hash")).join(words.select("hash", "word"), "hash")
            .groupBy("words").agg(F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w"))
            .select("words", F.concat_ws(" ", "w.word").alias("phrase")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return (best.join(text, "words").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of every language of ``documents``."""
    bounded_batches(spark)
    return collocations(pick(load(spark, sf_dir, "documents"), "lang", "text"))


#: every phrase counted by GROUP BY, for the small tables of the check
OP12_SQL = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang,
         list_filter(string_split_regex(unnest(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[\x20\x09]+'),
           lambda x: x <> '') AS w
  FROM documents),
f AS (
  SELECT lang, w[i:i + k - 1] AS p, k, COUNT(*) AS f
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces), range(1, 6) AS x(k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, SUM(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, p, k, f AS a FROM f WHERE k > 1 AND f >= 100),
gone AS (
  SELECT DISTINCT lang, unnest([p[1:k - 1], p[2:k]]) AS p, a FROM c WHERE k > 2),
kept AS (
  SELECT c.* FROM c ANTI JOIN (SELECT lang, p, MAX(a) AS a FROM gone GROUP BY lang, p) g
    ON g.lang = c.lang AND g.p = c.p AND g.a >= c.a),
cuts AS (
  SELECT kept.lang, kept.p, kept.a, x.f AS l, y.f AS r, n.n, j,
         ((1000::HUGEINT * kept.a * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM kept JOIN n USING (lang), range(1, 5) AS s(j), f x, f y
  WHERE j < kept.k AND x.lang = kept.lang AND x.p = kept.p[1:j] AND y.lang = kept.lang AND y.p = kept.p[j + 1:kept.k]),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
  FROM scored)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
