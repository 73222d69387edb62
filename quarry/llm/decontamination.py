"""Operator 2, benchmark decontamination by latent semantic retrieval.

1. Every document becomes the 32-bit hashes of its words (a table, so that
   texts are split once); document frequencies give idf weights over hashed
   dimensions, counted over the whole corpus.
2. Passages are windows of 2 x 16 words with a stride of 16; words of more
   than a tenth of the documents carry no weight and a run of one repeated
   word counts once.  Words inside three words in a row of a benchmark item do
   not count for this (nor for idf): a passage that is in a third of the
   documents does not make its own words common.  A randomised SVD of the TF-IDF passage matrix A: every
   task adds its passages with random signs to the rows of a small sketch
   S A, Spark sums the sketches, and the SVD of their fixed-size sum gives the
   leading right singular vectors and values.
3. Passages and the windows of benchmark items are projected onto the vectors
   and whitened (divided by the singular values, so that the directions of
   whole languages do not hide single passages); passages whose cosine with an
   item's window reaches ``cosine`` and that share a few content words are
   candidates.  Whitening shrinks a passage that fills a direction of its own,
   so items most of whose content words only the rule of step 2 keeps (hot
   items) need no cosine: passages that share enough of their content words
   are candidates whatever the cosine.
4. A candidate is verified against the words around the passage: the longest
   common subsequence of the item's content words must cover ``lcs`` of them,
   or, for paraphrases, ``lcs_paraphrase`` of them while the answer (the item's
   last sentence) has most of its content words there too.
5. Items shorter than a window fill too little of it for a sure cosine, so
   they are also sought word for word: runs of as many words as the item has,
   by a rolling hash, compared word by word.  Such finds carry 1.0 as cosine,
   lcs and answer.  Items under MIN_WORDS words are sought in this way only.

Items are a stated query set; they are worked on in blocks of ``item_block``
items against all passages, so their number is not limited and what a block
sends to the tasks is bounded.

Edge cases: null and empty texts and items have no words and never match;
repeated documents are matched each, repeated items count once; an item of one
word is in every document that has the word (``min_words`` leaves out items
under that many words); an empty benchmark or corpus gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, pick, text_chunks, words, written
from quarry.llm.hashing import Powers, word_hashes
from quarry.sources.tables import load

DIMS = 1 << 15
SKETCH = 128
RANK = 96
BLOCK = 16
COSINE = 0.4
#: content words that a candidate passage shares with the item
MIN_SHARED = 3
LCS = 0.7
LCS_PARAPHRASE = 0.5
ANSWER = 0.5
#: items of fewer words are sought word for word only
MIN_WORDS = 5
ITEM_BLOCK = 500
#: words in more than this share of documents are not content words
COMMON = 0.10
#: bits of the map of the benchmark's runs of three words (4 MB)
RUN_BITS = 25
PARTS = 64
SEED = 77


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, words): little-endian 32-bit word hashes."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for (ids,), texts in text_chunks(batches, limit=1 << 20):
            h, counts = word_hashes(texts, powers)
            raw, ends = h.tobytes(), np.cumsum(counts) * 4
            got = [raw[a:b] for a, b in zip((ends - counts * 4).tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays([ids, pa.array(got, pa.binary())], names=["doc_id", "words"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, words binary")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All hashes of a batch of documents end to end, and their counts."""
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype="<u4"), np.asarray([len(r) // 4 for r in raw], dtype=np.int64)


def _runs(h: np.ndarray) -> np.ndarray:
    """Places in a map of RUN_BITS bits of all runs of three words."""
    h = h.astype(np.uint64)
    mixed = (h[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + (h[2:] * np.uint64(0x165667B19E3779F9) >> np.uint64(7)))
    return (mixed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - RUN_BITS)


def run_map(texts: Iterator[str]) -> np.ndarray:
    """A bit map of the runs of three words of benchmark items."""
    bits, powers = np.zeros(1 << (RUN_BITS - 3), dtype=np.uint8), Powers()
    for t in texts:
        at = _runs(word_hashes([t], powers)[0])
        np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return bits


def _inside(h: np.ndarray, sizes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Words, of documents end to end, that are in a run of the map."""
    out = np.zeros(len(h), dtype=bool)
    if len(h) < 3:
        return out
    at = _runs(h)
    hit = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
    doc = np.repeat(np.arange(len(sizes)), sizes)
    hit &= doc[2:] == doc[:-2]
    for k in range(3):
        out[k:len(h) - 2 + k] |= hit
    return out


class WordRuns:
    """Finds whole items, given as word hashes, in documents end to end."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, items: list[list[int]]):
        self.items = items
        self.powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
        self.steps = [np.uint64(self.BASE), np.uint64(pow(self.BASE, -1, 1 << 64))]
        self.first = np.unique(np.asarray([w[0] for w in items], dtype=np.uint32))
        self.marks = np.zeros(1 << 16, dtype=bool)
        self.marks[self.first & 0xFFFF] = True
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted({len(w) for w in items}):
            own = np.asarray([k for k, w in enumerate(items) if len(w) == size])
            codes = np.asarray([self._sums(np.asarray(items[k], dtype=np.uint64))[-1] for k in own], dtype=np.uint64)
            order = np.argsort(codes, kind="stable")
            self.by_size[size] = codes[order], own[order]

    def _power(self, side: int, n: int) -> np.ndarray:
        """Powers 0 .. n-1 of the base, or of its inverse, modulo 2^64."""
        if len(self.powers[side]) < n:
            steps = np.full(max(n, 2 * len(self.powers[side])), self.steps[side])
            steps[0] = 1
            self.powers[side] = np.cumprod(steps)
        return self.powers[side][:n]

    def _sums(self, h: np.ndarray) -> np.ndarray:
        return np.append(np.uint64(0), np.cumsum(h.astype(np.uint64) * self._power(0, len(h))))

    def find(self, h: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, place in it, item) of every run that is an item."""
        at = np.flatnonzero(self.marks[h & np.uint32(0xFFFF)]) if self.items else np.zeros(0, dtype=np.int64)
        at = at[np.isin(h[at], self.first)]
        if not len(at):
            return
        ends = np.cumsum(sizes)
        doc = np.searchsorted(ends, at, side="right")
        sums, back = self._sums(h), self._power(1, len(h))
        for size, (codes, own) in self.by_size.items():
            inside = at + size <= ends[doc]
            place, d = at[inside], doc[inside]
            code = (sums[place + size] - sums[place]) * back[place]
            lo, hi = np.searchsorted(codes, code), np.searchsorted(codes, code, side="right")
            for k in np.flatnonzero(hi > lo).tolist():
                run = h[place[k]:place[k] + size].tolist()
                for i in own[lo[k]:hi[k]].tolist():
                    if self.items[i] == run:
                        yield int(d[k]), int(place[k] - ends[d[k]] + sizes[d[k]]), i


def frequencies(table: DataFrame, bits: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of documents with words; documents per dimension, counting words
    outside the runs of the benchmark and counting all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, raw, n = np.zeros(DIMS, dtype=np.int64), np.zeros(DIMS, dtype=np.int64), 0
        for b in batches:
            h, sizes = _lists(b.column(0))
            n += int((sizes > 0).sum())
            inside, dim = _inside(h, sizes, bits), h % DIMS
            start = 0
            for size in sizes:
                own, part = inside[start:start + size], dim[start:start + size]
                raw[part] += 1          # each dimension once
                df[part[~own] if own.any() else part] += 1
                start += size
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[n], df, raw]).reshape(1, -1).tolist(), pa.list_(pa.int64()))], names=["c"])

    counted = table.select("words").mapInArrow(count, "c array<long>")
    sums = counted.select(F.posexplode("c").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("c")).collect()
    total = np.zeros(2 * DIMS + 1, dtype=np.int64)       # 2 * DIMS + 1 rows
    for r in sums:
        total[r.k] = r.c
    return int(total[0]), total[1:DIMS + 1], total[DIMS + 1:]


def grid_of(h: np.ndarray, sizes: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content dimensions of documents laid end to end, as rows of BLOCK words
    (DIMS: no word, a common one or a repeat of the word before); the document
    of each row and the row's number in it.  A passage is a row and its
    successor in the same document."""
    sizes = sizes[sizes > 0]
    rows = -(-sizes // BLOCK)
    first = np.cumsum(rows) - rows
    at = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(first, sizes) + at // BLOCK
    dim = (h % DIMS).astype(np.int64)
    keep = ~common[dim]
    keep[1:] &= (h[1:] != h[:-1]) | (at[1:] == 0)
    grid = np.full((int(rows.sum()), BLOCK), DIMS, dtype=np.int64)
    grid[row[keep], at[keep] % BLOCK] = dim[keep]
    doc = np.repeat(np.arange(len(sizes)), rows)
    return grid, doc, np.arange(len(doc)) - np.repeat(first, rows)


def singular_vectors(table: DataFrame, idf: np.ndarray, common: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading right singular vectors (DIMS, rank) of the TF-IDF matrix of all
    passages (disjoint ones here) and their singular values.

    Z = S A with a sparse random sign matrix S (each passage is added to one
    of SKETCH rows with a random sign) keeps the row space of A; its SVD, of
    fixed size, gives the vectors."""
    spark = table.sparkSession
    width = DIMS // PARTS
    weight = np.append(idf, 0).astype(np.float64)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((SKETCH, DIMS), dtype=np.float32)
        rng = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                h, sizes = _lists(b.column(0).slice(at, 1000))
                if not len(h):
                    continue
                grid, _, number = grid_of(h, sizes, common)
                passage = np.cumsum(number % 2 == 0) - 1
                n = int(passage[-1]) + 1
                to, sign = rng.integers(0, SKETCH, n), rng.choice([-1.0, 1.0], n)
                cell = to[passage][:, None] * (DIMS + 1) + grid
                value = weight[grid] * sign[passage][:, None]
                total += np.bincount(cell.ravel(), weights=value.ravel(), minlength=SKETCH * (DIMS + 1)).reshape(SKETCH, -1)[:, :DIMS]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(PARTS), pa.int32()),
             pa.array([np.ascontiguousarray(total[:, k * width:(k + 1) * width]).tobytes() for k in range(PARTS)], pa.binary())],
            names=["part", "m"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for part, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                m = np.frombuffer(raw, dtype=np.float32)
                sums[part] = sums[part] + m if part in sums else m.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                         names=["part", "m"])

    # few, larger tasks: each sends one fixed-size matrix, in PARTS pieces
    tasks = 2 * spark.sparkContext.defaultParallelism
    shares = table.select("words").coalesce(tasks).mapInArrow(share, "part int, m binary")
    summed = shares.repartition(min(PARTS, tasks), "part").mapInArrow(add, "part int, m binary")
    z = np.zeros((SKETCH, DIMS))
    for r in summed.collect():                  # PARTS rows, SKETCH * DIMS numbers in all
        z[:, r.part * width:(r.part + 1) * width] = np.frombuffer(r.m, dtype=np.float64).reshape(SKETCH, width)
    _, value, vt = np.linalg.svd(z, full_matrices=False)
    keep = min(rank, int((value > 1e-9 * max(value[0], 1e-30)).sum()))
    return vt[:keep].T, value[:keep]


def common_subsequence(masks: dict[int, int], n: int, other: list[int]) -> int:
    """Length of the longest common subsequence with a pattern of n symbols
    given as bit masks (bit-parallel, whole numbers as rows)."""
    full = (1 << n) - 1
    v = full
    for s in other:
        m = masks.get(s)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _answer(text: str) -> str:
    """The last sentence of an item with at least three words, else its
    second half."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if len(words(p)) >= 3]
    if len(parts) > 1:
        return parts[-1]
    ws = text.split()
    return " ".join(ws[len(ws) // 2:])


class Item:
    """A benchmark item: content words as bit masks, answer words."""

    def __init__(self, key, text: str, common: np.ndarray, kept: np.ndarray):
        self.key, self.common = key, common
        self.words = word_hashes([text], Powers())[0].tolist()
        self.latent = len(self.words) >= MIN_WORDS
        content = [w for w in self.words if not common[w % DIMS]]
        if len(content) < MIN_WORDS:
            content = self.words
        self.n = len(content)
        # hot: most content words are common but for the item's own passages
        self.hot = self.latent and 2 * sum(bool(kept[w % DIMS]) for w in content) >= self.n > 0
        # a matched half, spread over its own length, leaves this much in some window
        self.need = max(MIN_SHARED, int(self.n * LCS_PARAPHRASE * min(1, 2 * BLOCK / len(self.words)) / 2)) if self.words else 0
        self.masks: dict[int, int] = {}
        for k, w in enumerate(content):
            self.masks[w] = self.masks.get(w, 0) | 1 << k
        chosen = set(content)
        self.answer = chosen.intersection(word_hashes([_answer(text)], Powers())[0].tolist())

    def passages(self) -> np.ndarray:
        """Content dimensions of the item's windows, filled up with DIMS (none
        of an item that is sought word for word only)."""
        if not self.latent:
            return np.full((1, 2 * BLOCK), DIMS, dtype=np.int64)
        h = np.asarray(self.words, dtype=np.int64)
        size = 2 * BLOCK
        starts = sorted({*range(0, max(1, len(h) - size + 1), BLOCK), max(0, len(h) - size)})
        out = np.full((len(starts), size), DIMS, dtype=np.int64)
        for k, s in enumerate(starts):
            w = h[s:s + size]
            d = w % DIMS
            keep = ~self.common[d]
            keep[1:] &= w[1:] != w[:-1]
            out[k, :keep.sum()] = d[keep]
        return out


def search(table: DataFrame, items: list[Item], rows: np.ndarray, common: np.ndarray, cosine: float, lcs: float,
           lcs_paraphrase: float, answer: float) -> DataFrame:
    """Verified (doc_id, item, passage, cosine, lcs, answer) of one block of
    items, the best passage per document and item."""
    rows = np.concatenate([rows, np.zeros((1, rows.shape[1]))]).astype(np.float32)
    parts = [i.passages() for i in items] or [np.full((0, 2 * BLOCK), DIMS)]
    owner = np.repeat(np.arange(len(items)), [len(p) for p in parts[:len(items)]])
    query = rows[np.concatenate(parts)].sum(axis=1)
    norm = np.sqrt((query * query).sum(axis=1, keepdims=True))
    query = np.where(norm > 0, query / np.where(norm == 0, 1, norm), 0).T
    has = np.zeros((len(items), DIMS + 1), dtype=bool)
    for k, p in enumerate(parts[:len(items)]):
        has[k, p.ravel()] = True
    has[:, DIMS] = False
    hot = np.flatnonzero([i.hot for i in items])
    need = np.asarray([items[k].need for k in hot], dtype=np.int64)
    # the hot items of each dimension, end to end
    hot_dim, hot_item = np.nonzero(has[hot].T) if len(hot) else (np.zeros(0, dtype=np.int64),) * 2
    first = np.searchsorted(hot_dim, np.arange(DIMS + 2))

    def hot_pairs(part: np.ndarray, at: np.ndarray, follows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number in ``at``, item) of passages, by their rows in ``part``, that
        share enough cells with a hot item."""
        cell = part.ravel()
        many = first[cell + 1] - first[cell]
        of = np.repeat(np.arange(len(cell)) // BLOCK, many)
        post = np.arange(many.sum()) + np.repeat(first[cell] - (np.cumsum(many) - many), many)
        rows_of = np.bincount(of * len(hot) + hot_item[post], minlength=len(part) * len(hot)).reshape(len(part), -1)
        shared = rows_of[at]
        shared[follows] += rows_of[at[follows] + 1]
        i, k = np.nonzero(shared >= need)
        return i, hot[k]

    first_window = np.searchsorted(owner, np.arange(len(items)))
    short = [k for k, i in enumerate(items) if len(i.words) < 2 * BLOCK]

    def verify(item: Item, near: list[int]) -> tuple[float, float] | None:
        got = common_subsequence(item.masks, item.n, near) / item.n
        if got < lcs_paraphrase:
            return None
        there = len(item.answer.intersection(near)) / max(1, len(item.answer))
        return (got, there) if got >= lcs or there >= answer else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        exact = WordRuns([items[k].words for k in short])
        for b in batches:
            at_row, found = [], []
            for at in range(0, b.num_rows if items else 0, 500):
                h, sizes = _lists(b.column(1).slice(at, 500))
                if not len(h):
                    continue
                grid, doc, number = grid_of(h, sizes, common)
                who = np.flatnonzero(sizes > 0)
                start, size = (np.cumsum(sizes) - sizes)[who], sizes[who]
                follows = np.append(doc[1:] == doc[:-1], False)
                passage = np.flatnonzero(follows | (number == 0))
                best: dict[tuple[int, int], tuple] = {}
                for d, w, k in exact.find(h, sizes):
                    best.setdefault((int(np.searchsorted(who, d)), short[k]), (w, 1.0, 1.0, 1.0))
                for s in range(0, len(passage), 4096):
                    x = passage[s:s + 4096]
                    lo, n = x[0], x[-1] + 2 - x[0]
                    # a few rows at a time: what is gathered stays in the cache
                    part = grid[lo:lo + n]
                    per = np.concatenate([rows[part[c:c + 128]].sum(axis=1) for c in range(0, len(part), 128)])
                    v = per[x - lo]
                    v[follows[x]] += per[x[follows[x]] - lo + 1]
                    length = np.sqrt((v * v).sum(axis=1, keepdims=True))
                    cos = (v / np.where(length == 0, 1, length)) @ query
                    i, j = np.divmod(np.flatnonzero(cos.ravel() >= cosine), cos.shape[1] or 1)
                    y, k = x[i], owner[j]
                    shared = has[k[:, None], grid[y]].sum(axis=1)
                    shared += has[k[:, None], grid[np.minimum(y + 1, len(grid) - 1)]].sum(axis=1) * follows[y]
                    near = shared >= MIN_SHARED
                    tried = [(y[near], k[near], cos[i, j][near])]
                    if len(hot):
                        i, k = hot_pairs(part, x - lo, follows[x])
                        tried.append((x[i], k, np.maximum.reduceat(cos, first_window, axis=1)[i, k]))
                    for r, k, c in zip(*(np.concatenate(t).tolist() for t in zip(*tried))):
                        d, item = int(doc[r]), items[k]
                        old = best.get((d, k))
                        if old and old[2] == 1.0:
                            continue
                        reach = len(item.words) + BLOCK
                        w = int(number[r]) * BLOCK
                        lo, hi = max(0, w - reach), min(int(size[d]), w + 2 * BLOCK + reach)
                        got = verify(item, h[start[d] + lo:start[d] + hi].tolist())
                        if got and (not old or got > old[2:4]):
                            best[d, k] = (w, c, *got)
                for (d, k), got in best.items():
                    at_row.append(at + int(who[d]))
                    found.append((k, *got))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(at_row, pa.int64())), pa.array([f[0] for f in found], pa.int32()),
                 *[pa.array([f[c] for f in found], t) for c, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()), (4, pa.float64()))]],
                names=["doc_id", "item", "passage", "cosine", "lcs", "answer"])

    id_type = table.schema["doc_id"].dataType.simpleString()
    return table.select("doc_id", "words").mapInArrow(
        run, f"doc_id {id_type}, item int, passage long, cosine double, lcs double, answer double")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", rank: int = RANK, cosine: float = COSINE, lcs: float = LCS,
          lcs_paraphrase: float = LCS_PARAPHRASE, answer: float = ANSWER, item_block: int = ITEM_BLOCK,
          min_words: int = 1) -> DataFrame:
    """(doc_id, item_id, passage, cosine, lcs, answer) of contaminated pairs;
    ``passage`` is the first word of the matched passage."""
    spark = docs.sparkSession
    table = written(hashed(docs, id_col, text_col), "words")
    queries = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").cast("string").alias("t")).where("t is not null").distinct()
    blocks = max(1, -(-queries.count() // item_block))

    def block(k: int) -> list:
        return queries.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(blocks)) == k).orderBy("item_id", "t").collect()

    n, df, raw = frequencies(table, run_map(r.t for k in range(blocks) for r in block(k)))
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    common = df > max(COMMON * n, 2)
    idf[common] = 0
    kept = (raw > max(COMMON * n, 2)) & ~common
    vectors, values = singular_vectors(table, idf, common, rank)
    rows = vectors / np.where(values == 0, 1, values) * idf[:, None]        # whitened: no topic outweighs the rest
    found = None
    for k in range(blocks):
        items = [i for i in (Item(r.item_id, r.t, common, kept) for r in block(k)) if len(i.words) >= max(1, min_words)]
        names = spark.createDataFrame([(p, i.key) for p, i in enumerate(items)],
                                      f"item int, item_id {queries.schema['item_id'].dataType.simpleString()}")
        hits = search(table, items, rows, common, cosine, lcs, lcs_paraphrase, answer).join(F.broadcast(names), "item")
        found = hits if found is None else found.unionByName(hits)
    return found.select("doc_id", "item_id", "passage", "cosine", "lcs", "answer")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return leaks(pick(load(spark, sf_dir, "documents"), "doc_id", "text"), pick(load(spark, sf_dir, "benchmark"), "item_id", "text"))
