"""Operator 6, token counts: rank-synchronous merging over ragged arrays.

The pieces of a BPE vocabulary are held as a sorted table of mergeable pairs
(left symbol, right symbol) -> (rank, merged symbol).  Texts are cut where no
piece can cross (before a run of word marks), distinct pre-tokens of a chunk
are laid end to end as one ragged numpy array of symbols, and every round
applies each sequence's lowest-rank pair at once in all sequences.  Symbols
that survive are counted; a symbol outside the vocabulary counts its UTF-8
bytes (byte fallback).  Counts of pre-tokens are remembered per worker.

Edge cases: null text counts as empty; an empty text has 0 tokens; repeated
rows are counted each; texts of any length are processed whole (a very long
unbroken run needs few rounds, because all occurrences of the lowest pair are
merged together whenever that provably equals merging them one by one).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import bounded_batches, pick, text_chunks, tokens_path, worker_cache
from quarry.sources.tables import load

MODEL = "piece_bpe_32k.model"
MARK = "▁"
NONE = np.int64(1 << 40)            # rank of a pair that cannot merge
CACHE_ENTRIES = 600_000


class PieceTable:
    """Vocabulary of a BPE model with byte fallback, as merge tables."""

    def __init__(self, model_path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = {}
        for i in range(sp.get_piece_size()):
            if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)):
                pieces[sp.id_to_piece(i)] = sp.get_score(i)
        order = {p: r for r, p in enumerate(sorted(pieces, key=lambda p: -pieces[p]))}
        ranks: dict[str, int] = {}
        last, at = None, -1             # equal scores share a rank
        for p in order:
            if pieces[p] != last:
                last, at = pieces[p], order[p]
            ranks[p] = at
        symbols = dict(order)
        for p in order:
            for ch in p:
                symbols.setdefault(ch, len(symbols))
        self.n = len(symbols)
        self.in_vocab = np.zeros(self.n + 1, dtype=bool)
        self.in_vocab[[order[p] for p in order]] = True
        keys, rank, made, touching = [], [], [], set()
        for p in order:
            for i in range(1, len(p)):
                left, right = symbols.get(p[:i]), symbols.get(p[i:])
                if left is not None and right is not None:
                    keys.append(left * self.n + right)
                    rank.append(ranks[p])
                    made.append(order[p])
                touching.add((symbols[p[i - 1]], symbols[p[i]]))
        self.no_pair = len(keys)        # index of "cannot merge"
        self.keys = np.append(np.asarray(keys, dtype=np.int64), -1)
        self.rank = np.append(np.asarray(rank, dtype=np.int64), NONE)
        self.made = np.append(np.asarray(made, dtype=np.int64), 0)
        # open-addressing table of pair -> index, filled one probe at a time
        self.bits = max(10, int(len(keys)).bit_length() + 2)
        self.slots = np.full(1 << self.bits, self.no_pair, dtype=np.int32)
        todo, step = np.arange(len(keys)), 0
        while len(todo):
            at = (self._home(self.keys[todo]) + step) & ((1 << self.bits) - 1)
            free = self.slots[at] == self.no_pair
            self.slots[at[free]] = todo[free]
            todo, step = todo[self.slots[at] != todo], step + 1
        self.probes = step
        self.touching = np.sort(np.asarray([a * self.n + b for a, b in touching], dtype=np.int64))
        self.char = np.full(0x110000, self.n, dtype=np.int32)      # n: unknown
        for s, i in symbols.items():
            if len(s) == 1:
                self.char[ord(s)] = i
        #: no piece holds a mark after another character: texts may be cut there
        self.cut_at_marks = not any(MARK in p.lstrip(MARK) for p in order)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair in the merge table, or the last (no merge)."""
        want = left * self.n + right
        want[(left == self.n) | (right == self.n)] = -2     # unknown characters
        home = self._home(want)
        found = self.slots[home]
        todo = np.flatnonzero((self.keys[found] != want) & (found != self.no_pair))
        for step in range(1, self.probes):
            if not len(todo):
                break
            got = self.slots[(home[todo] + step) & ((1 << self.bits) - 1)]
            found[todo] = got
            todo = todo[(self.keys[got] != want[todo]) & (got != self.no_pair)]
        found[todo] = self.no_pair
        return found


def count_sequences(table: PieceTable, seqs: list[str]) -> np.ndarray:
    """Number of surviving symbols of every sequence."""
    totals = np.zeros(len(seqs), dtype=np.int64)
    lens = np.fromiter(map(len, seqs), dtype=np.int64, count=len(seqs))
    if not lens.sum():
        return totals
    code = np.frombuffer("".join(seqs).encode("utf-32-le"), dtype=np.uint32)
    sym = table.char[code].astype(np.int64)
    owner = np.repeat(np.arange(len(seqs)), lens)
    # unknown characters become byte symbols; they never merge
    unknown = ~table.in_vocab[sym]
    alone = sym == table.n
    width = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
    # cut between neighbours that no piece holds side by side
    near = sym[:-1] * table.n + sym[1:]
    at = np.searchsorted(table.touching, near)
    at[at == len(table.touching)] = 0
    joined = (table.touching[at] == near) & (owner[1:] == owner[:-1]) & ~alone[1:] & ~alone[:-1]
    first = np.append(True, ~joined)
    seg = np.cumsum(first) - 1
    seg_owner = owner[first]
    weight = np.where(unknown, width, 1)
    pair = table.pair(sym[:-1], sym[1:])
    pair = np.append(np.where(joined, pair, table.no_pair), table.no_pair)
    while True:
        rank = table.rank[pair]
        starts = np.flatnonzero(np.append(True, seg[1:] != seg[:-1]))
        low = np.minimum.reduceat(rank, starts)
        open_ = low < NONE
        sizes = np.diff(np.append(starts, len(seg)))
        keep = np.repeat(open_, sizes)
        if not keep.all():              # finished sequences leave
            done = seg_owner[seg[~keep]]
            if len(done) * 8 < len(seqs):
                np.add.at(totals, done, weight[~keep])
            else:
                totals += np.bincount(done, weights=weight[~keep], minlength=len(seqs)).astype(np.int64)
            if not open_.any():
                return totals
            sym, seg, weight, pair, rank = sym[keep], seg[keep], weight[keep], pair[keep], rank[keep]
            low, sizes = low[open_], sizes[open_]
        low = np.repeat(low, sizes)
        hit = np.flatnonzero(rank == low)
        # of overlapping occurrences (a run) every second one
        new_run = np.append(True, (np.diff(hit) != 1) | (seg[hit[1:]] != seg[hit[:-1]]))
        run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run_start) % 2 == 0]
        lead = np.append(True, seg[hit[1:]] != seg[hit[:-1]])
        made = table.made[pair[hit]]
        if not lead.all():
            # merging all at once equals merging from the left one by one if no
            # pair that arises on the way ranks as low; else only the leftmost
            after = sym.copy()
            after[hit] = made
            before = hit - 1
            before = np.where(np.isin(before, hit + 1), before - 1, before)
            same = (before >= 0) & (seg[before] == seg[hit])
            left = np.where(same, table.rank[table.pair(after[before], made)], NONE)
            nxt = np.minimum(hit + 2, len(sym) - 1)
            same = (hit + 2 < len(sym)) & (seg[nxt] == seg[hit])
            right = np.where(same, table.rank[table.pair(made, sym[nxt])], NONE)
            bad = (np.minimum(left, right) <= low[hit])
            group = np.cumsum(lead) - 1
            unsafe = np.bincount(group, weights=bad, minlength=group[-1] + 1)[group] > 0
            take = lead | ~unsafe
            hit, made = hit[take], made[take]
        sym = sym.copy()
        sym[hit] = made
        weight = weight.copy()
        weight[hit] = 1
        stay = np.ones(len(sym), dtype=bool)
        stay[hit + 1] = False
        place = np.cumsum(stay) - 1
        sym, seg, weight, pair = sym[stay], seg[stay], weight[stay], pair[stay].copy()
        now = place[hit]
        marked = np.zeros(len(sym), dtype=bool)
        marked[now] = True
        marked[now[now > 0] - 1] = True
        again = np.flatnonzero(marked)
        end = again + 1 >= len(sym)
        nxt = np.where(end, again, again + 1)
        linked = ~end & (seg[nxt] == seg[again])
        pair[again] = np.where(linked, table.pair(sym[again], sym[nxt]), table.no_pair)


class Counts(dict):
    """Known counts; an unknown pre-token counts 0 for now and is noted."""

    unseen: list[str]

    def __missing__(self, key: str) -> int:
        self.unseen.append(key)
        return 0


_RUN = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def pre_tokens(text: str) -> list[str]:
    """The text as the model sees it, cut before every run of marks; a leading
    mark is left out where the piece starts with exactly one."""
    if "  " not in text and MARK not in text and text[0] != " ":
        return text.split(" ")
    return [t[1:] if t[0] == MARK else t for t in _RUN.findall(MARK + text.replace(" ", MARK))]


def count_texts(model_path: str, texts: list[str | None]) -> list[int]:
    """Tokens of every text under the model, cached per distinct pre-token."""
    state = worker_cache("pieces:" + model_path)
    if "table" not in state:
        state["table"], state["counts"] = PieceTable(model_path), Counts()
    table, counts = state["table"], state["counts"]
    if not table.cut_at_marks:
        return [int(x) for x in count_sequences(
            table, [MARK + t.replace(" ", MARK) if t else "" for t in texts])]
    if len(counts) > CACHE_ENTRIES:
        counts.clear()
    totals, unseen = [], []
    for t in texts:
        counts.unseen = []
        totals.append(sum(map(counts.__getitem__, pre_tokens(t))) if t else 0)
        unseen.append(counts.unseen)
    new = sorted(set().union(*unseen), key=len)
    start = 0
    while start < len(new):             # like lengths together, bounded arrays
        stop, size = start, 0
        while stop < len(new) and (stop == start or size + len(new[stop]) < 400_000):
            size += len(new[stop]) + 1
            stop += 1
        part = new[start:stop]
        counts.update(zip(part, count_sequences(table, [MARK + w for w in part]).tolist()))
        start = stop
    return [n + sum(map(counts.__getitem__, ws)) for n, ws in zip(totals, unseen)]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 model: str = MODEL) -> DataFrame:
    """(id, n_bytes, n_tokens) of every row; a scan without any shuffle."""
    path = tokens_path(model)
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (ids,), texts in text_chunks(batches):
            n_bytes = [len(t.encode()) if t else 0 for t in texts]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n_bytes, pa.int64()), pa.array(count_texts(path, texts), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"])

    id_type = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")


def op6_token_counts(spark: SparkSession, sf_dir: str, limit: int = 4096) -> DataFrame:
    bounded_batches(spark)
    counts = count_tokens(pick(load(spark, sf_dir, "documents"), "doc_id", "text"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
