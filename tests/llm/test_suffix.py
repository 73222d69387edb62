"""Repeated substrings against brute force over all windows."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import suffix_dedup
from tests.llm.helpers import ODD_TEXTS, documents, empty, prose


def brute(docs: list[tuple], length: int) -> list[tuple]:
    """(spans, kept) of documents in order."""
    seen, out = set(), []
    for raw in docs:
        cover = np.zeros(len(raw), dtype=bool)
        for s in range(len(raw) - length + 1):
            w = raw[s:s + length]
            if w in seen:
                cover[s:s + length] = True
            seen.add(w)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], cover.astype(int), [0]])))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist()))
        out.append((spans, bytes(np.frombuffer(raw, dtype=np.uint8)[~cover])))
    return out


def texts(seed: int) -> list:
    rng = random.Random(seed)
    shared = [prose(rng, 40) for _ in range(4)]
    out = list(ODD_TEXTS)
    for _ in range(60):
        parts = [prose(rng, rng.randint(0, 30)) for _ in range(rng.randint(1, 4))]
        if rng.random() < 0.7:
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
        out.append(rng.choice([" ", "\n", ""]).join(parts))
    out += [out[-1], out[-2], out[-2], shared[0] * 3, "z" * 900, "xyz" * 400, shared[1][:99], shared[1][:100]]
    return out


@pytest.mark.parametrize("group_rows,block_rows,filter_bits", [(50_000, 20_000, 27), (3, 4, 10)])
def test_against_brute_force(spark, group_rows, block_rows, filter_bits):
    """The second setting sends most groups down the path for hot anchors,
    cuts tiny blocks and overfills the filters."""
    docs = texts(11)
    df = documents(spark, docs, extra=False)
    got = {r.doc_id: r for r in suffix_dedup.keep_first(
        df, group_rows=group_rows, block_rows=block_rows, filter_bits=filter_bits).collect()}
    assert len(got) == len(docs)
    for k, (spans, kept) in enumerate(brute([(t or "").encode() for t in docs], 100)):
        assert [(s.start, s.stop) for s in got[k].spans] == spans, k
        assert bytes(got[k].kept) == kept
        assert got[k].n_bytes == len((docs[k] or "").encode())


def test_order_of_ids_and_null_ids(spark):
    rng = random.Random(1)
    t = prose(rng, 60)
    df = spark.createDataFrame([(None, t), (7, t), (2, t + " end"), (-5, "x" + t)], "doc_id long, text string")
    got = {r.doc_id: sum(s.stop - s.start for s in r.spans) for r in suffix_dedup.keep_first(df).collect()}
    n = len(t.encode())
    assert got == {-5: 0, 2: n, 7: n, None: n}


def test_repeated_rows_are_one_document(spark):
    rng = random.Random(6)
    t, u = prose(rng, 60), prose(rng, 60)
    df = spark.createDataFrame([(1, t), (1, t), (2, u), (2, "x" + t), (3, t)], "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans)) for r in suffix_dedup.keep_first(df).collect())
    n, m = len(t.encode()), len(u.encode())
    assert got == sorted([(1, n, 0), (1, n, 0), (2, m, 0), (2, n + 1, n), (3, n, n)])


def test_segments_overlap(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 150)
    rng = random.Random(2)
    text = prose(rng, 400)
    raw = text.encode()
    windows = []
    for data, ends, _, offset in suffix_dedup.segments([text], 100):
        p = suffix_dedup.Pieces(data, ends, 100, 32, suffix_dedup.Powers())
        for s, n in zip((p.start + offset[p.doc]).tolist(), p.n.tolist()):
            windows += range(s, s + n)
    assert sorted(windows) == list(range(len(raw) - 99))


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    shared = prose(rng, 60).encode()
    data = np.frombuffer(prose(rng, 30).encode() + shared + prose(rng, 20).encode() + shared, dtype=np.uint8)
    p = suffix_dedup.Pieces(data, np.asarray([len(data)]), 100, 32, suffix_dedup.Powers())
    where = {}
    for at, n, off, anchor in zip(p.at.tolist(), p.n.tolist(), p.off.tolist(), p.anchor.tolist()):
        for s in range(at, at + n):
            key = data[s:s + 100].tobytes()
            assert where.setdefault(key, (anchor, at + off - s)) == (anchor, at + off - s)


def test_construction_against_sorted_windows():
    """The rounds find exactly the equal windows of unequal pieces."""
    rng = random.Random(4)
    length, k = 12, 4
    core = "abcd"
    pieces, off = [], []
    for _ in range(200):
        a, b = rng.randint(0, 8), rng.randint(4, 8)
        left = "".join(rng.choices("ab", k=a))
        right = "".join(rng.choices("ab", k=b))
        pieces.append((left + core + right).encode())
        off.append(a)
    rank = np.asarray(rng.sample(range(1000), len(pieces)))
    got = suffix_dedup.repeated_windows(pieces, np.asarray(off), rank, length, k)
    for c in range(-(length - k), 1):
        least: dict[bytes, int] = {}
        windows = {}
        for i, p in enumerate(pieces):
            s = off[i] + c
            if s >= 0 and s + length <= len(p):
                windows[i] = p[s:s + length]
                least[windows[i]] = min(least.get(windows[i], 10_000), int(rank[i]))
        for i in range(len(pieces)):
            want = i in windows and least[windows[i]] < rank[i]
            assert got[i, c + length - k] == want


def _decided(spark, docs: list, group_rows: int) -> tuple[set, set]:
    """Bytes (document, place) removed by the construction alone, and by all."""
    df = documents(spark, docs, extra=False).selectExpr("doc_id AS did", "0L AS h", "coalesce(text, '') AS text")
    often = suffix_dedup.anchors(df, 100, 32).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")
    every, hot = suffix_dedup.bit_maps(often.select(F.col("anchor").alias("key"), (F.col("n") > group_rows).alias("hot")), 27)
    maps = spark.sparkContext.broadcast((every.tobytes(), hot.tobytes()))
    rows = suffix_dedup.pieces(df, maps, 27, 100, 32, hot=False)
    got = suffix_dedup.construct(rows.repartition("anchor").sortWithinPartitions("anchor"), 100, 32, 20_000)
    both = [suffix_dedup.repeats(df, 100, 32, group_rows, 20_000, 27), got]
    every_byte, constructed = ({(r.did, b) for r in x.collect() for b in range(r.start, r.stop)} for x in both)
    return constructed, every_byte


def test_the_construction_decides_every_repeat(spark):
    """No digest and no other path removes a byte where no anchor is hot."""
    docs = texts(12)
    constructed, all_of_them = _decided(spark, docs, 50_000)
    assert constructed == all_of_them
    assert len(all_of_them) == sum(b - a for spans, _ in brute([(t or "").encode() for t in docs], 100) for a, b in spans)


def test_hot_anchors_are_collapsed_by_their_bytes(spark):
    """Copies and near copies of one text: the first piece of a class stands
    for all, differing pieces still meet in the construction."""
    rng = random.Random(8)
    base = prose(rng, 80)
    docs = [base] * 30
    for _ in range(12):
        ws = base.split()
        ws[rng.randrange(len(ws))] = prose(rng, 1)
        docs.append(" ".join(ws))
    rng.shuffle(docs)
    constructed, all_of_them = _decided(spark, docs, 15)
    assert len(constructed) < len(all_of_them) == sum(
        b - a for spans, _ in brute([t.encode() for t in docs], 100) for a, b in spans)


def test_repeated_rows_of_a_hot_text(spark):
    """Many rows of one document are one document on the path for hot anchors, too."""
    rng = random.Random(9)
    t = prose(rng, 60)
    df = spark.createDataFrame([(1, t)] * 20 + [(2, t)] * 20, "doc_id long, text string").repartition(3)
    got = suffix_dedup.keep_first(df, group_rows=5).collect()
    assert sorted((r.doc_id, len(r.kept)) for r in got) == [(1, len(t.encode()))] * 20 + [(2, 0)] * 20


def test_empty(spark):
    assert suffix_dedup.keep_first(empty(spark)).collect() == []


def test_hash_of_texts_is_sparks(spark):
    """xxhash64 of Spark and of the library agree (the tie-break of ids)."""
    got = spark.sql("SELECT xxhash64('abc') AS h").first().h
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"abc", 42)
