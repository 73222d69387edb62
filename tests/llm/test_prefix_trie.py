"""Conversation prefix trie: against plain dictionaries of prefixes."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import prefix_trie
from quarry.llm.registry import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string, sig string, parent int"


def plain(rows) -> Counter:
    """Rows of the contract, from (conv_id, turn, role, text, ...) rows."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            raw = f"{len(role.encode())}:{role}{text}".encode()
            own[c].append((turn is not None, turn or 0, hashlib.md5(raw).digest(), role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        seq = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]  # % as in SQL
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append((c, len(seq) == d))
    out = Counter()
    for node, ms in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(y[:len(x)] == x and len(y) > len(x) for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(map(str, sorted(c for c, e in ms if e)))
        out[(min(ms)[0], len(node), min(members[node[:-1]])[0] if node else None, len(ms), len(kids), len(leaves), saved,
             hashlib.sha256(ends.encode()).hexdigest())] += 1
    return out


def _made(spark, rows, tmp_path, name="t"):
    path = str(tmp_path / name)
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/conversations.parquet")
    return path


def _got(spark, path) -> Counter:
    return Counter(map(tuple, prefix_trie.op13_prefix_trie(spark, path).collect()))


def _forest(rng, n, copies=3) -> list[tuple]:
    """Conversations that share beginnings, some ids missing."""
    texts = ["", "a", "b", "ü", "same", None]
    rows = []
    for c in range(-3, n):
        if c % 11 == 10:
            continue                                                        # a family may lack its first one
        like = rng.choice([None, *range(copies)])
        for turn in range(rng.choice([1, 2, 3, 9, 14])):
            text = rng.choice(texts) if like is None else texts[(turn * 7 + like) % 6]
            rows.append((c, turn, "user" if turn % 2 else None, text, "clash", 1))
    return rows


@pytest.mark.parametrize("a,b", [(0, 1), (0, 5), (3, 4), (4, 7), (4, 8), (6, 7), (5, 6), (7, 1000)])
def test_two_fattest(a, b):
    best = max(range(a + 1, b + 1), key=lambda x: x & -x)
    assert prefix_trie.two_fattest(a, b) & -prefix_trie.two_fattest(a, b) == best & -best
    assert a < prefix_trie.two_fattest(a, b) <= b


@settings(max_examples=120, deadline=None)
@given(st.sets(st.lists(st.sampled_from([b"x", b"y", b"z"]), max_size=9).map(tuple), min_size=1, max_size=40), st.integers(1, 9))
def test_trie_holds_every_sequence_at_its_exit(found, batch):
    seqs = [prefix_trie.prefixes(list(s)) for s in found]
    trie = prefix_trie.ZFastTrie()
    trie.insert_all(seqs, batch)
    for k, s in enumerate(seqs):
        v, edge = trie.locate(s)
        assert edge is None and trie.end[v] == k and trie.extent[v] == len(s) - 1
    for v in range(1, len(trie.extent)):
        u = trie.parent[v]
        assert trie.extent[u] < trie.extent[v]
        assert trie.handles[trie.of[v][prefix_trie.two_fattest(trie.extent[u], trie.extent[v])]] == v
        assert trie.end[v] is not None or len(trie.children[v]) > 1         # compacted
    assert len(trie.handles) == len(trie.extent) - 1


@pytest.mark.parametrize("part_turns", [100_000, 30])
def test_against_plain_prefixes(spark, tmp_path, monkeypatch, part_turns):
    """Few parts, and parts of a few sequences, where most nodes are shared."""
    monkeypatch.setattr(prefix_trie, "PART_TURNS", part_turns)
    monkeypatch.setattr(prefix_trie, "CHUNK_BITS", 2)                       # classes of several chunks
    rng = random.Random(6)
    rows = _forest(rng, 90)
    rows += [(3, 0, "user", "a", "x", 1), (3, 0, "user", "a", "x", 1), (3, None, None, None, None, None),
             (None, 0, "user", "no conversation", "x", 1), (200, 5, "user", "x" * 5000, "x", 1)]
    path = _made(spark, rows, tmp_path)
    assert _got(spark, path) == plain(rows)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/conversations.parquet/*.parquet')")
    assert Counter(con.sql(ORACLE_SQL["op13_prefix_trie"]).fetchall()) == plain(rows)


def test_copies_and_one_long_conversation(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_TURNS", 40)
    rows = [(c, t, "user", f"turn {t}", "x", 1) for c in range(60) for t in range(3)]
    rows += [(100, t, "user", f"turn {t}", "x", 1) for t in range(300)]
    assert _got(spark, _made(spark, rows, tmp_path)) == plain(rows)


def test_empty_table_and_turnless_conversation(spark, tmp_path):
    assert _got(spark, _made(spark, [], tmp_path, "none")) == Counter()
    rows = [(c, 0, "user", f"only turn of {c}", "x", 1) for c in (6, 7, 8, 11, 13)]   # no base: short ones have no turn left
    assert _got(spark, _made(spark, rows, tmp_path, "short")) == plain(rows)
