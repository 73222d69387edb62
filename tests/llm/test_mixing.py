"""Mixing: targets, schedule and pieces, against plain computation."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import mixing
from quarry.llm.registry import ORACLE_SQL
from tests.llm.helpers import ODD_TEXTS, documents, prose


def test_word_counts():
    texts = [*ODD_TEXTS, "a\x1cb c", "x y", "\x0b\x0c\r"]
    want = [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for t in texts]
    whole = pa.array(texts, pa.string())
    assert mixing.word_counts(whole).tolist() == want
    assert mixing.word_counts(whole.slice(3, 9)).tolist() == want[3:12]
    assert mixing.word_counts(pa.array([], pa.string())).tolist() == []


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1000, 1], [0, 0, 5], [0, 0], [1, 1, 1, 10**15], [7]])
def test_targets(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    goal = mixing.targets(sizes, weights)
    assert sum(goal) == pytest.approx(sum(sizes))
    assert all(0 <= t <= 3 * s for t, s in zip(goal, sizes))
    open_ = [t / w for t, s, w in zip(goal, sizes, weights) if t < 3 * s]
    assert not open_ or max(open_) == pytest.approx(min(open_))             # the others share by weight


def test_schedule_is_even(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLOT_RUN", 100)                            # many runs: ranks go on across them
    words = [500, 300, 150, 49, 0, 1]
    table, n = mixing.schedule(spark, words, 997)
    rows = table.collect()
    assert len({r.slot for r in rows}) == len(rows) and sum(n) == len(rows)
    for ix, w in enumerate(words):
        mine = sorted((r.block, r.slot) for r in rows if r.ix == ix)
        assert [b for b, _ in mine] == list(range(n[ix])) and [s for _, s in mine] == sorted(s for _, s in mine)
        assert (n[ix] > 0) == (w > 0)
        for k, (_, s) in enumerate(mine):                                   # low discrepancy at every prefix
            assert abs(k + 1 - (s + 1) * w / 1000) < 4


def _mixed(spark, rows):
    return mixing.Mix(spark.createDataFrame(rows, "doc_id long, source string, text string, size string"), block_words=16)


def test_pieces_against_plain_streams(spark, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE_ROWS", 8)                            # a hot source is many ranges
    rng = random.Random(4)
    rows = [(i, "hot" if i % 3 else f"s{i % 7}", prose(rng, rng.choice([0, 1, 5, 80])), "clash") for i in range(300)]
    rows += [(None, None, "null source here", "x"), (5, "s5", None, "x"), rows[7], rows[7], (900, "tiny", "one", "x")]
    mix = _mixed(spark, rows)
    pieces = mix.pieces.collect()
    slots = defaultdict(list)
    for p in pieces:
        slots[p.slot].append(p)
    assert all(len({p.ix for p in ps}) == 1 for ps in slots.values())       # a slot is a block of one source
    size = {(d.ix, d.part, d.row): d for d in mix.documents.collect()}
    assert len(size) == len(rows)
    taken, by_source, words = Counter(), Counter(), Counter()
    for p in pieces:
        key = (p.ix, p.part, p.row)
        assert 0 <= p.start and p.n_words > 0 and p.start + p.n_words <= size[key]["size"]
        taken[key] += p.n_words
        by_source[p.ix] += p.n_words
        words[p.slot] += p.n_words
    for ix, (_, source_size, target) in enumerate(mix.sources):
        assert by_source[ix] == int(target) <= 3 * source_size
        mine = [n for s, n in words.items() if slots[s][0].ix == ix]
        assert not mine or max(mine) - min(mine) <= 1                       # equal blocks
    assert all(n <= 3 * size[k]["size"] for k, n in taken.items())
    covered = Counter((p.ix, p.part, p.row, p["pass"], w) for p in pieces for w in range(p.start, p.start + p.n_words))
    assert max(covered.values()) == 1                                       # no word twice in a pass


def test_query_equals_sql_on_odd_tables(spark, tmp_path):
    rng = random.Random(5)
    texts = [*ODD_TEXTS, *[prose(rng, 40) for _ in range(60)]]
    docs = documents(spark, texts)
    for name, rows in (("odd", docs.withColumnRenamed("key", "source")),
                       ("empty", docs.withColumnRenamed("key", "source").limit(0)),
                       ("wordless", docs.withColumnRenamed("key", "source").where("text = '' or text is null"))):
        path = str(tmp_path / name)
        rows.write.parquet(f"{path}/documents.parquet")
        got = mixing.op11_mixing(spark, path)
        again = mixing.op11_mixing(spark, path)
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
        want = con.sql(ORACLE_SQL["op11_mixing"])
        rows = Counter(map(tuple, got.select(*want.columns).collect()))
        assert rows == Counter(want.fetchall())
        assert rows == Counter(map(tuple, again.select(*want.columns).collect()))


def test_too_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_SOURCES", 2)
    with pytest.raises(ValueError, match="more than 2 sources"):
        _mixed(spark, [(i, f"s{i}", "a b", "x") for i in range(3)])


def test_points_are_golden_ratio():
    assert mixing.PHI / 2**64 == pytest.approx((5**0.5 - 1) / 2)
    assert np.uint64(mixing.PHI) % np.uint64(2) == 1
