"""Collocations: counts, cuts and drops, against plain counting and SQL."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from quarry.llm import collocations as co
from quarry.llm.registry import ORACLE_SQL
from tests.llm.helpers import ODD_TEXTS, prose

SCHEMA = "doc_id long, text string, lang string, words string, n int"


def plain_counts(rows, most=5):
    f, total = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            ws = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(ws)
            for i in range(len(ws)):
                for k in range(1, min(most, len(ws) - i) + 1):
                    f[lang, tuple(ws[i:i + k])] += 1
    return f, total


def plain(rows, min_count, most, top):
    f, total = plain_counts(rows, most)
    cand = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= min_count}
    dropped = {(lang, p[i:j]) for (lang, p), a in cand.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
               if j - i < len(p) and f[lang, p[i:j]] <= a}
    by_lang = defaultdict(list)
    for (lang, p), a in cand.items():
        if (lang, p) not in dropped:
            cuts = [(1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            by_lang[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {(lang, r, p.decode(), -a, x, y, total[lang], -s) for lang, found in by_lang.items()
            for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)}


def corpus(rng, n):
    vocab = [prose(rng, 1) for _ in range(40)]
    common = [" ".join(rng.choices(vocab, k=k)) for k in (2, 3, 4, 5, 7)]
    rows = []
    for i in range(n):
        parts = [rng.choice(common) if rng.random() < .4 else " ".join(rng.choices(vocab, k=rng.randint(1, 4))) for _ in range(30)]
        sep = rng.choice([" ", ". ", ", ", "\n", "\t", " the the the "])
        rows.append((i, sep.join(parts).title() if i % 5 == 0 else sep.join(parts), rng.choice(["en", "de", None]), "clash", 1))
    return rows


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("budget,window", [(2_000_000, 2 << 20), (150, 1 << 12), (30, 1 << 10)])
def test_against_plain_counting(spark, monkeypatch, budget, window):
    """A small budget extends prefixes up to full depth; small windows and runs
    cut between pieces."""
    monkeypatch.setattr(co, "WINDOW_BYTES", window)
    monkeypatch.setattr(co, "RUN_WORDS", 700 if budget < 1000 else co.RUN_WORDS)
    rng = random.Random(8)
    rows = [*corpus(rng, 60), *[(1000 + i, t, "en", "x", 2) for i, t in enumerate(ODD_TEXTS)],
            (None, "no id but words words words", None, None, None), (3, "x y, X Y; x y", "xx", None, None)]
    rows += rows[:5]
    got = {tuple(r) for r in co.collocations(_df(spark, rows), min_count=6, top=25, budget=budget).collect()}
    want = plain(rows, 6, 5, 25)
    assert got == want and len(want) > 40
    if budget == 2_000_000:
        f, total = plain_counts(rows)
        words, phrases, totals = co.phrase_counts(_df(spark, rows).select("lang", "text"), 6, 5, 40)
        assert sorted(r.n for r in phrases.collect()) == sorted(a for x, a in f.items() if len(x[1]) > 1 and a >= 6)
        assert {(r.lang, r.word): r.n for r in words.collect()} == {(x[0], x[1][0]): a for x, a in f.items() if len(x[1]) == 1 and a >= 6}
        assert {r.lang: r.total for r in totals.collect()} == {k: v for k, v in total.items() if v}


def test_ties_at_the_last_rank(spark):
    rows = [(i, f"a{i} b{i}. " * 7, "en", "x", 1) for i in range(40)]
    got = {tuple(r) for r in co.collocations(_df(spark, rows), min_count=5, top=10).collect()}
    assert got == plain(rows, 5, 5, 10) and len(got) == 10


def test_products_over_64_bits(spark):
    """Scores are exact where a * n * 1000 passes 64 bits."""
    a, n, left, right = 3 * 10**12, 10**13 + 7, 3 * 10**12 + 1, 10**13
    big = lambda c: f"cast({c} as decimal(19, 0))"
    df = spark.createDataFrame([(a, n, left, right)], "a long, total long, l long, r long")
    got = df.selectExpr(f"({big('a')} * {big('total')} * cast(1000 as decimal(4, 0))) div ({big('l')} * {big('r')}) as s").first().s
    assert got == 1000 * a * n // (left * right)


def test_query_equals_sql_on_odd_tables(spark, tmp_path):
    rng = random.Random(9)
    for name, rows in (("odd", [*corpus(rng, 150), *[(1000 + i, t, None, "x", 2) for i, t in enumerate(ODD_TEXTS * 20)]]),
                       ("empty", []), ("wordless", [(1, None, None, None, 1), (2, " ., ", "en", None, 1)])):
        path = str(tmp_path / name)
        _df(spark, rows).write.parquet(f"{path}/documents.parquet")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/documents.parquet/*.parquet')")
        want = con.sql(ORACLE_SQL["op12_collocations"])
        got = Counter(map(tuple, co.op12_collocations(spark, path).select(*want.columns).collect()))
        assert got == Counter(want.fetchall())
        assert (len(got) > 20) == (name == "odd")


def test_pair_filter_keeps_frequent_pairs(spark, monkeypatch):
    monkeypatch.setattr(co, "RUN_WORDS", 500)                               # sums over many runs
    rows = corpus(random.Random(11), 50)
    every = np.full(1 << (co.FILTER_BITS - 3), 255, dtype=np.uint8)
    bits = co.pair_filter(_df(spark, rows).select("lang", "text"), spark.sparkContext.broadcast(every), 8)
    f, _ = plain_counts(rows, 2)
    frequent = sum(a >= 8 for x, a in f.items() if len(x[1]) == 2)
    assert frequent * 0.99 <= np.unpackbits(bits).sum() <= frequent        # fewer only by shared slots


def test_lists_come_back_as_sent(spark):
    rng = random.Random(10)
    rows = corpus(rng, 40)
    frequent = np.full(1 << (co.FILTER_BITS - 3), 255, dtype=np.uint8)
    sc = spark.sparkContext
    shared, pack = sc.broadcast((frequent, frequent, [])), sc.broadcast(np.zeros(4096, dtype=np.int32).tobytes())
    lists = co.suffix_lists(_df(spark, rows).select("lang", "text"), shared, pack, 5)
    cols, depth, n = co.decoded(lists.toArrow(), 5)
    f, _ = plain_counts(rows)
    sent = Counter()
    for d, c, *ws in zip(depth.tolist(), n.tolist(), *(x.tolist() for x in cols)):
        assert all(ws[:d]) and not any(ws[d:])
        for k in range(2, d + 1):
            sent[tuple(ws[:k])] += c
    assert sorted(sent.values()) == sorted(a for x, a in f.items() if len(x[1]) > 1)
