"""The skew path of ``ordered_scan`` (hot keys split across tasks) must give
exactly what the plain window gives."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quarry.catalog import entries
from quarry.operators.skew import Out, exact_percentiles, hot_keys, ordered_scan
from tools.oracle_check import compare

from .conftest import SF01, hot_budget


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, a small key, a hot NULL key; tied and NULL values."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        rows.append(("A", rnd.randint(0, 50), i, rnd.choice([None, 1.5, 2.0, 3.25])))
    for i in range(3000, 3040):
        rows.append(("B", rnd.randint(0, 5), i, rnd.choice([None, 4.0])))
    for i in range(3040, 3600):
        rows.append((None, rnd.randint(0, 20), i, rnd.choice([None, 0.5])))
    return spark.createDataFrame(rows, "k string, o int, id long, v double")


OUTS = [Out("row_number", "rn"), Out("rank", "rk"), Out("dense_rank", "dr"),
        Out("running_sum", "rs", "v"), Out("last_non_null", "ln", "v"),
        Out("group_count", "n"), Out("group_sum", "gs", "v")]


def _rows(df):
    return sorted(df.collect(), key=lambda r: r["id"])


def test_hot_keys_detected(spark, skewed):
    hot, total = hot_keys(skewed, ["k"], 100)
    assert {r["k"] for r in hot} == {"A", None}
    assert total == 3000 + 560


@pytest.mark.parametrize("order", [[("o", True), ("id", True)], [("o", False), ("id", True)]])
def test_ordered_scan_hot_equals_plain(spark, skewed, order):
    outs = OUTS if all(a for _, a in order) else [o for o in OUTS if o.kind != "last_non_null"]
    plain = ordered_scan(skewed, ["k"], order, outs, peers=1, max_group_rows=10**9)
    split = ordered_scan(skewed, ["k"], order, outs, peers=1, max_group_rows=100)
    assert _rows(plain) == _rows(split)


def test_exact_percentiles_hot(spark, skewed):
    df = skewed.where(F.col("v").isNotNull()).withColumn("x", F.col("o") * 1.0 + F.col("id") / 1e4)
    want = {r["k"]: (r["p50"], r["p90"]) for r in
            df.groupBy("k").agg(F.percentile("x", 0.5).alias("p50"),
                                F.percentile("x", 0.9).alias("p90")).collect()}
    with hot_budget(spark, 50):
        got = {r["k"]: (r["p50"], r["p90"]) for r in
               exact_percentiles(df, ["k"], "x", {"p50": 0.5, "p90": 0.9}).collect()}
    assert want.keys() == got.keys()
    for k in want:
        assert want[k] == pytest.approx(got[k], rel=1e-12)


SKEW_QUERIES = ["theta_join", "window_rank", "asof_join", "window_offset",
                "window_rows_frame", "window_range_frame", "exact_percentiles"]


@pytest.mark.parametrize("name", SKEW_QUERIES)
def test_queries_with_every_key_hot(spark, duck, name):
    """Budget below every group size: each key takes the split path."""
    with hot_budget(spark, 25):
        problems, rows, _ = compare(spark, duck, name, entries()[name], SF01)
    assert not problems, problems


def test_too_many_hot_keys_splits_every_key(spark, skewed, monkeypatch):
    """Beyond MAX_HOT_KEYS the key list is not broadcast; every key takes the
    range-split path and the offsets stay bounded by the piece count."""
    import quarry.operators.skew as skew
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 1)
    order = [("o", True), ("id", True)]
    plain = ordered_scan(skewed, ["k"], order, OUTS, peers=1, max_group_rows=10**9)
    split = ordered_scan(skewed, ["k"], order, OUTS, peers=1, max_group_rows=30)
    assert _rows(plain) == _rows(split)


def test_many_small_keys_all_split(spark):
    """Thousands of keys, all split: only keys crossing piece boundaries get
    offsets, the rest keep their local values."""
    import quarry.operators.skew as skew
    df = spark.range(6000).selectExpr("id % 1500 AS k", "id AS o", "id % 7 AS v")
    outs = [Out("row_number", "rn"), Out("running_sum", "rs", "v"), Out("group_count", "n")]
    plain = skew._cold(df, ["k"], [("o", True)], outs, 1)
    split = skew._hot(df, ["k"], [("o", True)], outs, 1, 16)
    key = lambda r: r["o"]
    assert sorted(plain.collect(), key=key) == sorted(split.collect(), key=key)


@pytest.mark.parametrize("asc", [True, False])
def test_tie_group_larger_than_budget_spans_pieces(spark, asc):
    """3 distinct values over 2,000 rows of one key, budget 50: each tie
    group spans many pieces; rank and dense_rank must still be exact."""
    df = spark.range(2000).selectExpr("'k' AS k", "CAST(id % 3 AS INT) AS o", "id", "id % 5 AS v")
    order = [("o", asc), ("id", True)]
    outs = [Out("row_number", "rn"), Out("rank", "rk"), Out("dense_rank", "dr"),
            Out("group_count", "n")]
    plain = ordered_scan(df, ["k"], order, outs, peers=1, max_group_rows=10**9)
    split = ordered_scan(df, ["k"], order, outs, peers=1, max_group_rows=50)
    assert _rows(plain) == _rows(split)
