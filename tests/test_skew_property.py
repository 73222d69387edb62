"""Randomised: the split path of ``ordered_scan`` equals the plain window for
any mix of key sizes, ties, NULL keys and NULL values, and any budget."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators.skew import Out, ordered_scan

ROW = st.tuples(st.sampled_from(["a", "b", "c", None]),     # key (skewed by weights below)
                st.integers(0, 6),                           # order value with many ties
                st.one_of(st.none(), st.integers(-5, 5)))    # value with NULLs

OUTS = [Out("row_number", "rn"), Out("rank", "rk"), Out("dense_rank", "dr"),
        Out("running_sum", "rs", "v"), Out("last_non_null", "ln", "v"), Out("group_count", "n"),
        Out("group_sum", "gs", "v")]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=120), hot_a=st.integers(0, 150),
       budget=st.integers(1, 40))
def test_split_equals_plain(spark, rows, hot_a, budget):
    data = [("a", i % 7, i % 3 - 1) for i in range(hot_a)] + rows
    df = spark.createDataFrame([(k, o, i, v) for i, (k, o, v) in enumerate(data)],
                               "k string, o int, id long, v long")
    order = [("o", True), ("id", True)]
    plain = ordered_scan(df, ["k"], order, OUTS, peers=1, max_group_rows=10**9)
    split = ordered_scan(df, ["k"], order, OUTS, peers=1, max_group_rows=budget)
    key = lambda r: r["id"]
    assert sorted(plain.collect(), key=key) == sorted(split.collect(), key=key)
