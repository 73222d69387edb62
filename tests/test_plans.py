"""Plan shapes that the design depends on."""

from __future__ import annotations

import pytest

from pyspark.sql import functions as F

from quarry.catalog import queries
from quarry.plans.inspect import pairwise_operators, plan_text

from .conftest import SF001, SF01, hot_budget

Q = queries()


def plan(spark, name, sf=SF001):
    return plan_text(Q[name](spark, sf))


def test_filters_and_columns_reach_the_scan(spark):
    p = plan(spark, "scan_filter_project")
    assert "PushedFilters: [IsNotNull(l_shipdate)" in p
    assert "GreaterThanOrEqual(l_shipdate" in p and "LessThan(l_quantity,24.0)" in p
    # only the referenced columns are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint," \
           "l_linenumber:int,l_quantity:double,l_extendedprice:double,l_discount:double," \
           "l_shipdate:timestamp_ntz>" in p


def test_dimensions_broadcast_after_preaggregation(spark):
    tree = plan(spark, "inner_join_chain").split("\n\n")[0]
    # the tree is printed top-down: the two dimension joins sit above the
    # final aggregate on the nation key, i.e. they join <= 25 rows
    assert tree.index("BroadcastHashJoin") < tree.index("HashAggregate")
    above = tree[:tree.index("HashAggregate")]
    assert above.count("BroadcastHashJoin") == 2


def test_topk_per_group_limits_before_shuffle(spark):
    p = plan(spark, "topk_per_group")
    assert "WindowGroupLimit" in p


def test_global_topk_never_sorts_the_table(spark):
    p = plan(spark, "topk_global")
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("name", ["theta_join", "interval_join", "asof_join",
                                  "window_range_frame", "correlated_subquery", "lateral_join"])
def test_no_pairwise_join(spark, name):
    assert pairwise_operators(plan(spark, name)) == []


def test_interval_join_keys_on_user_and_bucket(spark):
    p = plan(spark, "interval_join")
    assert "_b" in p and "_rb" in p


def test_partition_pruning_on_written_table(spark):
    p = plan(spark, "sink_roundtrip")
    assert "PartitionFilters: [isnotnull(l_returnflag" in p


def test_hot_keys_are_range_split(spark, monkeypatch):
    """Hot rows are range-partitioned and written before the query's own plan
    reads them back in pieces, each a contiguous range of the full order."""
    from quarry.operators import skew
    written = []
    real = skew.scratch_path
    monkeypatch.setattr(skew, "scratch_path", lambda *a: written.append(real(*a)) or written[-1])
    with hot_budget(spark, 25):
        p = plan(spark, "window_rank", SF01)
    assert "BroadcastHashJoin" in p
    assert written and written[0].rsplit("/", 1)[1] in p
    pieces = (spark.read.parquet(written[0]).groupBy("c_mktsegment", "_pid")
              .agg(F.max("c_acctbal").alias("hi"), F.min("c_acctbal").alias("lo")).collect())
    by_key = {}
    for r in pieces:
        by_key.setdefault(r.c_mktsegment, []).append((r._pid, r.hi, r.lo))
    assert all(len(ps) > 1 for ps in by_key.values())
    for ps in by_key.values():
        ps.sort()                                   # c_acctbal descending over pieces
        assert all(a[2] >= b[1] for a, b in zip(ps, ps[1:]))


def test_no_python_in_builtin_queries(spark):
    python_ops = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
    for name in ("pricing_summary", "window_rank", "asof_join", "string_funcs", "json_funcs"):
        p = plan(spark, name)
        assert not any(op in p for op in python_ops), name


def test_two_phase_udaf_merges_in_the_jvm(spark):
    p = plan(spark, "grouped_udaf")
    assert "MapInPandas" in p
    assert "partial_sum" in p          # states merged by a partial aggregate
    assert "AggregateInPandas" not in p


def test_udtf_is_arrow_vectorized(spark):
    p = plan(spark, "udtf_tokens")
    assert "ArrowEvalPythonUDTF" in p


def test_stream_static_join_reuses_dimension_partitioning(spark, monkeypatch):
    """With broadcast off, each micro-batch shuffles only its events: the
    dimension side is the pre-partitioned cache, no exchange above it."""
    import contextlib
    import io

    import quarry.streaming.queries as sq
    import quarry.streaming.runner as runner
    from .conftest import conf
    plans = []
    real = runner.run_available_now

    def spy(df, paths, *a, **k):
        q = real(df, paths, *a, **k)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            q.explain()
        plans.append(buf.getvalue().split("== Initial Plan ==")[0])
        return q

    monkeypatch.setattr(sq, "run_available_now", spy)
    with conf(spark, "spark.sql.autoBroadcastJoinThreshold", -1):
        assert sq.stream_static_join(spark, SF001).count() > 0
    final = plans[0]
    join_part = final[:final.index("InMemoryRelation")]
    assert "SortMergeJoin" in join_part
    assert join_part.count("Exchange hashpartitioning") == 1     # the events side only
    assert "InMemoryTableScan" in join_part


@pytest.mark.parametrize("name", ["window_offset", "window_rows_frame", "window_rank"])
def test_offsets_and_row_frames_shuffle_once(spark, name):
    df = Q[name](spark, SF001)
    assert plan_text(df, "simple").count("Exchange ") == 1


def test_percentiles_read_the_table_once(spark):
    assert plan_text(Q["exact_percentiles"](spark, SF001), "simple").count("FileScan parquet") == 1
