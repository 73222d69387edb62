"""Sketches and VARIANT: bounds, exactness, plans, odd values."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import variant
from quarry.operators import sketches as sk
from quarry.plans.inspect import pairwise_operators, plan_text

SF001 = "/root/testdata/sf0.001"


def test_kll_rank_error_and_plan(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 5}", rng.lognormvariate(0, 2)) for i in range(30_000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    for r in sk.kll_quantiles(df, "g", "v", (0.05, 0.5, 0.95)).collect():
        mine = np.sort([v for g, v in rows if g == r.g])
        assert abs(np.searchsorted(mine, r.estimate) / len(mine) - r.q) <= sk.RANK_ERROR
    plan = plan_text(sk.kll_quantiles(df, "g", "v"), "simple")
    assert "Sort" not in plan and plan.count("Exchange hashpartitioning(g") == plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("share", [0.004, 0.05, 0.5])
def test_heavy_hitters_are_exact(spark, share):
    rng = random.Random(4)
    values = [rng.choice([7, -3, 10**15, None, rng.randrange(10**6), rng.randrange(40)]) for _ in range(8_000)]
    df = spark.createDataFrame([(v, "x") for v in values], "k long, n string").repartition(5)
    got = {r.value: r.n for r in sk.heavy(df, "k", share).collect()}
    assert got == {v: n for v, n in Counter(values).items() if n >= share * len(values)}
    assert sk.heavy(df.limit(0), "k", share).collect() == []


def test_heavy_hitters_shuffle_candidates_only(spark):
    df = spark.range(50_000).select((F.col("id") % 49_990).alias("k")).union(spark.range(5_000).select(F.lit(5).alias("k")))
    raw = df.agg(F.count_min_sketch("k", F.lit(sk.CM_ERROR), F.lit(sk.CM_CONFIDENCE), F.lit(sk.CM_SEED))).first()[0]
    sketch = sk.CountMin(bytes(raw))
    truth = Counter([i % 49_990 for i in range(50_000)] + [5] * 5_000)
    est = sketch.estimate(np.arange(49_990))
    exact = np.asarray([truth[i] for i in range(49_990)])
    assert sketch.total == 55_000 and (est >= exact).all()
    assert (est - exact <= sk.CM_ERROR * 55_000 + 1).mean() > sk.CM_CONFIDENCE
    assert (est >= 0.01 * 55_000).sum() == 1                                # one candidate of 49,990 values
    plan = plan_text(sk.heavy(df, "k"), "simple")
    assert plan.index("Exchange hashpartitioning(value") < plan.index("ArrowEvalPython")   # filtered below the shuffle


def test_theta_sets(spark):
    rows = sk.theta_sets(spark, SF001).collect()
    assert rows and all(r.union_ok and r.both_ok and r.only_a_ok for r in rows)
    assert not pairwise_operators(plan_text(sk.theta_sets(spark, SF001)))
    df = spark.range(40_000).selectExpr("id % 4 AS g", "id % 25000 AS m")
    merged = sk.theta_sketches(df, "g", "m").agg(F.theta_union_agg("sketch").alias("s")).select(F.theta_sketch_estimate("s")).first()[0]
    assert abs(merged - 25_000) <= sk.THETA_ERROR * 25_000                  # merged across groups, no row read again


def test_variant_shapes(spark):
    texts = ['{"k": 1}', '{"k": "2"}', '{"k": {"x": 1}}', "[1, 2]", '{"k":', "", None, "null", "3", '"s"', '{"K": 5}', '{"k": 1.5}',
             '{"k": 99999999999999999999}', '{"a": [{"k": 7}]}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    rows = df.select("i", *variant.paths_of("j", {"k": ("$.k", "long"), "deep": ("$.a[0].k", "int"), "text": ("$.k", "string")})).orderBy("i").collect()
    assert [r.k for r in rows] == [1, 2, None, None, None, None, None, None, None, None, None, 1, None, None]
    assert [r.deep for r in rows] == [None] * 13 + [7]
    assert rows[1].text == "2" and rows[4].text is None
