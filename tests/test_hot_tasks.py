"""One user with two thirds of the rows, sixteen files: no task gets them all."""

from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quarry.operators.joins import asof_join, semi_join
from quarry.operators.skew import Out, exact_percentiles, ordered_scan
from quarry.operators.subqueries import below_own_average
from quarry.plans.inspect import plan_text
from quarry.session import ROCKSDB_PROVIDER
from quarry.streaming.runner import _start
from quarry.streaming.stateful import reduce_batches
from tests.conftest import SF01, conf, hot_budget


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("hot") / "events")
    (spark.read.parquet(f"{SF01}/events.parquet")
     .withColumn("user_id", F.when(F.col("event_id") % 3 > 0, F.lit(7)).otherwise(F.col("user_id")))
     .repartition(16).write.parquet(path))
    return spark.read.parquet(path)


def largest_share(spark, df) -> float:
    with conf(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        # every column is used, or the scan itself would be pruned away
        rows = (df.withColumn("_p", F.spark_partition_id()).groupBy("_p")
                .agg(F.count("*").alias("n"), F.max(F.xxhash64(*df.columns))).collect())
    return max(r.n for r in rows) / sum(r.n for r in rows)


OUTS = [Out("row_number", "rn"), Out("lag", "before", "value"), Out("lead", "after", "value"),
        Out("first", "a", "event_type"), Out("last", "z", "event_type"), Out("rows_sum", "s", "value", 7)]


def test_ordered_scan_spreads_a_hot_user(spark, hot):
    order = [("ts", True), ("event_id", True)]
    plain = ordered_scan(hot, ["user_id"], order, OUTS)
    with hot_budget(spark, 500):
        split = ordered_scan(hot, ["user_id"], order, OUTS)
        assert largest_share(spark, split) < 0.4
    assert largest_share(spark, plain) > 0.6
    cols = ["event_id", "rn", "before", "after", "a", "z"]
    assert split.select(*cols).exceptAll(plain.select(*cols)).count() == 0
    sums = (split.select("event_id", "s").join(plain.select("event_id", F.col("s").alias("t")), "event_id")
            .where(F.abs(F.col("s") - F.col("t")) > 1e-6))
    assert sums.count() == 0


def test_asof_and_percentiles_spread_a_hot_user(spark, hot):
    views = (hot.where("event_type = 'view'")
             .select(F.col("event_id").alias("vid"), "user_id", F.col("ts").alias("vts"), F.col("value").alias("v")))
    with hot_budget(spark, 500):
        df = asof_join(hot.select("event_id", "user_id", "ts"), views, "user_id", "ts", "vts", ["vid", "vts", "v"])
        assert largest_share(spark, df) < 0.4
        split = exact_percentiles(hot, ["user_id"], "value", {"m": 0.5}, count="n")
        got = {r.user_id: (r.m, r.n) for r in split.collect()}
    want = {r.user_id: (r.m, r.n) for r in
            hot.groupBy("user_id").agg(F.expr("percentile(value, 0.5)").alias("m"), F.count("*").alias("n")).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in want)


def test_correlated_average_of_a_hot_part_is_broadcast(spark):
    li = (spark.read.parquet(f"{SF01}/lineitem.parquet")
          .withColumn("l_partkey", F.when(F.col("l_orderkey") % 3 > 0, F.lit(1)).otherwise(F.col("l_partkey"))))
    split, plain = below_own_average(li, max_group_rows=1000), below_own_average(li)
    assert "BroadcastHashJoin" in plan_text(split)
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0


def test_semi_join_deduplicates_the_right_side(spark):
    text = plan_text(semi_join(spark, SF01))
    assert "HashAggregate" in text


def test_streams_start_with_rocksdb_from_a_plain_session(spark):
    """Whatever ran before: provider, state partitions and local session
    merging hold for the start call, and the session gets its own back."""
    seen = {}

    class Writer:
        def start(self):
            for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions",
                      "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"):
                seen[k] = spark.conf.get(k)
            return "query"

    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    with conf(spark, "spark.sql.streaming.stateStore.providerClass", other), \
            conf(spark, "spark.sql.shuffle.partitions", "50"):
        assert _start(spark, Writer()) == "query"
        assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == other
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50"
    assert list(seen.values()) == [ROCKSDB_PROVIDER, "4", "true"]


def test_keyed_state_gets_one_row_per_user_and_batch():
    pdf = pd.DataFrame({"user_id": [1] * 900 + [2, None], "event_id": range(902), "value": [float(k) for k in range(902)],
                        "us": [*range(900), None, 5]})
    out = pd.concat(reduce_batches(iter([pdf, pdf.iloc[:10], pdf.iloc[:0]])))
    assert len(out) == 4
    rows = {(None if pd.isna(r.user_id) else int(r.user_id), int(r.n)): r for r in out.itertuples()}
    assert rows[1, 900].last_us == 899 and rows[1, 10].last_us == 9
    assert pd.isna(rows[2, 1].last_us) and rows[None, 1].last_us == 5
