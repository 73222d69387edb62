"""Window functions: ranking, offsets, row and range frames, top-k per group.

Every query here is partitioned by a key that may be skewed (a market
segment holds a fifth of all customers, one user may own a third of all
events).  They are therefore built on ``ordered_scan``, which takes Spark's
window (one shuffle on the key) for ordinary keys and splits a hot key across
tasks: row numbers, ranks, running sums, lag / lead, first / last, N-row frames.
A range frame is the running sum at ts minus the running sum just before
ts - 1 day (an as-of lookup, again an ordered scan).

Top-k per group keeps Spark's own window: ``row_number() <= k`` is planned
with a ``WindowGroupLimit`` below the shuffle, so a hot key contributes at
most k rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions.numeric import cents, scale_back
from quarry.operators.skew import Out, _ns_join, ordered_scan
from quarry.sources.tables import Tables


def ntile(rn: str, n: str, k: int):
    """NTILE(k) from a 1-based row number and the group size (SQL semantics:
    the first n % k buckets get one extra row)."""
    q = F.floor(F.col(n) / k)
    r = F.col(n) - q * k
    big = r * (q + 1)                       # rows in the larger buckets
    return (F.when(F.col(rn) <= big, F.floor((F.col(rn) - 1) / (q + 1)) + 1)
             .otherwise(r + F.floor((F.col(rn) - 1 - big) / q) + 1)).cast("bigint")


@query("window_rank", oracle="""
SELECT c_custkey, c_mktsegment, c_acctbal,
       CAST(ROW_NUMBER() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS rn,
       CAST(RANK() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS BIGINT) AS rnk,
       CAST(DENSE_RANK() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC) AS BIGINT) AS drnk,
       CAST(NTILE(4) OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS quartile
FROM customer
""")
def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = Tables(spark, sf_dir).customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    s = ordered_scan(cust, ["c_mktsegment"], [("c_acctbal", False), ("c_custkey", True)],
                     [Out("row_number", "rn"), Out("rank", "rnk"), Out("dense_rank", "drnk"),
                      Out("group_count", "_n")], peers=1)
    return s.select("c_custkey", "c_mktsegment", "c_acctbal", "rn", "rnk", "drnk",
                    ntile("rn", "_n", 4).alias("quartile"))


EVENT_ORDER = [("ts", True), ("event_id", True)]


@query("window_offset", oracle="""
SELECT event_id, user_id, ts,
       LAG(value) OVER w AS prev_value,
       LEAD(value) OVER w AS next_value,
       FIRST_VALUE(event_type) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_type,
       LAST_VALUE(event_type) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_type
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id)
""")
def window_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "event_type", "value")
    s = ordered_scan(ev, ["user_id"], EVENT_ORDER,
                     [Out("lag", "prev_value", "value"), Out("lead", "next_value", "value"),
                      Out("first", "first_type", "event_type"), Out("last", "last_type", "event_type")])
    return s.select("event_id", "user_id", "ts", "prev_value", "next_value", "first_type", "last_type")


FRAME_ROWS = 7


@query("window_rows_frame", oracle="""
SELECT event_id, user_id, ts,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) / COUNT(*) OVER w AS moving_avg
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)
""")
def window_rows_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7-row moving average (NULL where all seven values are)."""
    ev = (Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
          .withColumn("_v", cents("value")))
    s = ordered_scan(ev, ["user_id"], EVENT_ORDER,
                     [Out("row_number", "_rn"), Out("rows_sum", "_sum", "_v", FRAME_ROWS)])
    n = F.least(F.col("_rn"), F.lit(FRAME_ROWS))
    return s.select("event_id", "user_id", "ts",
                    (F.col("_sum").cast("double") / 100 / n).alias("moving_avg"))


@query("window_range_frame", oracle="""
SELECT event_id, user_id, ts,
       COUNT(*) OVER w AS n_last_day,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) OVER w AS DOUBLE) AS value_last_day
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW)
""")
def window_range_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RANGE 1 day preceding, as one ordered scan.

    Rows are first totalled per distinct (user, ts) -- RANGE peers share a
    frame.  Each such point is stacked with a probe at ts - 1 day that sorts
    before any point at the same time.  One running sum over the stack gives,
    at a point, the totals through it, and at its probe the totals strictly
    before ts - 1 day; the frame is the difference.
    """
    ev = Tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "value")
    return range_frame_last_day(ev)


def range_frame_last_day(ev: DataFrame) -> DataFrame:
    """COUNT(*) and SUM(value) over RANGE 1 DAY PRECEDING .. CURRENT ROW per
    user, ordered by ts (see ``window_range_frame``).  Rows with a NULL ts
    are peers of each other only, as in SQL."""
    per_ts = (ev.where(F.col("ts").isNotNull()).groupBy("user_id", "ts")
                .agg(F.count(F.lit(1)).alias("_c"), F.count("value").alias("_k"),
                     F.coalesce(F.sum(cents("value")), F.lit(0)).alias("_s")))
    points = per_ts.select("user_id", F.col("ts").alias("_t"), F.lit(1).alias("_side"),
                           "_c", "_k", "_s", F.col("ts").alias("_origin"))
    probes = per_ts.select("user_id", (F.col("ts") - F.expr("INTERVAL 1 DAY")).alias("_t"),
                           F.lit(0).alias("_side"), F.lit(0).cast("bigint").alias("_c"),
                           F.lit(0).cast("bigint").alias("_k"), F.lit(0).cast("bigint").alias("_s"), F.col("ts").alias("_origin"))
    scan = ordered_scan(points.unionByName(probes), ["user_id"], [("_t", True), ("_side", True)],
                        [Out("running_sum", "_cn", "_c"), Out("running_sum", "_ck", "_k"),
                         Out("running_sum", "_cs", "_s")])
    side = F.col("_side")
    frame = (scan.groupBy("user_id", F.col("_origin").alias("ts"))
                 .agg(F.max(F.when(side == 1, F.col("_cn"))).alias("cn"),
                      F.max(F.when(side == 1, F.col("_ck"))).alias("ck"),
                      F.max(F.when(side == 0, F.col("_ck"))).alias("bk"),
                      F.max(F.when(side == 1, F.col("_cs"))).alias("cs"),
                      F.max(F.when(side == 0, F.col("_cn"))).alias("bn"),
                      F.max(F.when(side == 0, F.col("_cs"))).alias("bs")))
    frame = frame.select("user_id", "ts", (F.col("cn") - F.col("bn")).alias("n_last_day"),
                         # a frame of only NULL values has no sum
                         F.when(F.col("ck") > F.col("bk"), scale_back(F.col("cs") - F.col("bs"), 2))
                          .alias("value_last_day"))
    timed = (_ns_join(ev, frame, ["user_id", "ts"], "inner")
               .select("event_id", "user_id", "ts", "n_last_day", "value_last_day"))
    untimed = ev.where(F.col("ts").isNull())
    peers = (untimed.groupBy("user_id")
                    .agg(F.count(F.lit(1)).alias("n_last_day"),
                         scale_back(F.sum(cents("value")), 2).alias("value_last_day")))
    nulls = (_ns_join(untimed, peers, ["user_id"], "inner")
             .select("event_id", "user_id", "ts", "n_last_day", "value_last_day"))
    return timed.unionByName(nulls)


@query("topk_per_group", oracle="""
SELECT l_suppkey, rn, l_orderkey, l_linenumber, l_partkey, l_extendedprice
FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
             CAST(ROW_NUMBER() OVER (PARTITION BY l_suppkey
                 ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS BIGINT) AS rn
      FROM lineitem) t
WHERE rn <= 3
""")
def topk_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem.select(
        "l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    w = Window.partitionBy("l_suppkey").orderBy(
        F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey")
    return (li.withColumn("rn", F.row_number().over(w).cast("bigint"))
              .where(F.col("rn") <= 3)
              .select("l_suppkey", "rn", "l_orderkey", "l_linenumber", "l_partkey",
                      "l_extendedprice"))

