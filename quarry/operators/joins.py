"""Joins: inner chains, outer, semi, anti, band (theta), interval and as-of.

Scale notes
-----------
* Fact-to-fact joins (lineitem-orders) are left to Catalyst + AQE: a
  sort-merge join on the key, demoted at run time to a broadcast when one
  side turns out small, with skewed partitions split (skewJoin).
* Only the star-schema dimensions (region, nation) are hinted for
  broadcast, behind ``bounded_broadcast``'s row check.
* Aggregate before joining where the result allows it (A4, A5, A8): the
  shuffle then carries one row per key instead of one per line.
* Inequality joins always keep an equality key.  The band self-join is
  answered as a ranking (no pairs are formed); the interval join adds a time
  bucket to the key so one busy user is spread over many tasks; the as-of
  join is an ordered scan (``operators/skew.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions.numeric import cents, disc_price_units, scale_back, sum_units
from quarry.functions.time import ntz_lit, ntz_micros
from quarry.operators.skew import Out, ordered_scan
from quarry.plans.broadcast import bounded_broadcast
from quarry.sources.tables import Tables


@query("inner_join_chain", oracle="""
SELECT r_name, n_name,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
            AS DOUBLE) AS revenue,
       COUNT(*) AS n_lines
FROM customer
JOIN orders ON c_custkey = o_custkey
JOIN lineitem ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey AND c_nationkey = s_nationkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
  AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'
GROUP BY r_name, n_name
""")
def inner_join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    orders = (t.orders.where((F.col("o_orderdate") >= ntz_lit("1996-01-01"))
                             & (F.col("o_orderdate") < ntz_lit("1998-01-01")))
                      .select("o_orderkey", "o_custkey"))
    lines = t.lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
    cust = t.customer.select("c_custkey", "c_nationkey")
    supp = t.supplier.select("s_suppkey", "s_nationkey")
    # Join order: orders x customer first (the smaller pair), so the
    # lineitem-sized intermediate is shuffled once by orderkey and once by
    # suppkey -- never a third time by custkey.
    order_nation = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    facts = (lines.join(order_nation, F.col("l_orderkey") == F.col("o_orderkey"))
                  .join(supp, (F.col("l_suppkey") == F.col("s_suppkey"))
                        & (F.col("c_nationkey") == F.col("s_nationkey"))))
    # Aggregate on the nation key first: the dimension joins see <= 25 rows.
    per_nation = (facts.groupBy("s_nationkey")
                       .agg(sum_units(disc_price_units()).alias("rev"), F.count(F.lit(1)).alias("n")))
    nation = bounded_broadcast(t.nation)
    region = bounded_broadcast(t.region)
    return (per_nation.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                      .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
                      .select("r_name", "n_name", scale_back(F.col("rev"), 4).alias("revenue"),
                              F.col("n").alias("n_lines")))


@query("left_join_nulls", oracle="""
SELECT o_orderkey, o_orderstatus,
       COUNT(l_orderkey) AS n_lines,
       CAST(COALESCE(SUM(CAST(l_quantity AS DECIMAL(12,2))), 0) AS DOUBLE) AS total_qty
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
GROUP BY o_orderkey, o_orderstatus
""")
def left_join_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    per_order = (t.lineitem.groupBy("l_orderkey")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("l_quantity")).alias("q")))
    return (t.orders.select("o_orderkey", "o_orderstatus")
             .join(per_order, F.col("o_orderkey") == F.col("l_orderkey"), "left")
             .select("o_orderkey", "o_orderstatus",
                     F.coalesce("n", F.lit(0)).cast("bigint").alias("n_lines"),
                     scale_back(F.coalesce("q", F.lit(0)), 2).alias("total_qty")))


@query("full_outer_join", oracle="""
WITH a AS (SELECT c_custkey AS custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING'),
     b AS (SELECT o_custkey AS custkey, COUNT(*) AS n_urgent FROM orders
           WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
SELECT COALESCE(a.custkey, b.custkey) AS custkey, a.c_name,
       COALESCE(b.n_urgent, 0) AS n_urgent,
       a.custkey IS NULL AS orders_only,
       b.custkey IS NULL AS customer_only
FROM a FULL OUTER JOIN b ON a.custkey = b.custkey
""")
def full_outer_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    a = (t.customer.where(F.col("c_mktsegment") == "BUILDING")
                   .select(F.col("c_custkey").alias("a_key"), "c_name"))
    b = (t.orders.where(F.col("o_orderpriority") == "1-URGENT")
                 .groupBy(F.col("o_custkey").alias("b_key"))
                 .agg(F.count(F.lit(1)).alias("n")))
    return (a.join(b, F.col("a_key") == F.col("b_key"), "full")
             .select(F.coalesce("a_key", "b_key").alias("custkey"), "c_name",
                     F.coalesce("n", F.lit(0)).cast("bigint").alias("n_urgent"),
                     F.col("a_key").isNull().alias("orders_only"),
                     F.col("b_key").isNull().alias("customer_only")))


@query("semi_join", oracle="""
SELECT c_custkey, c_name, c_nationkey
FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # Distinct keys first: a semi join cannot split a hot key of its right side.
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").distinct()
    return (t.customer.select("c_custkey", "c_name", "c_nationkey")
             .join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_semi"))


@query("anti_join", oracle="""
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate
FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
""")
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # Distinct keys first: map-side de-duplication shrinks the shuffle ~4x,
    # and the anti join reuses that hash partitioning.
    keys = t.lineitem.select("l_orderkey").distinct()
    return (t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
             .join(keys, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"))


@query("theta_join", oracle="""
SELECT a.c_custkey, a.c_nationkey, COUNT(b.c_custkey) AS n_lower
FROM customer a
LEFT JOIN customer b ON a.c_nationkey = b.c_nationkey AND b.c_acctbal < a.c_acctbal
GROUP BY a.c_custkey, a.c_nationkey
""")
def theta_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band self-join ``b.bal < a.bal`` within a nation, aggregated per row.

    The pair count of a customer equals the number of same-nation customers
    with a strictly lower balance, i.e. rank - 1 in balance order.  That is
    O(n log n) with no pairs formed (a nation's pairs grow quadratically).
    """
    cust = Tables(spark, sf_dir).customer.select("c_custkey", "c_nationkey", "c_acctbal")
    return band_self_join_counts(cust, "c_nationkey", "c_acctbal").select(
        "c_custkey", "c_nationkey", "n_lower")


def band_self_join_counts(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per row: how many rows with an equal (non-NULL) key have a strictly
    lower (non-NULL) value -- ``COUNT(b.*)`` of the self-join on
    ``a.key = b.key AND b.value < a.value`` -- as rank - 1, without pairs.
    Rows with a NULL key or value have no partner and count for no one."""
    valid = F.col(key).isNotNull() & F.col(value).isNotNull()
    ranked = ordered_scan(df.where(valid), [key], [(value, True)], [Out("rank", "_rank")])
    counted = ranked.withColumn("n_lower", F.col("_rank") - 1).drop("_rank")
    alone = df.where(~valid).withColumn("n_lower", F.lit(0).cast("bigint"))
    return counted.unionByName(alone)


INTERVAL_HOURS = 6


@query("interval_join", oracle="""
SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id,
       v.ts AS view_ts, p.ts AS purchase_ts
FROM events v
JOIN events p ON v.user_id = p.user_id
             AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR
WHERE v.event_type = 'view' AND p.event_type = 'purchase'
""")
def interval_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    return band_join_by_time(
        ev.where(F.col("event_type") == "view")
          .select(F.col("event_id").alias("view_id"), "user_id", F.col("ts").alias("view_ts")),
        ev.where(F.col("event_type") == "purchase")
          .select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user"),
                  F.col("ts").alias("purchase_ts")),
        "user_id", "p_user", "view_ts", "purchase_ts", INTERVAL_HOURS * 3600,
    ).select("view_id", "purchase_id", "user_id", "view_ts", "purchase_ts")


def band_join_by_time(left: DataFrame, right: DataFrame, lkey: str, rkey: str,
                      lts: str, rts: str, width_s: int) -> DataFrame:
    """Rows with ``left.ts <= right.ts <= left.ts + width`` and equal keys.

    Both sides get a time bucket of the band width; a match is at most one
    bucket later, so the left side is duplicated into its own and the next
    bucket and the join key becomes (key, bucket).  A key with many rows is
    spread across buckets; every pair still meets in exactly one bucket.
    """
    width_us = width_s * 1_000_000
    lb = F.floor(ntz_micros(lts) / width_us)
    left2 = left.withColumn("_b", F.explode(F.array(lb, lb + 1)))
    right2 = right.withColumn("_rb", F.floor(ntz_micros(rts) / width_us))
    cond = ((F.col(lkey) == F.col(rkey)) & (F.col("_b") == F.col("_rb"))
            & (F.col(rts) >= F.col(lts))
            & (F.col(rts) <= F.col(lts) + F.expr(f"INTERVAL {width_s} SECONDS")))
    return left2.join(right2, cond).drop("_b", "_rb")


@query("asof_join", oracle="""
SELECT e.event_id, e.user_id, e.ts, v.ts AS view_ts, v.value AS view_value
FROM events e
ASOF LEFT JOIN (SELECT user_id, ts, value FROM events WHERE event_type = 'view') v
  ON e.user_id = v.user_id AND e.ts >= v.ts
""")
def asof_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the latest view of the same user at or before it:
    that view's time and value (NULL when the user has no earlier view)."""
    ev = Tables(spark, sf_dir).events
    probes = ev.select("event_id", "user_id", "ts")
    views = (ev.where(F.col("event_type") == "view")
               .select(F.col("event_id").alias("view_id"), "user_id",
                       F.col("ts").alias("view_ts"), F.col("value").alias("view_value")))
    # view_id is carried first only to order simultaneous views.
    out = asof_join(probes, views, "user_id", "ts", "view_ts", ["view_id", "view_ts", "view_value"])
    return out.select("event_id", "user_id", "ts", "view_ts", "view_value")


def asof_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str,
              carry: list[str]) -> DataFrame:
    """For each left row, the latest right row with equal key and ts <= left ts.

    Both sides are stacked into one stream ordered by (key, ts, side) -- right
    rows before left rows on equal ts, so ``<=`` holds -- and the right row's
    columns, as one struct, are the last non-null struct so far: an ordered
    scan, not a join, so no pairs are formed and a busy key is split across
    tasks.  As in SQL, a right row with a NULL key or time matches nothing and
    a left row with a NULL key or time has no match.
    """
    lcols = left.columns
    carried = F.struct(*[F.col(c) for c in carry])
    right = right.where(F.col(key).isNotNull() & F.col(rts).isNotNull())
    r2 = right.select(*[F.lit(None).cast(left.schema[c].dataType).alias(c)
                        for c in lcols if c != key],
                      F.col(key), F.col(rts).alias("_t"), F.lit(0).alias("_side"),
                      F.col(carry[0]).alias("_by"), carried.alias("_c"))
    l2 = left.select(*lcols, F.col(lts).alias("_t"), F.lit(1).alias("_side"),
                     F.lit(None).cast(r2.schema["_by"].dataType).alias("_by"),
                     F.lit(None).cast(r2.schema["_c"].dataType).alias("_c"))
    # The first carried column breaks ties between right rows on equal ts.
    scanned = ordered_scan(l2.unionByName(r2), [key], [("_t", True), ("_side", True), ("_by", True)],
                           [Out("last_non_null", "_m", "_c")], peers=2)
    return scanned.where(F.col("_side") == 1).select(*lcols, *[F.col("_m")[c].alias(c) for c in carry])
