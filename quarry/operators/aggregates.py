"""Aggregations: grouped, distinct, grouping sets / rollup / cube, pivot,
unpivot, statistics, exact percentiles and mergeable distinct-count sketches.

Scale notes
-----------
* Every aggregate here is algebraic or mergeable, so Spark runs a partial
  aggregate in each map task and shuffles one row per (task, group): a group
  holding a third of the table costs no more shuffle than a small one.
* Grouping sets, rollup and cube first aggregate at the finest grain and then
  roll the (small) result up, instead of letting ``Expand`` multiply every
  input row by the number of grouping sets.
* Exact percentiles never gather a group: see ``operators/skew.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions.numeric import (cents, charge_units, disc_price_units,
                                      exact_avg, exact_sum, scale_back, sum_units)
from quarry.functions.time import ntz_lit
from quarry.operators.skew import _ns_join, exact_percentiles
from quarry.plans.broadcast import bounded_broadcast
from quarry.sources.tables import Tables


@query("pricing_summary", oracle="""
SELECT l_returnflag, l_linestatus,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS sum_base_price,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))
            AS DOUBLE) AS sum_disc_price,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS DOUBLE) AS sum_charge,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / COUNT(l_quantity) AS avg_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) / COUNT(l_extendedprice) AS avg_price,
       CAST(SUM(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) / COUNT(l_discount) AS avg_disc,
       COUNT(*) AS count_order
FROM lineitem
WHERE l_shipdate <= TIMESTAMP '2001-09-02 00:00:00'
GROUP BY l_returnflag, l_linestatus
""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return (li.where(F.col("l_shipdate") <= ntz_lit("2001-09-02"))
              .groupBy("l_returnflag", "l_linestatus")
              .agg(exact_sum("l_quantity", wide=False).alias("sum_qty"),
                   exact_sum("l_extendedprice").alias("sum_base_price"),
                   scale_back(sum_units(disc_price_units()), 4).alias("sum_disc_price"),
                   scale_back(sum_units(charge_units()), 6).alias("sum_charge"),
                   exact_avg("l_quantity", wide=False).alias("avg_qty"),
                   exact_avg("l_extendedprice").alias("avg_price"),
                   exact_avg("l_discount", wide=False).alias("avg_disc"),
                   F.count(F.lit(1)).alias("count_order")))


@query("distinct_agg", oracle="""
SELECT l_returnflag,
       COUNT(DISTINCT l_partkey) AS n_parts,
       COUNT(DISTINCT l_suppkey) AS n_suppliers,
       COUNT(*) AS n_lines
FROM lineitem
GROUP BY l_returnflag
""")
def distinct_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Spark rewrites several distinct aggregates into one Expand + two-level
    # aggregate: (group, value) pairs are de-duplicated map-side first.
    li = Tables(spark, sf_dir).lineitem
    return (li.groupBy("l_returnflag")
              .agg(F.count_distinct("l_partkey").alias("n_parts"),
                   F.count_distinct("l_suppkey").alias("n_suppliers"),
                   F.count(F.lit(1)).alias("n_lines")))


def _orders_by_status_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finest grain of the orders roll-ups: one row per (status, priority)."""
    orders = Tables(spark, sf_dir).orders
    return (orders.groupBy("o_orderstatus", "o_orderpriority")
                  .agg(F.count(F.lit(1)).alias("n"),
                       sum_units(cents("o_totalprice")).alias("total")))


def _with_grand_total(fine: DataFrame) -> DataFrame:
    """``fine`` (keys, n, sum) and one row that counts nothing: the empty set of
    a grouping has a row even where there is no input.  What else the row makes
    has no count (``_counted``)."""
    nothing = [F.lit(0 if f.name == "n" else None).cast(f.dataType).alias(f.name) for f in fine.schema.fields]
    return fine.unionByName(fine.sparkSession.range(1).select(*nothing))


def _counted(rows: DataFrame, n: str, total) -> DataFrame:
    return rows.where((F.col(n) > 0) | total)


@query("grouping_sets_query", oracle="""
SELECT o_orderstatus, o_orderpriority,
       CAST(GROUPING(o_orderstatus) AS INTEGER) AS g_status,
       CAST(GROUPING(o_orderpriority) AS INTEGER) AS g_priority,
       COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_price
FROM orders
GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())
""")
def grouping_sets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = _with_grand_total(_orders_by_status_priority(spark, sf_dir))
    s, p = F.col("o_orderstatus"), F.col("o_orderpriority")
    sets = (fine.groupingSets([[s], [p], []], s, p)
                .agg(F.grouping(s).cast("int").alias("g_status"),
                     F.grouping(p).cast("int").alias("g_priority"),
                     F.sum("n").cast("bigint").alias("n_orders"),
                     scale_back(F.sum("total"), 2).alias("total_price")))
    return _counted(sets, "n_orders", (F.col("g_status") == 1) & (F.col("g_priority") == 1))


@query("rollup_query", oracle="""
SELECT r_name, n_name,
       CAST(GROUPING_ID(r_name, n_name) AS INTEGER) AS gid,
       COUNT(*) AS n_customers,
       CAST(SUM(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS total_balance
FROM customer
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)
""")
def rollup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    # Aggregate the fact side to one row per nation key before touching the
    # dimensions; the joins and the roll-up then see 25 rows.
    per_nation = (t.customer.groupBy("c_nationkey")
                   .agg(F.count(F.lit(1)).alias("n"), sum_units(cents("c_acctbal")).alias("bal")))
    nation = bounded_broadcast(t.nation)
    region = bounded_broadcast(t.region)
    named = (per_nation.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
                       .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    named = _with_grand_total(named.select("r_name", "n_name", "n", "bal"))
    sets = (named.rollup("r_name", "n_name")
                 .agg(F.grouping_id("r_name", "n_name").cast("int").alias("gid"),
                      F.sum("n").cast("bigint").alias("n_customers"),
                      scale_back(F.sum("bal"), 2).alias("total_balance")))
    return _counted(sets, "n_customers", F.col("gid") == 3)


@query("cube_query", oracle="""
SELECT o_orderstatus, o_orderpriority,
       CAST(GROUPING_ID(o_orderstatus, o_orderpriority) AS INTEGER) AS gid,
       COUNT(*) AS n_orders,
       CAST(SUM(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total_price
FROM orders
GROUP BY CUBE (o_orderstatus, o_orderpriority)
""")
def cube_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    fine = _with_grand_total(_orders_by_status_priority(spark, sf_dir))
    sets = (fine.cube("o_orderstatus", "o_orderpriority")
                .agg(F.grouping_id("o_orderstatus", "o_orderpriority").cast("int").alias("gid"),
                     F.sum("n").cast("bigint").alias("n_orders"),
                     scale_back(F.sum("total"), 2).alias("total_price")))
    return _counted(sets, "n_orders", F.col("gid") == 3)


# The order status codes of the orders table; any other status,
# NULL included, is counted in a column of its own.
ORDER_STATUSES = ["F", "O", "P"]
OTHER = "other"

_PIVOT_SQL = """
SELECT o_orderpriority,
       COUNT(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
       COUNT(*) FILTER (WHERE o_orderstatus = 'O') AS "O",
       COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS "P",
       COUNT(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O', 'P')) AS "other"
FROM orders
GROUP BY o_orderpriority
"""


def _pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    # Listing the pivot values avoids an extra job to discover them; what is
    # not listed is counted too.
    status = F.when(F.col("o_orderstatus").isin(ORDER_STATUSES), F.col("o_orderstatus")).otherwise(OTHER)
    names = [*ORDER_STATUSES, OTHER]
    wide = (orders.select("o_orderpriority", status.alias("status"))
                  .groupBy("o_orderpriority").pivot("status", names).count())
    return wide.select("o_orderpriority",
                       *[F.coalesce(F.col(s), F.lit(0)).cast("bigint").alias(s) for s in names])


@query("pivot_query", oracle=_PIVOT_SQL)
def pivot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir)


@query("unpivot_query", oracle=f"""
WITH p AS ({_PIVOT_SQL})
SELECT o_orderpriority, 'F' AS o_orderstatus, "F" AS n_orders FROM p
UNION ALL SELECT o_orderpriority, 'O', "O" FROM p
UNION ALL SELECT o_orderpriority, 'P', "P" FROM p
UNION ALL SELECT o_orderpriority, 'other', "other" FROM p
""")
def unpivot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pivot(spark, sf_dir).unpivot(
        "o_orderpriority", [*ORDER_STATUSES, OTHER], "o_orderstatus", "n_orders")


@query("stat_aggs", oracle="""
SELECT l_returnflag,
       ROUND(STDDEV_SAMP(l_quantity), 6) AS sd_qty,
       ROUND(VAR_SAMP(l_discount), 9) AS var_disc,
       ROUND(CORR(l_quantity, l_extendedprice), 6) AS corr_qty_price,
       ROUND(COVAR_SAMP(l_quantity, l_discount), 6) AS covar_qty_disc
FROM lineitem
GROUP BY l_returnflag
""")
def stat_aggs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return (li.groupBy("l_returnflag")
              .agg(F.round(F.stddev_samp("l_quantity"), 6).alias("sd_qty"),
                   F.round(F.var_samp("l_discount"), 9).alias("var_disc"),
                   F.round(F.corr("l_quantity", "l_extendedprice"), 6).alias("corr_qty_price"),
                   F.round(F.covar_samp("l_quantity", "l_discount"), 6).alias("covar_qty_disc")))


@query("exact_percentiles", oracle="""
SELECT event_type,
       ROUND(QUANTILE_CONT(value, 0.5), 6) AS p50,
       ROUND(QUANTILE_CONT(value, 0.9), 6) AS p90,
       COUNT(*) AS n
FROM events
GROUP BY event_type
""")
def exact_percentiles_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    pct = exact_percentiles(ev, ["event_type"], "value", {"p50": 0.5, "p90": 0.9}, count="n")
    return pct.select("event_type", F.round("p50", 6).alias("p50"),
                      F.round("p90", 6).alias("p90"), "n")


def distinct_sketches(df: DataFrame, keys: list[str], by: str, cols: dict[str, str],
                      lg_k: int = 12) -> DataFrame:
    """Approximate distinct counts per group from mergeable HLL sketches, built
    per (group, ``by``) and united per group, the way daily or per-partition
    sketches are rolled up.  One scan; nothing exact is counted."""
    fine = df.groupBy(*keys, by).agg(*[F.hll_sketch_agg(c, lg_k).alias(n) for n, c in cols.items()])
    return fine.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in cols])


@query("approx_distinct", oracle="""
SELECT l_returnflag,
       COUNT(DISTINCT l_partkey) AS exact_parts,
       COUNT(DISTINCT l_suppkey) AS exact_suppliers,
       TRUE AS parts_within_5pct,
       TRUE AS suppliers_within_5pct
FROM lineitem
GROUP BY l_returnflag
""")
def approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimates of ``distinct_sketches`` checked against exact distinct
    counts (the oracle states the 5% bound); the exact side belongs to this
    check, not to the operator."""
    li = Tables(spark, sf_dir).lineitem
    approx = distinct_sketches(li, ["l_returnflag"], "l_linestatus",
                               {"approx_parts": "l_partkey", "approx_supps": "l_suppkey"})
    exact = (li.groupBy("l_returnflag")
               .agg(F.count_distinct("l_partkey").alias("exact_parts"),
                    F.count_distinct("l_suppkey").alias("exact_suppliers")))

    def within(a: str, e: str):
        return F.abs(F.col(a) - F.col(e)) <= F.col(e) * 0.05

    return (_ns_join(approx, exact, ["l_returnflag"], "inner")
                  .select("l_returnflag", "exact_parts", "exact_suppliers",
                          within("approx_parts", "exact_parts").alias("parts_within_5pct"),
                          within("approx_supps", "exact_suppliers").alias("suppliers_within_5pct")))
