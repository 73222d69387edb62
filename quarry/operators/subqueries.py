"""Correlated subqueries and lateral joins.

Both are written as SQL/DataFrame correlation and left to Catalyst to
decorrelate: the correlated scalar subquery becomes an aggregate on the
correlation key joined back (one partial aggregate, no per-row re-execution);
the LATERAL ... ORDER BY ... LIMIT becomes a per-key row_number with a
``WindowGroupLimit`` below the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.catalog import query
from quarry.operators.skew import _max_group_rows, hot_keys
from quarry.sources.tables import Tables

_CORRELATED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM {lineitem} l
WHERE l_quantity < (SELECT 0.2 * AVG(l2.l_quantity) FROM {lineitem} l2
                    WHERE l2.l_partkey = l.l_partkey)
"""


@query("correlated_subquery", oracle=_CORRELATED.format(lineitem="lineitem"))
def correlated_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return below_own_average(Tables(spark, sf_dir).lineitem)


def below_own_average(li: DataFrame, max_group_rows: int | None = None) -> DataFrame:
    """The correlated query; a part with very many lines is not sent to one
    task: its average (one of at most ``MAX_HOT_KEYS`` listed) is broadcast."""
    spark = li.sparkSession
    hot, _ = hot_keys(li.where(F.col("l_partkey").isNotNull()), ["l_partkey"], max_group_rows or _max_group_rows(li))
    if not hot:             # none, or too many to list: AQE and the plain plan
        return spark.sql(_CORRELATED, lineitem=li)
    keys = F.broadcast(spark.createDataFrame([(r["l_partkey"],) for r in hot],
                                             T.StructType([T.StructField("l_partkey", li.schema["l_partkey"].dataType)])))
    busy = li.join(keys, "l_partkey", "left_semi")
    limit = F.broadcast(busy.groupBy("l_partkey").agg((0.2 * F.avg("l_quantity")).alias("_limit")))
    rest = spark.sql(_CORRELATED, lineitem=li.join(keys, "l_partkey", "left_anti"))
    return rest.unionByName(busy.join(limit, "l_partkey").where(F.col("l_quantity") < F.col("_limit")).select(*rest.columns))


@query("lateral_join", oracle="""
SELECT c_custkey, o.o_orderkey, o.o_orderdate, o.o_totalprice
FROM customer,
     LATERAL (SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
              WHERE o_custkey = c_custkey
              ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 2) o
""")
def lateral_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    cust = t.customer.select("c_custkey")
    latest = (t.orders.where(F.col("o_custkey") == F.col("c_custkey").outer())
                      .orderBy(F.col("o_orderdate").desc(), F.col("o_orderkey").desc())
                      .limit(2)
                      .select("o_orderkey", "o_orderdate", "o_totalprice"))
    return cust.lateralJoin(latest).select("c_custkey", "o_orderkey", "o_orderdate",
                                           "o_totalprice")
