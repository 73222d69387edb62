"""Scans, filters, projections and global top-k.

All of these are one stage: the predicates are pushed into the Parquet scan
(row-group skipping on min/max statistics) and only the referenced columns
are read.  Global top-k runs as ``TakeOrderedAndProject``: each task keeps its
own k best rows and only k rows per task reach the final merge, so it never
sorts the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions.numeric import revenue_units, scale_back
from quarry.functions.time import ntz_lit
from quarry.sources.tables import Tables


@query("scan_filter_project", oracle="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
            AS DOUBLE) AS revenue
FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-01-01 00:00:00'
  AND l_shipdate < TIMESTAMP '1997-01-01 00:00:00'
  AND l_discount BETWEEN 0.05 AND 0.07
  AND l_quantity < 24
""")
def scan_filter_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return (li.where((F.col("l_shipdate") >= ntz_lit("1996-01-01"))
                     & (F.col("l_shipdate") < ntz_lit("1997-01-01"))
                     & F.col("l_discount").between(0.05, 0.07)
                     & (F.col("l_quantity") < 24))
              .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
                      scale_back(revenue_units(), 4).alias("revenue")))


@query("predicate_mix", oracle="""
SELECT p_partkey, p_name, p_brand, p_size,
       CASE WHEN p_retailprice >= 975 THEN 'premium'
            WHEN p_retailprice >= 925 THEN 'standard'
            ELSE 'economy' END AS price_band
FROM part
WHERE (p_name LIKE '%ring%' OR p_type IN ('PROMO', 'STANDARD'))
  AND p_size BETWEEN 10 AND 30
  AND p_brand NOT LIKE 'Brand#1%'
""")
def predicate_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = Tables(spark, sf_dir).part
    band = (F.when(F.col("p_retailprice") >= 975, "premium")
             .when(F.col("p_retailprice") >= 925, "standard")
             .otherwise("economy"))
    return (part.where((F.col("p_name").like("%ring%") | F.col("p_type").isin("PROMO", "STANDARD"))
                       & F.col("p_size").between(10, 30)
                       & ~F.col("p_brand").like("Brand#1%"))
                .select("p_partkey", "p_name", "p_brand", "p_size", band.alias("price_band")))


@query("topk_global", oracle="""
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate
FROM orders
ORDER BY o_totalprice DESC, o_orderkey
LIMIT 20
""")
def topk_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Tables(spark, sf_dir).orders
    return (orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
                  .orderBy(F.col("o_totalprice").desc(), F.col("o_orderkey").asc())
                  .limit(20))
