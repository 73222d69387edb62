"""Set operations: UNION [ALL], INTERSECT [ALL], EXCEPT [ALL].

Spark plans the distinct forms as an aggregate (or a semi/anti join) on all
columns, and the ALL forms as union + aggregate of per-side counts + a
generator that replays each surviving row min/difference times.  All are
hash-partitioned on the row values and take map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.sources.tables import Tables

_SIDES = """
WITH a AS (SELECT c_nationkey AS k FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 0),
     b AS (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000)
"""


@query("set_ops", oracle=_SIDES + """
SELECT 'union' AS op, k, COUNT(*) AS n FROM (SELECT k FROM a UNION SELECT k FROM b) t GROUP BY k
UNION ALL SELECT 'union_all', k, COUNT(*) FROM (SELECT k FROM a UNION ALL SELECT k FROM b) t GROUP BY k
UNION ALL SELECT 'intersect', k, COUNT(*) FROM (SELECT k FROM a INTERSECT SELECT k FROM b) t GROUP BY k
UNION ALL SELECT 'intersect_all', k, COUNT(*) FROM (SELECT k FROM a INTERSECT ALL SELECT k FROM b) t GROUP BY k
UNION ALL SELECT 'except', k, COUNT(*) FROM (SELECT k FROM a EXCEPT SELECT k FROM b) t GROUP BY k
UNION ALL SELECT 'except_all', k, COUNT(*) FROM (SELECT k FROM a EXCEPT ALL SELECT k FROM b) t GROUP BY k
""")
def set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    a = (t.customer.where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 0))
                   .select(F.col("c_nationkey").alias("k")))
    b = t.supplier.where(F.col("s_acctbal") > 5000).select(F.col("s_nationkey").alias("k"))
    results = {
        "union": a.union(b).distinct(),
        "union_all": a.unionAll(b),
        "intersect": a.intersect(b),
        "intersect_all": a.intersectAll(b),
        "except": a.subtract(b),
        "except_all": a.exceptAll(b),
    }
    out = None
    for op, df in results.items():
        counted = df.groupBy("k").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(op).alias("op"), "k", "n")
        out = counted if out is None else out.unionByName(counted)
    return out
