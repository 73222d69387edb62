"""Sinks: partitioned Parquet tables in the shared scratch folder.

``write_partitioned`` lays a table out as Hive-style ``col=value`` folders;
reading it back with a filter on those columns prunes whole folders before
any file is opened (``PartitionFilters`` in the scan), and Parquet column
statistics skip row groups for the remaining predicates.

The location is always under ``spark.checkpoint.dir`` (shared storage on a
cluster), in a fresh folder per call, so a retried job never reads a
half-written previous attempt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions.numeric import exact_sum
from quarry.session import scratch_path
from quarry.sources.tables import Tables


MAX_RECORDS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str]) -> str:
    # No shuffle before the write: hashing on low-cardinality partition
    # columns would funnel a whole folder (possibly a third of the table)
    # through one task.  Each task sorts its own rows by the partition
    # columns and writes one file per folder it holds, capped in size.
    (df.write.mode("errorifexists")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy(*partition_cols)
       .parquet(path))
    return path


@query("sink_roundtrip", oracle="""
SELECT l_linestatus, COUNT(*) AS n_lines,
       CAST(SUM(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) AS sum_qty
FROM lineitem
WHERE l_returnflag = 'R'
GROUP BY l_linestatus
""")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    path = write_partitioned(li, scratch_path(spark, "sink", "lineitem"),
                             ["l_returnflag", "l_linestatus"])
    back = spark.read.schema(li.schema).parquet(path)          # an empty table has no file to read it from
    return (back.where(F.col("l_returnflag") == "R")
                .groupBy("l_linestatus")
                .agg(F.count(F.lit(1)).alias("n_lines"), exact_sum("l_quantity", wide=False).alias("sum_qty")))
