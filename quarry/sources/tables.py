"""Batch sources: the driver's Parquet tables.

Every table is one Parquet file (or folder) ``{sf_dir}/{name}.parquet``.
Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers should select/filter on the returned DataFrame rather than pre-load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Fixed schema of the events table; streaming sources need it up front.
EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])


def table_path(sf_dir: str, name: str) -> str:
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an input that arrives in fewer splits than the cluster has
    cores (e.g. one unsplittable file) before CPU-heavy per-row work.

    Checked from the planned scan (file splits; no job runs).  Large inputs
    already have at least that many splits, so at scale this is a no-op and
    adds no shuffle.
    """
    try:
        want = df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:          # Spark Connect: no RDD view; leave the input as is
        return df
    return df if have >= want else df.repartition(want)


class Tables:
    """Attribute access to the tables of one scale factor: ``t.lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return load(self.spark, self.sf_dir, name)
