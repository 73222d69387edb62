"""Mergeable sketches: KLL quantiles, count-min heavy hitters, theta sets.

Each query pairs a sketch with an exact statement that SQL can check: a bound
that the sketch keeps, or a result for which the sketch only picks candidates.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.plans.broadcast import bounded_broadcast
from quarry.sources.tables import Tables

#: KLL: k, and the rank error that a sketch of this k keeps (1.33 % at k = 200
#: with 99 % confidence, here with a margin for many groups)
KLL_K, RANK_ERROR = 200, 0.025
QUANTILES = (0.1, 0.5, 0.9, 0.99)


def kll_quantiles(df: DataFrame, group: str, value: str, quantiles=QUANTILES, k: int = KLL_K) -> DataFrame:
    """(group, q, estimate): one pass, partial sketches merged; nothing is
    sorted and what is shuffled is a few KB per group and task."""
    sketch = df.groupBy(group).agg(F.kll_sketch_agg_double(value, k).alias("sketch"))
    each = [F.struct(F.lit(q).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias("estimate")) for q in quantiles]
    return sketch.select(group, F.explode(F.array(*each)).alias("e")).select(group, "e.q", "e.estimate")


@query("quantile_sketch", oracle=f"""
SELECT event_type, q, COUNT(value) AS n, true AS within_bound
FROM events, (VALUES {", ".join(f"({q}::DOUBLE)" for q in QUANTILES)}) AS x(q)
GROUP BY event_type, q HAVING COUNT(value) > 0
""")
def quantile_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles of ``value`` per event type, and whether the exact rank of each
    estimate is within RANK_ERROR of the one asked for (a second pass that only
    counts).  Groups without values give no row."""
    events = Tables(spark, sf_dir).events.where("value is not null").select("event_type", "value")
    estimates = kll_quantiles(events, "event_type", "value").withColumnRenamed("event_type", "type")
    ranked = (events.join(bounded_broadcast(estimates), F.col("event_type").eqNullSafe(F.col("type")))
              .groupBy("event_type", "q").agg(
                  F.count("*").alias("n"), F.count_if(F.col("value") < F.col("estimate")).alias("below"),
                  F.count_if(F.col("value") <= F.col("estimate")).alias("upto")))
    ok = ((F.col("below") / F.col("n") <= F.col("q") + RANK_ERROR) & (F.col("upto") / F.col("n") >= F.col("q") - RANK_ERROR))
    return ranked.select("event_type", "q", "n", ok.alias("within_bound"))


#: count-min: relative error and confidence (a table of 2,000 x 10 counters)
CM_ERROR, CM_CONFIDENCE, CM_SEED = 0.001, 0.999, 11
SHARE = 0.01


class CountMin:
    """Reads the bytes of Spark's ``count_min_sketch`` over a bigint column:
    big-endian version, total, depth, width, one multiplier per row, counters."""

    def __init__(self, raw: bytes):
        version, self.total, depth, self.width = struct.unpack(">iqii", raw[:20])
        if version != 1:
            raise ValueError(f"count-min sketch of version {version}")
        numbers = np.frombuffer(raw, dtype=">i8", offset=20).astype(np.int64)
        self.factors, self.counts = numbers[:depth], numbers[depth:].reshape(depth, self.width)

    def estimate(self, items: np.ndarray) -> np.ndarray:
        """Never less than the count, and with the sketch's confidence at most
        error x total more."""
        out = np.full(len(items), np.iinfo(np.int64).max)
        for factor, row in zip(self.factors, self.counts):
            h = items * factor
            h = (h + (h >> 32)) & 0x7FFFFFFF
            out = np.minimum(out, row[h % self.width])
        return out


def heavy(df: DataFrame, column: str, share: float = SHARE, error: float = CM_ERROR) -> DataFrame:
    """(value, n): the values of a bigint column in at least ``share`` of the
    rows, exactly.  A sketch of fixed size names the candidates (at most about
    1 / (share - error) values); only their rows are counted and shuffled."""
    spark = df.sparkSession
    values = df.select(F.col(f"`{column}`").cast("long").alias("value"))
    first = values.agg(F.count("*").alias("rows"), F.count_min_sketch(
        "value", F.lit(error), F.lit(CM_CONFIDENCE), F.lit(CM_SEED)).alias("sketch")).first()
    if not first.rows:
        return values.groupBy("value").agg(F.count("*").alias("n"))
    least = int(np.ceil(share * first.rows - 1e-9))
    raw = spark.sparkContext.broadcast(bytes(first.sketch))

    @F.arrow_udf("boolean")
    def candidate(value: pa.Array) -> pa.Array:
        sketch = CountMin(raw.value)
        missing = value.is_null().to_numpy(zero_copy_only=False)            # nulls are not in the sketch
        items = value.fill_null(0).to_numpy(zero_copy_only=False)
        return pa.array(missing | (sketch.estimate(items) >= least))

    return (values.where(candidate("value")).groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") >= least))


@query("heavy_hitters", oracle=f"""
SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS value, COUNT(*) AS n
FROM events GROUP BY 1 HAVING COUNT(*) >= {SHARE} * (SELECT COUNT(*) FROM events)
""")
def heavy_hitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values of ``props.k`` in at least one in a hundred events."""
    k = F.from_json("props", "k long")["k"]
    return heavy(Tables(spark, sf_dir).events.select(k.alias("k")), "k")


#: theta: log2 of the nominal entries, and the error kept at it (6 standard errors)
THETA_LOG, THETA_ERROR = 14, 0.05


def theta_sketches(df: DataFrame, group: str, member: str) -> DataFrame:
    """(group, sketch): one row per group; sets are combined from these alone."""
    return df.groupBy(group).agg(F.theta_sketch_agg(member, F.lit(THETA_LOG)).alias("sketch"))


@query("theta_sets", oracle="""
WITH u AS (SELECT DISTINCT event_type, user_id FROM events WHERE user_id IS NOT NULL AND event_type IS NOT NULL),
t AS (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)
SELECT a.event_type AS a, b.event_type AS b, true AS union_ok, true AS both_ok, true AS only_a_ok
FROM t a JOIN t b ON a.event_type < b.event_type
""")
def theta_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of two event types: either, both, the first only, from one sketch
    per type; each estimate within THETA_ERROR of the union's exact size.  The
    pairs are of types (a bounded list), not of events."""
    events = Tables(spark, sf_dir).events.where("event_type is not null").select("event_type", "user_id")
    rows = bounded_broadcast(theta_sketches(events, "event_type", "user_id")).select(F.struct("event_type", "sketch").alias("s"))
    every = rows.agg(F.sort_array(F.collect_list("s")).alias("every"))      # a sketch per event type, a bounded list
    estimate = lambda e: F.theta_sketch_estimate(e).alias
    pairs = (every.withColumn("x", F.explode("every"))
             .withColumn("y", F.explode(F.filter("every", lambda y: y["event_type"] > F.col("x.event_type"))))
             .select(F.col("x.event_type").alias("a"), F.col("y.event_type").alias("b"),
                     estimate(F.theta_union("x.sketch", "y.sketch"))("either"),
                     estimate(F.theta_intersection("x.sketch", "y.sketch"))("both"),
                     estimate(F.theta_difference("x.sketch", "y.sketch"))("only_a")))
    # exact sizes by the set of types of every user, a row per such set
    per_user = events.where("user_id is not null").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))
    kinds = per_user.groupBy("types").agg(F.count("*").alias("users"))
    single = kinds.select(F.explode("types").alias("t"), "users").groupBy("t").agg(F.sum("users").alias("n"))
    both = (kinds.withColumn("a", F.explode("types")).withColumn("b", F.explode("types")).where("a < b")
            .groupBy("a", "b").agg(F.sum("users").alias("x_both")))
    zero = lambda c: F.coalesce(c, F.lit(0))
    exact = (pairs.join(both, ["a", "b"], "left").join(single.toDF("a", "n_a"), "a", "left").join(single.toDF("b", "n_b"), "b", "left")
             .withColumn("x_both", zero("x_both")).withColumn("x_only", zero("n_a") - F.col("x_both"))
             .withColumn("x_either", zero("n_a") + zero("n_b") - F.col("x_both")))
    near = lambda got, want: F.abs(F.col(got) - F.col(want)) <= THETA_ERROR * F.col("x_either")
    return exact.select("a", "b", near("either", "x_either").alias("union_ok"), near("both", "x_both").alias("both_ok"),
                        near("only_a", "x_only").alias("only_a_ok"))
