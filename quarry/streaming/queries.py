"""Event-time streaming queries over the events table.

Each query reads the events table (or Parquet files that Spark staged from
it) as a stream, runs with ``availableNow`` to completion and returns its
sink as a batch DataFrame.  The watermark column is ``event_time``, the
zoned twin of the NTZ ``ts`` column (``functions/time.py``).

Output modes are chosen for bounded state: windowed aggregates and sessions
run in append mode with a watermark (state is dropped once a window closes);
complete mode is used only for the two day-level rollups (B1, B2), whose
state is bounded by days x event types.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from datetime import time as dtime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions.numeric import exact_sum
from quarry.functions.time import instant_to_ntz, ntz_lit, ntz_micros
from quarry.plans.broadcast import bounded_broadcast
from quarry.sources.tables import Tables
from quarry.streaming.runner import (EVENT_TIME, events_stream, new_paths, overwrite_sink,
                                     children, path_exists, per_batch_sink, read_latest, remove,
                                     run_available_now, stage, stream_partitions, window_cols)
from quarry.streaming.stateful import running_user_stats
from quarry.streaming.visits import OUTPUT as VISITS
from quarry.streaming.visits import visits

WATERMARK = "1 hour"
SESSION_GAP = "12 hours"
ON_TIME_SLICES = 2
JOIN_HOURS = 6
# Parts into which the events of one customer are dealt in the stream-static
# join (the dimension is repeated as often).
STATIC_SALT = 4

_DAILY_BY_TYPE = """
SELECT date_trunc('day', ts) AS window_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type, COUNT(*) AS n,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM events
WHERE ts IS NOT NULL                        -- a row without time is in no window
GROUP BY 1, 2, 3
"""


def _daily_by_type(stream: DataFrame) -> DataFrame:
    return (stream.groupBy(F.window(EVENT_TIME, "1 day"), "event_type")
                  .agg(F.count(F.lit(1)).alias("n"), exact_sum("value").alias("total_value"))
                  .select(*window_cols(), "event_type", "n", "total_value"))


@query("stream_tumbling", tier="stream", oracle=_DAILY_BY_TYPE)
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts per type, complete mode (state: days x types, small)."""
    paths = new_paths(spark, "stream_tumbling")
    agg = _daily_by_type(events_stream(spark, sf_dir))
    run_available_now(agg, paths, "complete", overwrite_sink(paths.sink))
    return read_latest(spark, paths.sink)


@query("stream_sliding", tier="stream", oracle="""
SELECT window_start, window_start + INTERVAL 2 DAY AS window_end, COUNT(*) AS n
FROM (SELECT date_trunc('day', ts) AS window_start FROM events
      UNION ALL
      SELECT date_trunc('day', ts) - INTERVAL 1 DAY FROM events) t
WHERE window_start IS NOT NULL
GROUP BY window_start
""")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-day windows sliding by 1 day; complete mode (one row per window)."""
    paths = new_paths(spark, "stream_sliding")
    agg = (events_stream(spark, sf_dir)
           .groupBy(F.window(EVENT_TIME, "2 days", "1 day"))
           .agg(F.count(F.lit(1)).alias("n"))
           .select(*window_cols(), "n"))
    run_available_now(agg, paths, "complete", overwrite_sink(paths.sink))
    return read_latest(spark, paths.sink)


@query("stream_session", tier="stream", oracle="""
WITH g AS (
  SELECT user_id, ts,
         CASE WHEN LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                OR ts > LAG(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR
              THEN 1 ELSE 0 END AS brk
  FROM events WHERE ts IS NOT NULL),
s AS (SELECT user_id, ts,
             SUM(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
      FROM g)
SELECT user_id, MIN(ts) AS session_start, MAX(ts) + INTERVAL 12 HOUR AS session_end,
       COUNT(*) AS n_events
FROM s
GROUP BY user_id, sid
HAVING MAX(ts) + INTERVAL 12 HOUR <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user sessions (12 h gap), append mode: a session is written once
    the watermark passes its end, and its state is dropped then.  Sessions
    still open when the input ends are not final and are not written.  An
    event exactly one gap after the previous one still joins the session
    (Spark merges touching session windows)."""
    paths = new_paths(spark, "stream_session")
    sessions = (events_stream(spark, sf_dir)
                .withWatermark(EVENT_TIME, WATERMARK)
                .groupBy("user_id", F.session_window(EVENT_TIME, SESSION_GAP).alias("s"))
                .agg(F.count(F.lit(1)).alias("n_events"))
                .select("user_id",
                        instant_to_ntz(F.col("s.start")).alias("session_start"),
                        instant_to_ntz(F.col("s.end")).alias("session_end"),
                        "n_events"))
    run_available_now(sessions, paths, "append")
    return spark.read.parquet(paths.sink)


@query("stream_watermark_append", tier="stream", oracle=f"""
SELECT * FROM ({_DAILY_BY_TYPE}) d
WHERE window_end <= (SELECT MAX(ts) FROM events) - INTERVAL 1 HOUR
""")
def stream_watermark_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily rollup in append mode behind a 1 h watermark: each day is
    written once, when it can no longer change; the last day stays open."""
    paths = new_paths(spark, "stream_watermark_append")
    agg = _daily_by_type(events_stream(spark, sf_dir).withWatermark(EVENT_TIME, WATERMARK))
    run_available_now(agg, paths, "append")
    return spark.read.parquet(paths.sink)


@query("stream_late_data", tier="stream", oracle="""
WITH b AS (SELECT date_trunc('day', MIN(ts)) + INTERVAL 1 DAY AS day1_end,
                  MAX(ts) - INTERVAL 1 HOUR AS wm
           FROM events)
SELECT date_trunc('day', ts) AS window_start,
       date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       COUNT(*) AS n
FROM events, b
WHERE ts >= b.day1_end
GROUP BY 1, 2
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= MAX(b.wm)
""")
def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows are dropped across a restart.

    Everything after the first day is staged in time order, in
    ``ON_TIME_SLICES`` slices, each processed before the next arrives (a
    micro-batch each, whatever its number of files).  Then the first day's rows
    arrive as new files and the query restarts from its checkpoint: the
    restored watermark is far past them, so they are dropped and no closed
    window changes.
    """
    paths = new_paths(spark, "stream_late_data")
    ev = Tables(spark, sf_dir).events
    ends = ev.agg(F.min(F.to_date("ts")).alias("d"), F.max("ts").alias("hi")).first()   # one row
    first_day_end = datetime.combine((ends["d"] or date(1970, 1, 1)) + timedelta(days=1), dtime())
    step = ((ends["hi"] or first_day_end) - first_day_end) / ON_TIME_SLICES
    on_time = ev.where(F.col("ts") >= ntz_lit(first_day_end))
    late = ev.where(F.col("ts") < ntz_lit(first_day_end))

    def daily() -> DataFrame:
        return (events_stream(spark, source_dir=paths.source)
                .withWatermark(EVENT_TIME, WATERMARK)
                .groupBy(F.window(EVENT_TIME, "1 day"))
                .agg(F.count(F.lit(1)).alias("n"))
                .select(*window_cols(), "n"))

    for k in range(ON_TIME_SLICES):
        part = F.col("ts") >= ntz_lit(first_day_end + k * step)
        if k + 1 < ON_TIME_SLICES:
            part &= F.col("ts") < ntz_lit(first_day_end + (k + 1) * step)
        stage(on_time.where(part), paths.source)
        run_available_now(daily(), paths, "append")
    stage(late, paths.source)
    run_available_now(daily(), paths, "append")           # restart, same checkpoint
    return spark.read.parquet(paths.sink)


RATE_SLICES = 4
ROWS_PER_FILE = 2_000_000


@query("stream_rate_limited", tier="stream", oracle="""
WITH b AS (SELECT date_trunc('day', MIN(ts)) + INTERVAL 1 DAY AS day1_end, MAX(ts) - INTERVAL 1 HOUR AS wm FROM events)
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, COUNT(*) AS n
FROM events, b WHERE ts >= b.day1_end
GROUP BY 1, 2 HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= MAX(b.wm)
""")
def stream_rate_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late rows are dropped between the micro-batches of one run: the days
    after the first in ``RATE_SLICES`` slices of time order, then the first day.
    The source is rate-limited (``maxFilesPerTrigger``) to the files of a slice,
    so that each is a micro-batch of its own."""
    paths = new_paths(spark, "stream_rate_limited")
    ev = Tables(spark, sf_dir).events
    rate_limited(spark, ev, paths, -(-ev.count() // (RATE_SLICES * ROWS_PER_FILE)) or 1)
    return spark.read.schema("window_start timestamp_ntz, window_end timestamp_ntz, n long").parquet(paths.sink)


def rate_limited(spark: SparkSession, ev: DataFrame, paths, files: int = 1):
    """Stages the slices in ``files`` files each (as many as a slice needs), and
    runs over all; the finished query."""
    ends = ev.agg(F.min(F.to_date("ts")).alias("d"), F.max("ts").alias("hi")).first()
    first_day_end = datetime.combine((ends["d"] or date(1970, 1, 1)) + timedelta(days=1), dtime())
    step = max(((ends["hi"] or first_day_end) - first_day_end) / RATE_SLICES, timedelta(microseconds=1))
    on_time = ev.where(F.col("ts") >= ntz_lit(first_day_end))
    for k in range(RATE_SLICES):
        part = on_time.where(F.col("ts") >= ntz_lit(first_day_end + k * step))
        stage(part.where(F.col("ts") < ntz_lit(first_day_end + (k + 1) * step)).repartition(files) if k + 1 < RATE_SLICES
              else part.repartition(files), paths.source)
    stage(ev.where(F.col("ts") < ntz_lit(first_day_end)).repartition(files), paths.source)
    daily = (events_stream(spark, source_dir=paths.source, files_per_trigger=files)
             .withWatermark(EVENT_TIME, WATERMARK).groupBy(F.window(EVENT_TIME, "1 day"))
             .agg(F.count(F.lit(1)).alias("n")).select(*window_cols(), "n"))
    return run_available_now(daily, paths, "append")


@query("stream_dedup", tier="stream", oracle="""
SELECT DISTINCT event_id, user_id, ts, event_type, value FROM events
""")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered twice (two staged copies); duplicates within the
    watermark are removed, and state per id is dropped after it."""
    paths = new_paths(spark, "stream_dedup")
    ev = Tables(spark, sf_dir).events
    stage(ev, paths.source)
    stage(ev, paths.source)
    deduped = (events_stream(spark, source_dir=paths.source)
               .withWatermark(EVENT_TIME, WATERMARK)
               .dropDuplicatesWithinWatermark(["event_id"])
               .select("event_id", "user_id", "ts", "event_type", "value"))
    run_available_now(deduped, paths, "append")
    return spark.read.parquet(paths.sink)


@query("stream_stream_join", tier="stream", oracle="""
SELECT v.event_id AS view_id, p.event_id AS purchase_id, v.user_id,
       v.ts AS view_ts, p.ts AS purchase_ts
FROM events v
JOIN events p ON v.user_id = p.user_id
             AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 6 HOUR
WHERE v.event_type = 'view' AND p.event_type = 'purchase'
""")
def stream_stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View then purchase within 6 h: both sides watermarked and the time
    range bounds how long each row waits in join state.  The join key holds a
    6 h bucket beside the user (views stand in their own and the next bucket),
    so a busy user is spread over tasks; a pair meets in exactly one bucket."""
    paths = new_paths(spark, "stream_stream_join")
    bucket = F.floor(ntz_micros("ts") / (JOIN_HOURS * 3_600_000_000))
    views = (events_stream(spark, sf_dir).where(F.col("event_type") == "view")
             .select(F.col("event_id").alias("view_id"), "user_id",
                     F.col("ts").alias("view_ts"), F.col(EVENT_TIME).alias("v_time"),
                     F.explode(F.array(bucket, bucket + 1)).alias("v_bucket"))
             .withWatermark("v_time", WATERMARK))
    buys = (events_stream(spark, sf_dir).where(F.col("event_type") == "purchase")
            .select(F.col("event_id").alias("purchase_id"), F.col("user_id").alias("p_user"),
                    F.col("ts").alias("purchase_ts"), F.col(EVENT_TIME).alias("p_time"),
                    bucket.alias("p_bucket"))
            .withWatermark("p_time", WATERMARK))
    joined = (views.join(buys, (F.col("user_id") == F.col("p_user"))
                         & (F.col("v_bucket") == F.col("p_bucket"))
                         & (F.col("p_time") >= F.col("v_time"))
                         & (F.col("p_time") <= F.col("v_time") + F.expr("INTERVAL 6 HOURS")))
                   .select("view_id", "purchase_id", "user_id", "view_ts", "purchase_ts"))
    run_available_now(joined, paths, "append")
    return spark.read.parquet(paths.sink)


@query("stream_static_join", tier="stream", oracle="""
SELECT e.event_id, e.user_id, e.event_type, c.c_mktsegment, n.n_name
FROM events e
JOIN customer c ON e.user_id = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events enriched with the customer dimension (user_id = c_custkey).

    Every micro-batch joins against the same static side.  Broadcast when
    Spark's size estimate allows; otherwise the dimension is hash-partitioned
    on the join key once, with the stream's own partition count, and kept
    (memory and disk) for the run, so each micro-batch shuffles only its
    events and reuses the dimension's partitioning.  The key carries a salt, so
    one customer's events go to ``STATIC_SALT`` tasks.  Nation is broadcast
    behind the row check."""
    paths = new_paths(spark, "stream_static_join")
    t = Tables(spark, sf_dir)
    dim = (t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
           .join(bounded_broadcast(t.nation.select("n_nationkey", "n_name")),
                 F.col("c_nationkey") == F.col("n_nationkey"))
           .select("c_custkey", "c_mktsegment", "n_name",
                   F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(STATIC_SALT - 1).cast("bigint")))
                    .alias("c_salt"))
           .repartition(stream_partitions(spark), "c_custkey", "c_salt")
           .persist(StorageLevel.MEMORY_AND_DISK))
    salt = F.pmod(F.xxhash64("event_id"), F.lit(STATIC_SALT))
    enriched = (events_stream(spark, sf_dir).withColumn("salt", salt)
                .join(dim, (F.col("user_id") == F.col("c_custkey")) & (F.col("salt") == F.col("c_salt")))
                .select("event_id", "user_id", "event_type", "c_mktsegment", "n_name"))
    try:
        run_available_now(enriched, paths, "append")
    finally:
        dim.unpersist()
    return spark.read.parquet(paths.sink)


def _halves(ev: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events up to the middle of their time range, and those after it or
    without time."""
    mid = ev.agg(F.max("ts").alias("hi"), F.min("ts").alias("lo")).first()
    lo = mid["lo"] or datetime(1970, 1, 1)
    split = ntz_lit(lo + ((mid["hi"] or lo) - lo) / 2)
    return ev.where(F.col("ts") < split), ev.where((F.col("ts") >= split) | F.col("ts").isNull())


@query("stream_stateful", tier="stream", oracle="""
SELECT user_id, COUNT(*) AS n_events, ARG_MAX(value, ts) AS last_value,
       MAX(ts) FILTER (value IS NOT NULL) AS last_ts
FROM events
GROUP BY user_id
""")
def stream_stateful(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count and latest value per user in keyed state
    (applyInPandasWithState, RocksDB), over two runs: the first half of
    the time range, then a restart from the checkpoint with the second half.
    Each batch emits the updated users; the result is each user's last
    emitted state."""
    paths = new_paths(spark, "stream_stateful")
    sink = f"{paths.sink}/batches"
    for part in _halves(Tables(spark, sf_dir).events):
        stage(part, paths.source)
        run_available_now(running_user_stats(events_stream(spark, source_dir=paths.source)),
                          paths, "update", per_batch_sink(sink))
    if not path_exists(spark, sink):                    # no event, so no batch
        return spark.createDataFrame([], "user_id long, n_events long, last_value double, last_ts timestamp_ntz")
    emitted = spark.read.parquet(sink)
    latest = emitted.groupBy("user_id").agg(
        F.max_by(F.struct("n_events", "last_value", "last_ts"), "batch_id").alias("s"))
    return latest.select("user_id", "s.n_events", "s.last_value", "s.last_ts")


IDLE_HOURS = 24


@query("stream_visits", tier="stream", oracle=f"""
WITH e AS (SELECT * FROM events WHERE user_id IS NOT NULL AND ts IS NOT NULL),
g AS (SELECT *, CASE WHEN ts <= LAG(ts) OVER w + INTERVAL {IDLE_HOURS} HOUR THEN 0 ELSE 1 END AS fresh
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT *, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS visit FROM g),
s AS (SELECT user_id, visit, MIN(ts) AS first_ts, MAX(ts) AS last_ts, COUNT(*) AS n_events,
             LAST(value ORDER BY ts, event_id) AS last_value
      FROM v GROUP BY user_id, visit)
SELECT user_id, first_ts, last_ts, n_events, last_value FROM s
QUALIFY LEAD(visit) OVER (PARTITION BY user_id ORDER BY visit) IS NOT NULL
     OR last_ts + INTERVAL {IDLE_HOURS} HOUR <= (SELECT MAX(ts) FROM e) - INTERVAL 1 HOUR
""")
def stream_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits that ended, by event-time timers on keyed state, over two runs
    with a restart between: timers set in the first run fire in the second.
    Visits still open at the end stay in the state."""
    paths = new_paths(spark, "stream_visits")
    for part in _halves(Tables(spark, sf_dir).events):
        stage(part, paths.source)
        run_available_now(visits(events_stream(spark, source_dir=paths.source), IDLE_HOURS, WATERMARK), paths, "append")
    time = lambda c: F.timestamp_add("MICROSECOND", F.col(c), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
    return spark.read.schema(VISITS).parquet(paths.sink).select(
        "user_id", time("first_us").alias("first_ts"), time("last_us").alias("last_ts"), F.col("n").alias("n_events"), "last_value")


@query("stream_sink_upsert", tier="stream", oracle="""
SELECT user_id, event_id, ts, event_type, value
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
      FROM events) t
WHERE rn = 1
""")
def stream_sink_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event per user, kept as an upserted Parquet table (see
    ``UpsertTable``).  Two runs with a restart between exercise the merge
    against existing state."""
    paths = new_paths(spark, "stream_sink_upsert")
    table = UpsertTable(spark, f"{paths.sink}/table")
    for part in _halves(Tables(spark, sf_dir).events):
        stage(part, paths.source)
        run_available_now(events_stream(spark, source_dir=paths.source).select(*UPSERT_COLS),
                          paths, "append", table.upsert)
    return table.read()


UPSERT_COLS = ("user_id", "event_id", "ts", "event_type", "value")
UPSERT_SCHEMA = ("user_id bigint, event_id bigint, ts timestamp_ntz, event_type string, "
                 "value double, epoch bigint, bucket bigint")


class UpsertTable:
    """Latest event per user as Parquet, merged batch by batch, crash-safe.

    The folder holds one version per epoch (``epoch=<id>/bucket=<b>``) with the
    buckets of user_id that the epoch touched; a bucket's current rows are
    those of the last epoch that wrote it.  An epoch reads versions before its
    own and writes only its own, so nothing that is read is ever replaced: a
    crash at any point leaves the earlier versions whole, and a repeated epoch
    overwrites its own attempt.  The stream commits epochs in order, so every
    version before an epoch is complete when it runs, and of each bucket only
    the last one is needed: older ones are removed, so the table stays at most
    two versions large and an epoch costs the same however many came before.
    A table that does not exist yet is empty; any other failure to read is
    raised.

    ``buckets`` is a property of the table (a few hundred MB per bucket on a
    cluster); ``writers`` tasks write each bucket.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, writers: int = 1):
        self.spark, self.path, self.buckets, self.writers = spark, path, buckets, writers

    def _latest(self, df: DataFrame) -> DataFrame:
        """One row per user: the latest by (ts, event_id).  Spark limits each
        user to one row per map task before the shuffle."""
        w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
        bucket = F.pmod(F.xxhash64("user_id"), F.lit(self.buckets))
        return (df.select(*UPSERT_COLS).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
                  .drop("_rn").withColumn("bucket", bucket))

    def _current(self, before: int | None = None) -> DataFrame | None:
        """Current rows (with bucket) as of all epochs, or those before one."""
        if not path_exists(self.spark, self.path):
            return None
        rows = self.spark.read.schema(UPSERT_SCHEMA).parquet(self.path)
        if before is not None:
            rows = rows.where(F.col("epoch") < before)
        last = rows.groupBy("bucket").agg(F.max("epoch").alias("epoch"))    # at most one row per bucket
        return rows.join(F.broadcast(last), ["bucket", "epoch"]).drop("epoch")

    def _remove_superseded(self, epoch_id: int) -> None:
        """Of the versions before an epoch, keep each bucket's last one."""
        epochs = {int(p.rsplit("=", 1)[1]): p for p in children(self.spark, self.path) if "/epoch=" in p}
        newer: set[str] = set()
        for epoch in sorted((e for e in epochs if e < epoch_id), reverse=True):
            held = {p.rsplit("/", 1)[1]: p for p in children(self.spark, epochs[epoch]) if "/bucket=" in p}
            old = newer & set(held)
            if held and old == set(held):
                remove(self.spark, epochs[epoch])
            else:
                for b in old:
                    remove(self.spark, held[b])
            newer |= set(held)

    def upsert(self, batch: DataFrame, epoch_id: int) -> None:
        """Merge a micro-batch (foreachBatch); repeating it is harmless."""
        if path_exists(self.spark, self.path):
            self._remove_superseded(epoch_id)
        fresh = self._latest(batch).persist()
        try:
            touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]    # <= buckets
            if not touched:
                return
            merged, current = fresh, self._current(before=epoch_id)
            if current is not None:
                old = current.where(F.col("bucket").isin(touched))
                merged = self._latest(old.select(*UPSERT_COLS).unionByName(fresh.select(*UPSERT_COLS)))
            salt = F.pmod(F.xxhash64("user_id", F.lit(1)), F.lit(self.writers))
            (merged.repartition(F.col("bucket"), salt)
                   .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/epoch={epoch_id}"))
        finally:
            fresh.unpersist()

    def read(self) -> DataFrame:
        rows = self._current()
        if rows is None:
            rows = self.spark.createDataFrame([], UPSERT_SCHEMA)
        return rows.select(*UPSERT_COLS)
