"""Running Structured Streaming queries to completion and reading the sink.

Every streaming query here runs with ``trigger(availableNow=True)``: it
processes everything present in its source (in as many micro-batches as the
source options ask for), advances the watermark, and stops.  The sink is a
Parquet table under the shared scratch folder; the query function returns
that table as a batch DataFrame.  Nothing passes through the driver: no
memory sink, no collect.

Checkpoints live next to the sink in a fresh folder per call (a reused
checkpoint would resume and return nothing new), except where a query
restarts on purpose from its own checkpoint to show recovery.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.time import ntz_to_instant
from quarry.session import ROCKSDB_PROVIDER, scratch_path
from quarry.sources.tables import EVENTS_SCHEMA, table_path

EVENT_TIME = "event_time"


@dataclass(frozen=True)
class StreamPaths:
    base: str

    @property
    def source(self) -> str:
        return f"{self.base}/source"

    @property
    def sink(self) -> str:
        return f"{self.base}/sink"

    @property
    def checkpoint(self) -> str:
        return f"{self.base}/checkpoint"


def new_paths(spark: SparkSession, name: str) -> StreamPaths:
    return StreamPaths(scratch_path(spark, "stream", name))


def events_stream(spark: SparkSession, sf_dir: str | None = None, source_dir: str | None = None,
                  files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a stream, with a zoned ``event_time`` column.

    Either the driver's events table (``sf_dir``; one file or a folder of
    files) or a folder of staged Parquet files (``source_dir``).  The schema
    is given, never inferred.
    """
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if files_per_trigger is not None:               # oldest files first
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = source_dir if source_dir is not None else table_path(sf_dir, "events")
    if source_dir is None and not is_folder(spark, path):
        # a file source wants a folder: the one around the file, and only it
        path, name = path.rsplit("/", 1)
        reader = reader.option("pathGlobFilter", name)
    return reader.parquet(path).withColumn(EVENT_TIME, ntz_to_instant("ts"))


def stage(df: DataFrame, folder: str) -> None:
    """Append a batch DataFrame as new Parquet files to a stream source folder."""
    df.write.mode("append").parquet(folder)


def run_available_now(df: DataFrame, paths: StreamPaths, output_mode: str = "append",
                      foreach_batch: Callable[[DataFrame, int], None] | None = None,
                      name: str | None = None):
    """Start, process all available input, stop; raise if the query failed.
    Returns the finished query (its progress reports stay readable)."""
    w = (df.writeStream.outputMode(output_mode)
           .option("checkpointLocation", paths.checkpoint)
           .trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").option("path", paths.sink)
    q = _start(df.sparkSession, w)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"streaming query failed: {q.exception()}")
    return q


def stream_partitions(spark: SparkSession) -> int:
    """Shuffle partitions a stream started by ``run_available_now`` uses:
    the cluster's cores, or the session setting if that is smaller."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        return min(current, spark.sparkContext.defaultParallelism)
    except Exception:          # Spark Connect: leave the session setting
        return current


def _start(spark: SparkSession, writer):
    """Start a query with the settings every stateful stream here wants; they
    hold for the start call only (a query keeps its own copy of the conf).

    * State lives in RocksDB (off-heap, spills to local disk, checkpointed
      incrementally) instead of executor heap.
    * One state partition per core of the cluster.  Stateful operators keep
      one state store per shuffle partition, and the count is fixed in the
      checkpoint at the first start (restarts keep it).  A batch-sized
      ``spark.sql.shuffle.partitions`` (hundreds locally, 10^5 at 100 TB)
      would open that many stores per operator per micro-batch.
    * Sessions are merged in each map task before the shuffle, so a busy user
      sends sessions, not events, to the task that holds their state.
    """
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.shuffle.partitions": str(stream_partitions(spark)),
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def overwrite_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer for complete mode: each batch is a full result in a
    folder of its own, so a failed write never costs the result before it; a
    repeated batch overwrites its own folder.  ``read_latest`` reads it."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch_id}")
    return write


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The result of the last batch of ``overwrite_sink``."""
    table = spark.read.parquet(path)
    last = table.agg(F.max("epoch")).first()[0]
    if last is None:                    # an empty result: any folder says as much
        return table.drop("epoch")
    return table.where(F.col("epoch") == last).drop("epoch")


def _place(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its file system; other failures are raised."""
    fs, where = _place(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """The paths in a folder."""
    fs, where = _place(spark, path)
    return [str(f.getPath()) for f in fs.listStatus(where)]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path with all below it."""
    fs, where = _place(spark, path)
    fs.delete(where, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether a path, which must exist, is a folder."""
    fs, where = _place(spark, path)
    return fs.getFileStatus(where).isDirectory()


def per_batch_sink(path: str) -> Callable[[DataFrame, int], None]:
    """foreachBatch writer keeping each batch in its own ``batch_id=`` folder;
    a retried batch overwrites its own folder, so replays never duplicate."""
    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={epoch_id}")
    return write


def window_cols(window_col: str = "window") -> list:
    """Flatten a window struct back to NTZ wall-clock start/end columns."""
    from quarry.functions.time import instant_to_ntz
    return [instant_to_ntz(F.col(f"{window_col}.start")).alias("window_start"),
            instant_to_ntz(F.col(f"{window_col}.end")).alias("window_end")]
