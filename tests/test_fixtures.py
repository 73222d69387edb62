"""Hand-written inputs for what the driver's tables never show: NULL keys,
ties, empty input, boundaries, duplicates and late rows."""

from __future__ import annotations

import datetime as dt
import re

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from quarry.functions.time import instant_to_ntz, ntz_lit, ntz_to_instant
from quarry.functions.udfs import WEIGHTED_MEAN, Tokens
from quarry.operators.joins import asof_join, band_join_by_time
from quarry.operators.windows import ntile
from quarry.streaming.runner import events_stream, new_paths, run_available_now, stage

T0 = dt.datetime(2024, 1, 1)


def ts(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def test_ntz_instant_roundtrip_any_session_zone(spark):
    from .conftest import conf
    df = spark.createDataFrame([(ts(0),), (ts(90.5),)], "t timestamp_ntz")
    with conf(spark, "spark.sql.session.timeZone", "America/Los_Angeles"):
        back = df.select(instant_to_ntz(ntz_to_instant("t")).alias("t")).collect()
        micros = df.select(F.unix_micros(ntz_to_instant("t")).alias("u")).collect()
    assert [r.t for r in back] == [ts(0), ts(90.5)]
    assert micros[0].u == int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)


def test_asof_join_ties_nulls_and_no_match(spark):
    left = spark.createDataFrame(
        [(1, "u", ts(10)), (2, "u", ts(20)), (3, "u", ts(5)), (4, None, ts(30)), (5, "w", ts(1))],
        "id int, k string, t timestamp_ntz")
    right = spark.createDataFrame(
        [(100, "u", ts(10)), (101, "u", ts(15)), (102, None, ts(0)), (103, "w", ts(2))],
        "rid int, k string, rt timestamp_ntz")
    got = {r.id: r.rid for r in asof_join(left, right, "k", "t", "rt", ["rid"]).collect()}
    # equal time matches (<=); earlier than every right row -> NULL;
    # a NULL key matches nothing (SQL equality)
    assert got == {1: 100, 2: 101, 3: None, 4: None, 5: None}


def test_band_join_inclusive_bounds_and_bucket_edges(spark):
    width = 3600
    left = spark.createDataFrame([(1, "u", ts(59)), (2, "u", ts(0))], "lid int, k string, lt timestamp_ntz")
    right = spark.createDataFrame([(10, "u", ts(59 + 60)),   # exactly +width, next bucket
                                   (11, "u", ts(60)),        # bucket edge
                                   (12, "u", ts(59 + 60.01)),  # just past the band
                                   (13, "v", ts(60))],
                                  "rid int, k2 string, rt timestamp_ntz")
    got = sorted((r.lid, r.rid) for r in
                 band_join_by_time(left, right, "k", "k2", "lt", "rt", width).collect())
    assert got == [(1, 10), (1, 11), (2, 11)]


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10])
def test_ntile_matches_sql(spark, n):
    from pyspark.sql import Window
    df = spark.range(n).withColumn("g", F.lit(1))
    w = Window.partitionBy("g").orderBy("id")
    got = (df.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(w.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)))
             .select(ntile("rn", "n", 4).alias("a"), F.ntile(4).over(w).cast("bigint").alias("b")).collect())
    assert all(r.a == r.b for r in got)


def test_two_phase_udaf_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 3.0, 2.0), ("b", None, 1.0), (None, 2.0, 1.0)],
                               "g string, v double, w double")
    got = {r.g: r.m for r in WEIGHTED_MEAN.apply(df, ["g"], "m").collect()}
    assert got["a"] == pytest.approx(2.0)
    assert got[None] == pytest.approx(2.0)
    empty = WEIGHTED_MEAN.apply(df.where("false"), ["g"], "m")
    assert empty.count() == 0


def test_tokens_udtf_whitespace_edges(spark):
    docs = spark.createDataFrame([(1, "  a\tbb \n c  "), (2, ""), (3, None), (4, "x")],
                                 "doc_id long, text string")
    got = sorted(tuple(r) for r in Tokens(docs.asTable()).collect())
    assert got == [(1, 0, "a"), (1, 1, "bb"), (1, 2, "c"), (4, 0, "x")]


def test_tokens_udtf_works_in_bounded_runs():
    """A batch is split run by run, and a long text piece by piece, so no
    output holds the tokens of much more than a megabyte of text; rows are
    those of a split of each whole text."""
    mb = 1 << 20
    words = ["a", "\u00e9t\u00e9", "\u00a0", "b" * 30, "\U0001f600"]
    gaps = [" ", "\t\n", "  \r\n  ", " \u2003"]
    long = "".join(words[i % 5] + gaps[i % 4] for i in range(6 * mb // 12))
    run = " " * (mb - 2) + "xy" + "z" * 50 + " \n" * 10       # a cut would fall into the token
    texts = ["skipped", None, "", "  a\tbb ", long, "x" * (3 * mb // 2), run, None, " \n", "c d" * 400_000, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array([7, 1, 2, None, 4, 5, 6, 7, 8, 9, 9], pa.int64()),
                                        pa.array(texts, pa.string())], names=["doc_id", "text"]).slice(1)
    out = list(Tokens.func().eval(batch))
    assert max(pc.sum(pc.binary_length(b["token"])).as_py() for b in out) <= 2 * mb
    assert max(b.num_rows for b in out) <= mb // 2
    got = [r for b in out for r in zip(*[c.to_pylist() for c in b.columns])]
    want = [(d, pos, token) for d, text in zip(batch["doc_id"].to_pylist(), texts[1:])
            for pos, token in enumerate(t for t in re.split(r"[ \t\n\r]+", text or "") if t)]
    assert got == want


def test_session_gap_boundary(spark):
    """Spark session windows: an event exactly ``gap`` after the previous one
    still joins the session (touching windows merge; the oracle breaks on
    ``>``), a larger gap starts a new one."""
    paths = new_paths(spark, "test_session_gap")
    rows = [(1, ts(0), 7, "view", 1.0, "{}"), (2, ts(30), 7, "view", 1.0, "{}"),
            (3, ts(59), 7, "view", 1.0, "{}"), (4, ts(600), 7, "view", 1.0, "{}")]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, "
                                     "event_type string, value double, props string")
    stage(ev, paths.source)
    s = (events_stream(spark, source_dir=paths.source)
         .withWatermark("event_time", "1 minute")
         .groupBy("user_id", F.session_window("event_time", "30 minutes").alias("s"))
         .agg(F.count("*").alias("n")))
    run_available_now(s, paths, "append")
    got = sorted(r.n for r in spark.read.parquet(paths.sink).collect())
    assert got == [3]          # {0, 30, 59}; the 600-minute session stays open


def test_late_rows_dropped_and_duplicates_removed(spark):
    paths = new_paths(spark, "test_late_dup")
    schema = ("event_id long, ts timestamp_ntz, user_id long, event_type string, "
              "value double, props string")
    first = spark.createDataFrame([(1, ts(0), 1, "view", 1.0, "{}"), (1, ts(0), 1, "view", 1.0, "{}"),
                                   (2, ts(300), 1, "view", 1.0, "{}")], schema)
    late = spark.createDataFrame([(3, ts(1), 1, "view", 1.0, "{}"), (2, ts(300), 1, "view", 1.0, "{}")],
                                 schema)

    def q():
        return (events_stream(spark, source_dir=paths.source)
                .withWatermark("event_time", "10 minutes")
                .dropDuplicatesWithinWatermark(["event_id"])
                .select("event_id"))

    stage(first, paths.source)
    run_available_now(q(), paths, "append")
    stage(late, paths.source)
    run_available_now(q(), paths, "append")
    got = sorted(r.event_id for r in spark.read.parquet(paths.sink).collect())
    assert got == [1, 2]       # duplicate 1 removed, late 3 dropped, replayed 2 removed


def test_ntz_literal_from_datetime(spark):
    got = spark.range(1).select(ntz_lit(ts(61)).alias("t")).first().t
    assert got == ts(61)


def _upsert_batches(spark):
    schema = ("event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    b1 = spark.createDataFrame([(1, ts(0), 1, "view", 1.0), (2, ts(5), 1, "buy", 2.0),
                                (3, ts(1), 2, "view", 3.0)], schema)
    b2 = spark.createDataFrame([(4, ts(3), 1, "view", 4.0), (5, ts(9), 3, "view", 5.0)], schema)
    return b1, b2


def test_upsert_replay_is_harmless(spark):
    from quarry.session import scratch_path
    from quarry.streaming.queries import UpsertTable
    b1, b2 = _upsert_batches(spark)
    for buckets, writers in ((64, 1), (1, 3)):
        table = UpsertTable(spark, scratch_path(spark, "test_upsert"), buckets, writers)
        assert table.read().collect() == []                  # missing means empty
        table.upsert(b1, 0)
        table.upsert(b2, 1)
        first = sorted(tuple(r) for r in table.read().select("user_id", "event_id").collect())
        table.upsert(b2, 1)                                  # replayed epoch
        again = sorted(tuple(r) for r in table.read().select("user_id", "event_id").collect())
        assert first == again == [(1, 2), (2, 3), (3, 5)]   # user 1 keeps ts(5), not the older ts(3)


def test_upsert_survives_a_lost_write(spark):
    """A crash may leave an epoch without some or all of its files; the
    versions before it are whole and the replay restores every row."""
    import shutil
    from pathlib import Path

    from quarry.session import scratch_path
    from quarry.streaming.queries import UpsertTable
    b1, b2 = _upsert_batches(spark)
    table = UpsertTable(spark, scratch_path(spark, "test_upsert"), buckets=2)
    table.upsert(b1, 0)
    table.upsert(b2, 1)
    want = sorted(tuple(r) for r in table.read().select("user_id", "event_id").collect())
    broken = sorted(Path(table.path.removeprefix("file:"), "epoch=1").glob("bucket=*"))
    shutil.rmtree(broken[0])                                 # between delete and rename
    assert {r.user_id for r in table.read().collect()} >= {1, 2}
    table.upsert(b2, 1)
    assert sorted(tuple(r) for r in table.read().select("user_id", "event_id").collect()) == want


def test_upsert_raises_when_the_table_cannot_be_read(spark):
    from pathlib import Path

    from quarry.session import scratch_path
    from quarry.streaming.queries import UpsertTable
    b1, b2 = _upsert_batches(spark)
    table = UpsertTable(spark, scratch_path(spark, "test_upsert"), buckets=1)
    table.upsert(b1, 0)
    part = next(Path(table.path.removeprefix("file:"), "epoch=0", "bucket=0").glob("part-*.parquet"))
    part.write_bytes(b"not parquet")
    crc = part.with_name(f".{part.name}.crc")
    if crc.exists():
        crc.unlink()
    with pytest.raises(Exception):
        table.upsert(b2, 1)
    assert not Path(table.path.removeprefix("file:"), "epoch=1", "_SUCCESS").exists()


def test_band_self_join_counts_nulls(spark):
    from quarry.operators.joins import band_self_join_counts
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, 3.0), (3, 1, None), (4, None, 1.0),
                                (5, 1, 5.0), (6, 2, 0.0)], "id int, k int, v double")
    got = {r.id: r.n_lower for r in band_self_join_counts(df, "k", "v").collect()}
    # SQL: COUNT(b.*) FROM df a LEFT JOIN df b ON a.k = b.k AND b.v < a.v GROUP BY a.id
    assert got == {1: 1, 2: 0, 3: 0, 4: 0, 5: 1, 6: 0}


def test_range_frame_null_timestamps_are_peers_only(spark):
    from quarry.operators.windows import range_frame_last_day
    ev = spark.createDataFrame([(1, 7, ts(0), 1.0), (2, 7, ts(60 * 23), 2.0), (3, 7, ts(60 * 25), 4.0),
                                (4, 7, None, 8.0), (5, 7, None, 16.0)],
                               "event_id long, user_id long, ts timestamp_ntz, value double")
    got = {r.event_id: (r.n_last_day, r.value_last_day) for r in range_frame_last_day(ev).collect()}
    assert got == {1: (1, 1.0), 2: (2, 3.0), 3: (2, 6.0), 4: (2, 24.0), 5: (2, 24.0)}


def test_stream_state_partitions_follow_cores(spark):
    """A batch-sized shuffle setting is not used for state stores; the
    session setting is left as it was."""
    from .conftest import conf
    paths = new_paths(spark, "test_state_parts")
    ev = spark.createDataFrame([(1, ts(0), 7, "view", 1.0, "{}"), (2, ts(5), 8, "view", 2.0, "{}")],
                               "event_id long, ts timestamp_ntz, user_id long, "
                               "event_type string, value double, props string")
    stage(ev, paths.source)
    agg = (events_stream(spark, source_dir=paths.source)
           .withWatermark("event_time", "1 minute")
           .groupBy("user_id", F.window("event_time", "1 hour")).count())
    with conf(spark, "spark.sql.shuffle.partitions", 200):
        q = run_available_now(agg, paths, "append")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    ops = [p for p in q.recentProgress if p["stateOperators"]]
    assert ops and ops[0]["stateOperators"][0]["numShufflePartitions"] == \
        spark.sparkContext.defaultParallelism
