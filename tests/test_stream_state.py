"""Timers, rate limits and the upsert table's versions."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import functions as F

from quarry.sources.tables import EVENTS_SCHEMA
from quarry.streaming import queries, visits
from quarry.streaming.runner import events_stream, new_paths, run_available_now, stage

T0 = datetime(2024, 1, 1)


def events(spark, rows):
    """(user, hours, value) rows as events."""
    data = [(i, None if h is None else T0 + timedelta(hours=h), u, "view", v, "{}") for i, (u, h, v) in enumerate(rows)]
    return spark.createDataFrame(data, EVENTS_SCHEMA)


def _run(spark, paths, idle=10):
    run_available_now(visits.visits(events_stream(spark, source_dir=paths.source), idle, "1 hour"), paths, "append")
    got = spark.read.schema(visits.OUTPUT).parquet(paths.sink).collect()
    return sorted((r.user_id, r.first_us, r.last_us, r.n, r.last_value) for r in got)


def us(hours):
    return int((T0 + timedelta(hours=hours) - datetime(1970, 1, 1)).total_seconds() * 1_000_000)


def test_timer_survives_a_restart(spark):
    """A timer set in one run fires in the next, and only once time has passed."""
    paths = new_paths(spark, "test_visits")
    stage(events(spark, [(1, 0, 1.0), (1, 5, 2.0), (2, 4, 3.0), (None, 1, 9.0), (3, None, 9.0)]), paths.source)
    assert _run(spark, paths) == []                                         # nobody idle yet
    stage(events(spark, [(2, 13, 4.0)]), paths.source)
    assert _run(spark, paths) == []                                         # watermark at 12: user 1 is due at 15
    stage(events(spark, [(2, 16.5, 5.0)]), paths.source)
    assert _run(spark, paths) == [(1, us(0), us(5), 2, 2.0)]
    stage(events(spark, [(1, 40, 6.0)]), paths.source)                      # user 2 was due at 26.5; user 1 comes again
    assert _run(spark, paths) == [(1, us(0), us(5), 2, 2.0), (2, us(4), us(16.5), 3, 5.0)]


def test_visits_do_not_depend_on_batches(spark):
    rng = random.Random(2)
    rows = sorted(((rng.choice([1, 1, 1, 2, 3]), rng.randrange(0, 3000) / 4, float(i)) for i in range(400)), key=lambda r: r[1])
    one, many = new_paths(spark, "test_visits"), new_paths(spark, "test_visits")
    df = events(spark, rows).repartition(6).persist()
    stage(df, one.source)
    whole = _run(spark, one, 6)
    for lo in range(0, 750, 150):
        stage(df.where((F.col("event_id") >= lo // 150 * 80) & (F.col("event_id") < lo // 150 * 80 + 80)), many.source)
        got = _run(spark, many, 6)
    df.unpersist()
    assert got == whole and len(whole) > 20


def test_visits_of_a_batch():
    pdf = pd.DataFrame({"user_id": [2, 1, 1, 1], "event_id": [0, 1, 2, 3], "us": [5, 100, 0, 10], "value": [None, 1.0, 2.0, 3.0]})
    got = visits.visits_of(pdf, 10)
    assert got[["user_id", "first_us", "last_us", "n"]].values.tolist() == [[1, 0, 10, 2], [1, 100, 100, 1], [2, 5, 5, 1]]


def test_rate_limit_makes_micro_batches(spark):
    """One run, a data batch per slice; the first day arrives last and is dropped."""
    paths = new_paths(spark, "test_rate")
    q = queries.rate_limited(spark, spark.read.parquet("/root/testdata/sf0.001/events.parquet"), paths)
    data = [p for p in q.recentProgress if p["numInputRows"] > 0]
    assert len(data) == queries.RATE_SLICES + 1 > 2
    assert sum(p["numInputRows"] for p in data) == 1000
    days = spark.read.parquet(paths.sink).select("window_start").collect()
    assert len(days) == 28 and min(d[0] for d in days) == datetime(2024, 1, 2)


def test_upsert_keeps_two_versions_at_most(spark):
    from quarry.session import scratch_path
    table = queries.UpsertTable(spark, scratch_path(spark, "test_upsert"), buckets=2)
    for epoch in range(7):
        table.upsert(events(spark, [(u, epoch, float(epoch)) for u in range(20)]), epoch)
        versions = spark.read.parquet(table.path).select("bucket", "epoch").distinct().groupBy("bucket").count()
        assert max(r["count"] for r in versions.collect()) <= 2
    table.upsert(events(spark, [(3, 50, 1.5)]), 7)                          # touches one bucket of two
    table.upsert(events(spark, [(3, 51, 2.5)]), 8)
    got = {r.user_id: r.value for r in table.read().collect()}
    assert got == {u: 6.0 for u in range(20)} | {3: 2.5}


def test_events_without_time_are_not_lost(spark):
    from quarry.streaming.queries import _halves
    ev = events(spark, [(1, 0, 1.0), (2, 9, 1.0), (3, None, 1.0)])
    a, b = _halves(ev)
    assert {r.user_id for r in a.unionByName(b).collect()} == {1, 2, 3}
    a, b = _halves(ev.where("ts is null"))
    assert a.count() == 0 and b.count() == 1
