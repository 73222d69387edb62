"""Visits of users by timer: keyed state with ``transformWithStateInPandas``.

A visit is a run of events of one user with no gap above ``idle``.  State per
user: the open visit, as one typed value, and an event-time timer at its last
event plus ``idle``; the visit is given out when the timer fires, or when a
later event shows that it has ended.  State and timers live in RocksDB and
survive a restart between the registration of a timer and its expiry.

Like a partial and a final aggregate: every Arrow batch is reduced to visits
per user first, so a busy user sends visits, not events, to the task that holds
their state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from quarry.functions.time import ntz_micros

FIELDS = [("first_us", T.LongType()), ("last_us", T.LongType()), ("last_id", T.LongType()),
          ("n", T.LongType()), ("last_value", T.DoubleType())]
VISIT = T.StructType([T.StructField(n, t) for n, t in FIELDS])
OUTPUT = T.StructType([T.StructField("user_id", T.LongType()), *VISIT.fields])


def visits_of(pdf: pd.DataFrame, idle_us: int) -> pd.DataFrame:
    """The visits per user among some events (user_id, event_id, us, value)."""
    pdf = pdf.sort_values(["user_id", "us", "event_id"], kind="stable")
    user, us = pdf["user_id"].to_numpy(), pdf["us"].to_numpy()
    new = np.append(True, (user[1:] != user[:-1]) | (us[1:] - us[:-1] > idle_us))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(pdf)) - 1
    return pd.DataFrame({"user_id": user[first], "first_us": us[first], "last_us": us[last], "last_id": pdf["event_id"].to_numpy()[last],
                         "n": last - first + 1, "last_value": pdf["value"].to_numpy()[last]})


class Visits(StatefulProcessor):
    def __init__(self, idle_us: int):
        self.idle_us = idle_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("visit", VISIT)

    def _rows(self, key, visits: list[tuple]) -> Iterator[pd.DataFrame]:
        if visits:
            yield pd.DataFrame([(key[0], *v) for v in visits], columns=["user_id", *[n for n, _ in FIELDS]])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [(int(r.first_us), int(r.last_us), int(r.last_id), int(r.n), None if pd.isna(r.last_value) else float(r.last_value))
                 for pdf in rows for r in pdf.itertuples()]
        if self.open.exists():
            parts.append(tuple(self.open.get()))
        parts.sort(key=lambda v: v[:3])
        merged = [parts[0]]
        for v in parts[1:]:
            m = merged[-1]
            if v[0] - m[1] > self.idle_us:
                merged.append(v)
            else:
                late = max(m, v, key=lambda x: x[1:3])
                merged[-1] = (min(m[0], v[0]), late[1], late[2], m[3] + v[3], late[4])
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.open.update(merged[-1])
        self.handle.registerTimer(-(-(merged[-1][1] + self.idle_us) // 1000))
        yield from self._rows(key, merged[:-1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.open.exists():
            visit = tuple(self.open.get())
            self.open.clear()
            yield from self._rows(key, [visit])

    def close(self) -> None:
        pass


def visits(stream: DataFrame, idle_hours: int, delay: str) -> DataFrame:
    """Closed visits of a stream of events: user_id, first_us, last_us, last_id,
    n, last_value.  Events without user or time belong to no visit."""
    idle_us = idle_hours * 3_600_000_000

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield visits_of(pdf, idle_us)

    parts = (stream.where("user_id is not null and ts is not null")
             .select("user_id", "event_id", ntz_micros("ts").alias("us"), "value").mapInPandas(reduce, OUTPUT))
    return (parts.withColumn("seen", F.timestamp_micros("last_us")).withWatermark("seen", delay).groupBy("user_id")
            .transformWithStateInPandas(Visits(idle_us), OUTPUT, "Append", "EventTime"))
