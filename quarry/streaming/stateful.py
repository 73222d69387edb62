"""Custom keyed state: running count and latest value per user.

Two steps, like a partial and a final aggregate.  A stateless ``mapInPandas``
reduces every Arrow batch to one row per user, so what a busy user sends to
the task that holds their state is one row per batch, not their events.
``applyInPandasWithState`` then folds these rows into a four-field state
(count, latest time, its event id, its value), kept in the RocksDB state
store; state travels with the rows (no per-key round trips).

The fold is order-independent (latest = largest event time, ties broken by
event id), so the result does not depend on how rows were split into
micro-batches.  Rows without time or value count, but are never the latest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quarry.functions.time import ntz_micros

STATE_SCHEMA = T.StructType([
    T.StructField("n", T.LongType()),
    T.StructField("last_us", T.LongType()),
    T.StructField("last_id", T.LongType()),
    T.StructField("last_value", T.DoubleType()),
])

OUTPUT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("n_events", T.LongType()),
    T.StructField("last_value", T.DoubleType()),
    T.StructField("last_us", T.LongType()),
])


PARTIAL_SCHEMA = T.StructType([T.StructField("user_id", T.LongType()), *STATE_SCHEMA.fields])


def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row (user, n, latest) per user of every batch of events."""
    for pdf in batches:
        if not len(pdf):
            continue
        n = pdf.groupby("user_id", dropna=False).size().rename("n").reset_index()
        timed = pdf[pdf["us"].notna() & pdf["value"].notna()]
        last = (timed.sort_values(["us", "event_id"]).drop_duplicates("user_id", keep="last")
                .rename(columns={"us": "last_us", "event_id": "last_id", "value": "last_value"}))
        out = n.merge(last[["user_id", "last_us", "last_id", "last_value"]], on="user_id", how="left")
        yield out.astype({"user_id": "Int64", "n": "int64", "last_us": "Int64", "last_id": "Int64"})


def fold_user(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    n, last_us, last_id, last_value = state.get if state.exists else (0, None, None, None)
    for pdf in batches:
        if not len(pdf):
            continue
        n += int(pdf["n"].sum())
        timed = pdf[pdf["last_us"].notna()]
        if not len(timed):
            continue
        us, ids = timed["last_us"].to_numpy(dtype="int64"), timed["last_id"].to_numpy(dtype="int64")
        i = int(np.lexsort((ids, us))[-1])              # latest (time, id) in the batch
        cand = (int(us[i]), int(ids[i]))
        if last_us is None or cand > (last_us, last_id):
            last_us, last_id, last_value = cand[0], cand[1], float(timed["last_value"].iat[i])
    state.update((n, last_us, last_id, last_value))
    user = None if pd.isna(key[0]) else key[0]
    yield pd.DataFrame({"user_id": pd.array([user], "Int64"), "n_events": [n], "last_value": [last_value],
                        "last_us": pd.array([last_us], "Int64")})


def running_user_stats(stream: DataFrame) -> DataFrame:
    """Per-batch updates of (user_id, n_events, last_value, last_ts)."""
    out = (stream.select("user_id", "event_id", "value", ntz_micros("ts").alias("us"))
                 .mapInPandas(reduce_batches, PARTIAL_SCHEMA)
                 .groupBy("user_id")
                 .applyInPandasWithState(fold_user, OUTPUT_SCHEMA, STATE_SCHEMA, "update",
                                         GroupStateTimeout.NoTimeout))
    return out.select("user_id", "n_events", "last_value",
                      F.timestamp_add("MICROSECOND", F.col("last_us"),
                                      F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")).alias("last_ts"))
