"""Rows of a table without those whose key is in another, texts unshuffled.

An anti join of whole documents moves every text.  Here the keys that go are a
bit map of fixed size first: rows outside it stay where they are read, and only
the rows inside (those that go, and a few others) are for an exact join.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.suffix_dedup import bit_maps, in_map

#: a map of 2 MB: with as many keys as a tenth of its bits, a tenth of the rows
#: that stay are doubtful
BITS = 24


def give_back() -> None:
    """Return freed memory of this process to the system.  Workers, and the
    driver, go on with the next stage beside what the last one has left behind."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)                  # glibc only
    if trim is not None:
        trim(0)


def divided(rows: DataFrame, keys: DataFrame, column: str, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose long (hash) ``column`` is surely not among ``keys``, and
    the others.  However many keys there are, the map has 2 ** ``bits`` bits; a
    full one leaves all rows to the others."""
    spark = rows.sparkSession
    taken, _ = bit_maps(keys.select(F.col(column).alias("key"), F.lit(False).alias("hot")), bits)
    shared = spark.sparkContext.broadcast(taken.tobytes())

    @F.arrow_udf("boolean")
    def inside(key: pa.Array) -> pa.Array:
        give_back()
        return pa.array(in_map(np.frombuffer(shared.value, dtype=np.uint8), bits, key.to_numpy(zero_copy_only=False).view(np.uint64)))

    marked = rows.withColumn("__inside", inside(column))
    return marked.where("not __inside").drop("__inside"), marked.where("__inside").drop("__inside")
