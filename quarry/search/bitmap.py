"""Bit maps of hashed keys: of a fixed size whatever the number of keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLICES = 64


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit keys, well mixed."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def bit_map(keys: DataFrame, bits: int) -> np.ndarray:
    """The map of the long column ``key`` (already mixed; its low ``bits`` bits
    count), filled slice by slice by Spark; 2 ** bits / 8 bytes come here."""
    width = (1 << bits) // SLICES

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maps: dict[int, np.ndarray] = {}
        for b in batches:
            slot = b.column(0).to_numpy()
            for s in np.unique(slot // width):
                mine = slot[slot // width == s] - s * width
                m = maps.setdefault(int(s), np.zeros(width // 8, dtype=np.uint8))
                np.bitwise_or.at(m, mine >> 3, (128 >> (mine & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(maps), pa.int32()), pa.array([m.tobytes() for m in maps.values()], pa.binary())],
                                         names=["slice", "bits"])

    slots = keys.select(F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).alias("slot")).distinct()
    rows = (slots.repartition(SLICES, F.expr(f"slot div {width}")).mapInArrow(fill, "slice int, bits binary").collect())
    out = np.zeros((SLICES, width // 8), dtype=np.uint8)
    for r in rows:
        out[r["slice"]] |= np.frombuffer(r.bits, dtype=np.uint8)
    return out.reshape(-1)


def in_bit_map(bits_of: np.ndarray, bits: int, key: np.ndarray) -> np.ndarray:
    slot = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
    return (bits_of[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
