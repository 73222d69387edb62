"""Time helpers that do not depend on the session time zone.

The tables store wall-clock ``timestamp_ntz`` values.  Structured Streaming
needs a zoned ``timestamp`` for watermarks, and a plain cast would shift by
the session zone (and break on DST gaps).  These helpers map NTZ values to the
instant with the same UTC wall clock and back, exactly, in any session zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def ntz_micros(col: Column | str) -> Column:
    """Microseconds since 1970-01-01 00:00 of an NTZ wall-clock value."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), c)


def ntz_to_instant(col: Column | str) -> Column:
    """NTZ wall clock -> zoned timestamp, reading the wall clock as UTC."""
    return F.timestamp_micros(ntz_micros(col))


def instant_to_ntz(col: Column | str) -> Column:
    """Zoned timestamp -> NTZ wall clock in UTC (inverse of ntz_to_instant)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.expr(_EPOCH_NTZ))


def ntz_lit(value: str | datetime) -> Column:
    """A ``timestamp_ntz`` literal from text or a naive datetime.

    Built from text so that neither the Python process zone nor the session
    zone shifts it (a datetime literal would be read in local time).
    """
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else value
    return F.lit(text).cast("timestamp_ntz")
