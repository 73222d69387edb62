"""Exact money arithmetic on integer cents.

Prices, balances, quantities and rates in the tables are whole cents stored
as doubles.  Summing doubles depends on the order of additions, which
differs between tasks, runs and engines.  Here each value is turned into
integer cents once (``rint(x * 100)``: the stored doubles are within 1e-8 of
a cent, far from a rounding tie), sums are integer sums, and the result is
scaled back to a decimal at the end -- exact, order-independent and much
cheaper than Spark's double -> decimal cast per row (which goes through
``BigDecimal``).

Overflow: a plain ``bigint`` sum is used only where a per-row bound makes
overflow impossible even at 100 TB (quantity <= 50, rates <= 0.10: at most
5,000 cents per row, 1.8e15 rows to overflow).  Price-like ("wide") sums are
split: the low six digits and the rest of each value are summed as two
``bigint`` columns (each below 1.1e6 in magnitude per row for every value
here, so safe past 8e12 rows) and recombined as a decimal once per group.
That keeps the aggregation buffer fixed-width -- a ``decimal(28,0)`` buffer
is stored as bytes and costs ~2x per row.
Averages are one double division of the exact sum, identical to
``CAST(SUM(CAST(x AS DECIMAL(12,2))) AS DOUBLE) / COUNT(x)`` in SQL.
Sums are reported as the double nearest to the exact decimal total.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 10 ** 6


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cents(col: Column | str) -> Column:
    """Integer hundredths of a cents-valued double."""
    return F.rint(_c(col) * 100).cast("bigint")


def sum_units(units: Column, wide: bool = True) -> Column:
    """Exact sum of integer units as decimal(38,0) (wide) or bigint."""
    if not wide:
        return F.sum(units)
    low = F.pmod(units, F.lit(_SPLIT))                     # 0 <= low < 10^6
    high = ((units - low) / _SPLIT).cast("bigint")         # exact: a multiple of 10^6
    return (F.sum(high).cast("decimal(38,0)") * _SPLIT
            + F.sum(low).cast("decimal(38,0)")).cast("decimal(38,0)")


def scale_back(units_sum: Column, scale: int) -> Column:
    """An exact integer sum in 10^-scale units, reported as the double
    nearest to the exact decimal value (the same double DuckDB gives for
    ``CAST(exact_decimal AS DOUBLE)``; doubles compare identically through
    every client conversion, decimals and dates do not)."""
    exact = (units_sum.cast("decimal(38,0)") / (10 ** scale)).cast(f"decimal(38,{scale})")
    return exact.cast("double")


def exact_sum(col: Column | str, wide: bool = True) -> Column:
    """Exact sum of a cents-valued double (reported as the nearest double)."""
    return scale_back(sum_units(cents(col), wide), 2)


def exact_avg(col: Column | str, wide: bool = True) -> Column:
    """Average as exact sum / count (one double division)."""
    return sum_units(cents(col), wide).cast("double") / 100 / F.count(_c(col))


def disc_price_units(ext: str = "l_extendedprice", disc: str = "l_discount") -> Column:
    """extendedprice * (1 - discount) in 10^-4 units."""
    return cents(ext) * (100 - cents(disc))


def charge_units(ext: str = "l_extendedprice", disc: str = "l_discount",
                 tax: str = "l_tax") -> Column:
    """extendedprice * (1 - discount) * (1 + tax) in 10^-6 units."""
    return disc_price_units(ext, disc) * (100 + cents(tax))


def revenue_units(ext: str = "l_extendedprice", disc: str = "l_discount") -> Column:
    """extendedprice * discount in 10^-4 units."""
    return cents(ext) * cents(disc)
