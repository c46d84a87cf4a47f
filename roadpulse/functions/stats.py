"""Aggregate helpers with engine-independent results.

Means are computed from exact sums, divided once as a double, so summation order cannot
change the result and a rounded mean is the same on every cluster layout.
A column the rules round (speed_kmh and heat_index to 1 decimal) or an integer (humidity) is
scaled by 10^s to a BIGINT. A raw measurement (speed, temperature) has no fixed number of
decimals: it is summed as DECIMAL(38,12), which holds 12 decimals of every value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scaled(c: str | Column, scale: int) -> Column:
    """Row value as an exact BIGINT count of 10^-scale units."""
    return F.rint(_c(c) * (10 ** scale)).cast("bigint")


def exact_mean(c: str | Column, scale: int) -> Column:
    """AVG(c) from an exact scaled sum; null on an empty group."""
    s = scaled(c, scale)
    return F.sum(s).cast("double") / (F.count(s) * (10 ** scale)).cast("double")


WIDE = 12  # decimals kept of a raw measurement


def wide(c: str | Column) -> Column:
    """Row value as a decimal with WIDE decimals (null if it is no finite number)."""
    return _c(c).try_cast(f"decimal(38,{WIDE})")


def wide_mean(c: str | Column) -> Column:
    """AVG(c) of a raw measurement from an exact decimal sum; null on an empty group."""
    x = wide(c)
    return F.sum(x).cast("double") / F.count(x).cast("double")


def wide_units(c: str | Column) -> Column:
    """Row value as an exact whole number of 10^-WIDE units, DECIMAL(38,0), for sums that are
    multiplied further (|value| below 10^12; null if it is no finite number)."""
    unit = F.lit(10 ** WIDE).cast(f"decimal({WIDE + 1},0)")
    return (_c(c).try_cast(f"decimal({WIDE * 2},{WIDE})") * unit).cast("decimal(38,0)")


def big(c: str | Column) -> Column:
    """A count or sum as DECIMAL(38,0): products of them do not fit a BIGINT."""
    return _c(c).cast("decimal(38,0)")


def mean_from_parts(scaled_total: Column, count: Column, scale: int) -> Column:
    """Mean from an already aggregated scaled sum and its count (null when count is 0)."""
    return F.when(count > 0, scaled_total.cast("double") / (count.cast("double") * F.lit(float(10 ** scale))))


def sum_flag(c: str | Column) -> Column:
    """SUM(CAST(bool AS INT)); null when every value is null."""
    return F.sum(_c(c).cast("int")).cast("bigint")


def pct(part: Column, total: Column, digits: int = 1) -> Column:
    """round(100 * part / total, digits) in double arithmetic."""
    return F.round(F.lit(100.0) * part.cast("double") / total.cast("double"), digits)


def exact_stddev(c: str | Column, scale: int) -> Column:
    """Sample standard deviation from exact integer moments: with x scaled to integers,
    var = (n*sum(x^2) - sum(x)^2) / (n*(n-1)) is exact in DECIMAL(38,0) before the one
    division and square root. Null for fewer than two values, like STDDEV_SAMP."""
    s = scaled(c, scale)
    big = "decimal(38,0)"
    n = F.count(s).cast(big)
    s1 = F.sum(s).cast(big)
    s2 = F.sum((s * s).cast(big))
    numerator = (n * s2 - s1 * s1).cast("double")
    denominator = (n * (n - F.lit(1).cast(big))).cast("double")
    return F.when(F.count(s) > 1, F.sqrt(numerator / denominator) / F.lit(float(10 ** scale)))
