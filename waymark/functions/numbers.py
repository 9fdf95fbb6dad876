"""Rounding and ratios that give the same digits in any engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, places: int) -> Column:
    """Half away from zero, as a double."""
    scale = float(10**places)
    return F.signum(x) * (F.floor(F.abs(x) * scale + 0.5) / scale)


def seconds_between(start: Column, end: Column) -> Column:
    """Exact to the microsecond."""
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def money(x: Column) -> Column:
    """DECIMAL(12,2): sums of such columns are exact, so parts add up to their whole."""
    return x.cast("decimal(12,2)")


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles; null where b is 0 or null."""
    bottom = b.cast("double")
    return a.cast("double") / F.when(bottom != 0, bottom)


def mean(x: Column) -> Column:
    """The mean of a decimal column, as a double: its sum is exact, so the order of rows does not matter."""
    return ratio(F.sum(x), F.count(x))
