"""Rounding by integer arithmetic, so that every engine gives the same digits.

Ties go up. A percentage or a mean is first an integer number of units
(hundredths of a percent, thousandths of a point) and only then a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def percent(part: Column, total: Column) -> Column:
    """100 * part / total with two decimals; null when total is 0."""
    return F.when(total > 0, _div(part * 20000 + total, total * 2) / F.lit(100.0))


def mean_units(total: Column, n: Column, digits: int = 3) -> Column:
    """total / n as an integer number of 10**-digits units, for total >= 0."""
    return F.when(n > 0, _div(total * (2 * 10**digits) + n, n * 2))


def mean(total: Column, n: Column, digits: int = 3) -> Column:
    """total / n with the given number of decimals, for total >= 0."""
    return mean_units(total, n, digits) / F.lit(float(10**digits))


def half_up(x: Column, digits: int) -> Column:
    """Round a double half up."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / F.lit(scale)


def sample_std(total: Column, total_sq: Column, n: Column) -> Column:
    """Sample standard deviation from integer sums; null below two rows."""
    s, q, m = (c.cast("double") for c in (total, total_sq, n))
    return F.when(n > 1, F.sqrt((q - s * s / m) / (m - 1)))
