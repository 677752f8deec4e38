"""Numbers that do not depend on the order in which tasks finish.

Sums run on decimals, so a retried or re-partitioned job returns the same digits, and every
division happens once, on the final sums.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_up(value: str | Column, digits: int) -> Column:
    """Decimal rounding, ties away from zero, of a double or decimal."""
    return F.round(_column(value).cast("decimal(38,12)"), digits).cast("double")


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division; NULL when the denominator is zero or NULL."""
    return _column(numerator).cast("double") / F.nullif(
        _column(denominator).cast("double"), F.lit(0.0)
    )


def pct_change(now: str | Column, before: str | Column) -> Column:
    """Percent change, two digits."""
    return round_half_up(ratio(_column(now) - _column(before), before) * 100, 2)


def exact_sum(value: str | Column) -> Column:
    """Sum that does not depend on the order of rows.

    Twelve decimals and 26 digits before the point: every digit of a stored score, rating or
    price. Means are never summed, their sums and counts are.
    """
    return F.sum(_column(value).cast("decimal(38,12)"))


def exact_average(value: str | Column) -> Column:
    return ratio(exact_sum(value), F.count(_column(value)))


def sample_stddev(total: Column, squares: Column, count: Column) -> Column:
    """Sample standard deviation in currency units from exact sums over cents.

    ``total`` and ``squares`` are sums of cents and of squared cents as decimal(38,0).
    NULL for fewer than two values.
    """
    n = count.cast("decimal(18,0)")
    spread = (n * squares - total * total).cast("double")
    variance = spread / F.nullif((count * (count - 1)).cast("double"), F.lit(0.0))
    return F.sqrt(variance) / 100
