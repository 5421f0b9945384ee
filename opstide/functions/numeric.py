"""Numeric column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timeparts import col

GIB = 1024**3


def wait_ms(micros: str | Column) -> Column:
    """Microseconds to milliseconds; a missing value counts as 0."""
    return F.coalesce(col(micros) / 1000, F.lit(0.0))


def bytes_to_gb(size: str | Column) -> Column:
    """Bytes to GiB rounded to two places."""
    return F.round(col(size) / GIB, 2)


def pct_change(base: str | Column, current: str | Column) -> Column:
    """Percent change; NULL when the base is 0 or missing."""
    base, current = col(base).cast("double"), col(current).cast("double")
    return F.try_divide(current - base, base) * 100


def trend_pct(base: str | Column, current: str | Column) -> Column:
    """Percent change where growth from a zero base counts as 100 %."""
    base, current = col(base).cast("double"), col(current).cast("double")
    return F.when(base == 0, F.when(current > 0, 100.0).otherwise(0.0)).otherwise(
        F.try_divide(current - base, base) * 100
    )


def distinct_count(c: str | Column, exact: bool = True) -> Column:
    return F.count_distinct(col(c)) if exact else F.approx_count_distinct(col(c))


def t_quantile_975(dof: str | Column) -> Column:
    """0.975 quantile of Student's t: table for 1-4 degrees of freedom, then the
    Cornish-Fisher expansion around the normal quantile (error below 1e-3)."""
    v = col(dof).cast("double")
    z = 1.959963984540054
    terms = [
        (z**3 + z) / 4,
        (5 * z**5 + 16 * z**3 + 3 * z) / 96,
        (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
        (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160,
    ]
    series = F.lit(z)
    power = F.lit(1.0)
    for term in terms:
        power = power * v
        series = series + F.try_divide(F.lit(term), power)
    # Student's t 0.975 quantiles for 1, 2, 3 and 4 degrees of freedom.
    small = F.when(v == 1, 12.7062).when(v == 2, 4.3027).when(v == 3, 3.1824).when(v == 4, 2.7764)
    return F.when(v >= 5, series).otherwise(small)
