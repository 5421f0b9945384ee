"""Exact interpolated quantiles that never gather one group in one task.

Spark's ``percentile`` keeps every distinct value of a group in a single
aggregation buffer, which fails for a group that holds a large share of the
rows.  Here values are counted first (map-side combined, shuffled by key *and*
value), a coarse monotone bucketing finds the bucket that holds the wanted rank,
and only that bucket is ranked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], resolution: int = 256
) -> DataFrame:
    """Quantiles of ``value`` per ``keys`` with linear interpolation, as columns name -> p.

    ``resolution`` sets the number of logarithmic buckets per unit of
    ``ln(1 + |value|)``; correctness only needs the bucketing to be monotone.
    """
    v = F.col("_v")
    # Never NULL, so the join below adds no filter of its own to one of its two
    # sides and both sides share a single shuffle of the counts.
    bucket = F.coalesce(F.floor(F.signum(v) * F.log1p(F.abs(v)) * resolution), F.lit(0)).cast("bigint")
    counts = (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .filter(v.isNotNull())
        .groupBy(*keys, "_v")
        .agg(F.count("*").alias("_n"))
        .withColumn("_b", bucket)
    )
    ranks = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in wanted.items()}
    # At most (range in log units) x resolution buckets per group: small windows.
    per_group = Window.partitionBy(*keys)
    running = per_group.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    needed = reduce(
        lambda a, b: a | b,
        [(F.col("_start") <= F.ceil(r)) & (F.col("_end") > F.floor(r)) for r in ranks.values()],
    )
    targets = (
        counts.groupBy(*keys, "_b")
        .agg(F.sum("_n").alias("_bn"))
        .withColumns({"_total": F.sum("_bn").over(per_group), "_end": F.sum("_bn").over(running)})
        .withColumn("_start", F.col("_end") - F.col("_bn"))
        .filter(needed)
        .select(*keys, "_b", "_total", "_start")
    )
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        counts.join(targets, [*keys, "_b"])
        .withColumn("_hi", F.col("_start") + F.sum("_n").over(inside))
        .withColumn("_lo", F.col("_hi") - F.col("_n"))
    )

    def quantile(rank: Column) -> Column:
        def at(position: Column) -> Column:
            return F.max(F.when((F.col("_lo") <= position) & (position < F.col("_hi")), v))

        lower, upper = at(F.floor(rank)), at(F.ceil(rank))
        return lower + (upper - lower) * F.max(rank - F.floor(rank))

    return ranked.groupBy(*keys).agg(*[quantile(r).alias(name) for name, r in ranks.items()])


def exact_quantile(df: DataFrame, keys: list[str], value: str, p: float, out: str, resolution: int = 256) -> DataFrame:
    """One quantile per group, see :func:`exact_quantiles`."""
    return exact_quantiles(df, keys, value, {out: p}, resolution)


def approx_quantile(value: str, p: float, out: str, exact: bool) -> list[Column]:
    """The approximate quantile as a column of an aggregate, or nothing in exact mode."""
    return [] if exact else [F.percentile_approx(value, p).cast("double").alias(out)]


def add_quantile(
    grouped: DataFrame, rows: DataFrame, keys: list[str], value: str, p: float, out: str, exact: bool = True
) -> DataFrame:
    """Join the exact per-key quantile of ``rows[value]`` onto an aggregate by the same keys.

    In approximate mode the aggregate already holds it, see :func:`approx_quantile`.
    """
    if not exact:
        return grouped
    quantile = exact_quantile(rows, keys, value, p, out)
    if not keys:
        return grouped.withColumn(out, quantile.scalar())
    return grouped.join(quantile, keys, "left")
