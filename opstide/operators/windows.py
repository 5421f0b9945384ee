"""Trends over ordered rows.

Raw events are always reduced to one row per day (or hour, or day and key)
first, so every window partition is bounded by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import distinct_count, pct_change, trend_pct
from ..functions.timeparts import AsOf, within


def trailing(n: int, order: str, keys: tuple[str, ...] = ()):
    """The current and the ``n - 1`` preceding rows."""
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(-(n - 1), 0)


def trend_7d(df: DataFrame, value: str = "lock_wait_time", out: str = "avg_wait") -> DataFrame:
    daily = df.groupBy("event_date").agg(F.avg(value).alias(out))
    return daily.withColumn("trend_7d", F.avg(out).over(trailing(7, "event_date")))


def daily_deviation(df: DataFrame, as_of: AsOf, days: int = 30, exact: bool = True) -> DataFrame:
    """Daily counts against their 7-row mean in sample standard deviations."""
    daily = (
        within(df, "event_date", as_of, days=days)
        .groupBy("event_date")
        .agg(F.count("*").alias("queries"), distinct_count("session", exact).alias("sessions"))
    )
    week = trailing(7, "event_date")
    return daily.withColumns(
        {"avg_7d": F.avg("queries").over(week), "std_7d": F.stddev_samp("queries").over(week)}
    ).withColumn("deviation", F.try_divide(F.col("queries") - F.col("avg_7d"), F.col("std_7d")))


def _numbered(daily: DataFrame, order: str, keys: tuple[str, ...] = ()) -> DataFrame:
    everything = Window.partitionBy(*keys)
    return daily.withColumns(
        {"_rn": F.row_number().over(everything.orderBy(order)), "_n": F.count("*").over(everything)}
    )


def weekly_trend(df: DataFrame, as_of: AsOf, days: int = 7, mode: str = "halves") -> DataFrame:
    """Change of the mean daily wait within the last week, one row or none.

    ``halves`` compares the two halves of the days; ``ends`` compares the first
    three with the last three days and needs at least four.
    """
    daily = (
        within(df, "event_datetime", as_of, days=days)
        .groupBy(F.to_date("event_datetime").alias("date"))
        .agg(F.avg("lock_wait_time").alias("avg_wait"))
    )
    return trend_of_days(daily, mode)


def trend_of_days(daily: DataFrame, mode: str = "halves", keys: tuple[str, ...] = ()) -> DataFrame:
    rn, n = F.col("_rn"), F.col("_n")
    if mode == "ends":
        early, late, enough, digits = rn <= 3, rn > n - 3, 4, 1
    else:
        half = F.floor(n / 2)
        early, late, enough, digits = rn <= half, rn > half, 2, None
    means = (
        _numbered(daily, "date", keys)
        .groupBy(*keys)
        .agg(
            F.avg(F.when(early, F.col("avg_wait"))).alias("first"),
            F.avg(F.when(late, F.col("avg_wait"))).alias("second"),
            F.count("*").alias("days"),
        )
        .filter(F.col("days") >= enough)
    )
    change = F.when(F.col("first") > 0, pct_change("first", "second")).otherwise(0.0)
    return means.select(
        *keys,
        (F.round(change, digits) if digits else change).alias("trend_pct"),
        (F.col("first") / 1000).alias("avg_first_ms"),
        (F.col("second") / 1000).alias("avg_second_ms"),
    )


def lock_trends(daily: DataFrame) -> DataFrame:
    """First seven against last seven days, with peaks; no row for under seven days."""
    base, current = F.col("_rn") <= 7, F.col("_rn") > F.col("_n") - 7

    def mean(condition: Column, c: str) -> Column:
        return F.avg(F.when(condition, F.col(c)))

    measures = {"locks": "total_locks", "deadlocks": "deadlocks", "wait": "avg_wait"}
    aggregates = [F.count("*").alias("days_analyzed")]
    for name, c in measures.items():
        aggregates.append(mean(base, c).alias(f"base_avg_{name}"))
        aggregates.append(mean(current, c).alias(f"current_avg_{name}"))
    earliest = F.date_diff(F.lit("9999-12-31").cast("date"), F.col("event_date"))
    aggregates += [
        F.max("deadlocks").alias("max_deadlocks_day"),
        F.max_by("event_date", F.struct("deadlocks", earliest)).alias("max_deadlocks_date"),
        F.max("max_wait").alias("max_wait_time"),
        F.max_by("event_date", F.struct("max_wait", earliest)).alias("max_wait_date"),
    ]
    return (
        _numbered(daily, "event_date")
        .agg(*aggregates)
        .filter(F.col("days_analyzed") >= 7)
        .withColumns(
            {
                "locks_trend_pct": trend_pct("base_avg_locks", "current_avg_locks"),
                "deadlocks_trend_pct": trend_pct("base_avg_deadlocks", "current_avg_deadlocks"),
                "wait_time_trend_pct": trend_pct("base_avg_wait", "current_avg_wait"),
            }
        )
    )


def chrono_split(df: DataFrame, keys: list[str], order: str, share: float = 0.8) -> DataFrame:
    """Mark the first ``floor(share * n)`` rows of each series as training rows."""
    series = Window.partitionBy(*keys)
    position = F.row_number().over(series.orderBy(order))
    return df.withColumn("is_train", position <= F.floor(F.count("*").over(series) * F.lit(share)))


def first_crossing(df: DataFrame, keys: list[str], horizon: str, value: str, bound) -> DataFrame:
    """Earliest horizon at which a forecast exceeds its bound, with the value there."""
    above = df.filter(F.col(value) > bound)
    return above.groupBy(*keys).agg(
        F.min(horizon).alias("first_horizon"), F.min_by(value, horizon).alias("value_at_crossing")
    )


def wide_ffill(df: DataFrame, values: list[str], row: str = "date", column: str = "table_name", value: str = "size_gb") -> DataFrame:
    """One column per listed series and one row per date, gaps filled with the last value."""
    wide = df.groupBy(row).pivot(column, values).agg(F.avg(value))
    so_far = Window.partitionBy().orderBy(row).rowsBetween(Window.unboundedPreceding, 0)
    return wide.withColumns({v: F.last(F.col(f"`{v}`"), ignorenulls=True).over(so_far) for v in values})


def event_gaps(df: DataFrame, key: str, version: str = "version") -> DataFrame:
    """Per key and day: number of events, gap to the previous day with events, last version.

    Events on the same day have gap 0, so counting them is enough and a key with
    very many events still yields at most one row per calendar day.
    """
    ordered = Window.partitionBy(key).orderBy("date")
    daily = df.groupBy(key, "date").agg(F.count("*").alias("events"), F.max(version).alias("last_version"))
    return daily.withColumns(
        {
            "gap": F.datediff("date", F.lag("date").over(ordered)),
            "index": F.sum("events").over(ordered.rowsBetween(Window.unboundedPreceding, 0)) - F.col("events"),
        }
    )


def interval_stats(df: DataFrame, key: str, version: str = "version") -> DataFrame:
    """Count, mean, sample deviation and extremes of the gaps (days) between a key's events,
    and the slope of the gaps over their index for keys with more than three gaps."""
    repeats = F.col("events") - 1
    sums = (
        event_gaps(df, key, version)
        .groupBy(key)
        .agg(
            F.sum("events").alias("count"),
            F.sum("gap").alias("_s1"),
            F.sum(F.col("gap").cast("bigint") * F.col("gap")).alias("_s2"),
            # The gap before the event with 0-based index i is gap number i - 1.
            F.sum((F.col("index") - 1) * F.col("gap")).alias("_sxy"),
            F.min("gap").alias("_min_gap"),
            F.max("gap").alias("_max_gap"),
            F.max(repeats).alias("_repeats"),
            F.max("date").alias("last_date"),
            F.max_by("last_version", "date").alias("last_version"),
        )
    )
    n, s1 = F.col("count") - 1, F.coalesce(F.col("_s1"), F.lit(0))
    s2, sxy = F.coalesce(F.col("_s2"), F.lit(0)), F.coalesce(F.col("_sxy"), F.lit(0))
    sx = n * (n - 1) / 2
    sxx = n * (n - 1) * (2 * n - 1) / 6
    zero_gap = F.when(F.col("_repeats") > 0, 0)
    return sums.select(
        key,
        "count",
        F.try_divide(s1, n).alias("avg_interval"),
        F.when(n > 1, F.sqrt(F.greatest(F.try_divide(s2 - s1 * s1 / n, n - 1), F.lit(0.0)))).alias("std_interval"),
        F.least(zero_gap, F.col("_min_gap")).alias("min_interval"),
        F.greatest(zero_gap, F.col("_max_gap")).alias("max_interval"),
        "last_date",
        "last_version",
        F.when(n > 3, F.try_divide(n * sxy - sx * s1, n * sxx - sx * sx)).alias("trend"),
    )
