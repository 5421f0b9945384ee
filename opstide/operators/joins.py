"""Joins between events, baselines, forecasts, thresholds and alerts.

No broadcast hints: Catalyst broadcasts a side only when its measured size is
below the configured limit, and otherwise shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import AsOf, second_start, within


def conflict_pairs(
    df: DataFrame, event_type: str, as_of: AsOf, days: int = 7, limit: int | None = None
) -> DataFrame:
    """Tables hit in the same second by different sessions, with the number of row pairs.

    Row pairs are never built.  Events collapse to counts per (second, table) and
    per (second, session, table); pairs with different sessions are all pairs
    minus the same-session pairs, so a crowded second costs its number of
    tables, not its number of events squared.
    """
    rows = (
        within(df, "event_date", as_of, days=days)
        .filter(F.col("event_type") == event_type)
        .select(second_start("event_datetime").alias("second"), "session_id", "table_name")
    )
    per_session = rows.groupBy("second", "session_id", "table_name").agg(F.count("*").alias("n"))
    result = pair_counts(per_session)
    return result.orderBy(F.desc("conflicts"), "table1", "table2").limit(limit) if limit else result


def pair_counts(per_session: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Cross-session table pairs from counts ``n`` per (second, session_id, table_name); an unknown session conflicts with none."""
    per_session = per_session.filter(F.col("session_id").isNotNull())
    per_table = per_session.groupBy("second", "table_name").agg(F.sum("n").alias("n"))
    pairs = signed_pairs(per_table, ["second"], 1, by).unionByName(
        signed_pairs(per_session, ["second", "session_id"], -1, by)
    )
    totals = pairs.groupBy(*by, "table1", "table2").agg(F.sum("weight").alias("conflicts"))
    return totals.filter(F.col("conflicts") > 0)


def signed_pairs(counts: DataFrame, keys: list[str], sign: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Products of counts for ordered table pairs that share ``keys``, summed per pair."""
    left = counts.select(*keys, F.col("table_name").alias("table1"), F.col("n").alias("n1"))
    right = counts.select(*keys, F.col("table_name").alias("table2"), F.col("n").alias("n2"))
    return (
        left.join(right, keys)
        .filter(F.col("table1") < F.col("table2"))
        .groupBy(*by, "table1", "table2")
        .agg(F.sum(F.lit(sign) * F.col("n1") * F.col("n2")).alias("weight"))
    )


def limit_status(days: str | Column, info: bool = True) -> Column:
    """Status by days left: 7 critical, 14 warning, 30 info; missing counts as normal."""
    d = F.col(days) if isinstance(days, str) else days
    status = F.when(d <= 7, "critical").when(d <= 14, "warning")
    return (status.when(d <= 30, "info") if info else status).otherwise("normal")


def disk_status(usage: DataFrame, forecast: DataFrame) -> DataFrame:
    """Usage with the forecast made on the same day, when there is one."""
    made = forecast.select(
        F.col("metric_date").alias("date"),
        "volume",
        "forecast_7d_gb",
        "forecast_14d_gb",
        "forecast_30d_gb",
        "growth_rate_gb_per_day",
        "days_to_limit",
    )
    joined = usage.select("date", "volume", F.col("used_gb").alias("actual_used")).join(
        made, ["date", "volume"], "left"
    )
    return joined.withColumn("status", limit_status("days_to_limit"))


BASELINE_KEYS = ["event_hour", "is_weekend"]


def hourly_baseline(session_hourly: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Mean load per hour of day and weekend flag over the last ``days`` days."""
    return (
        within(session_hourly, "event_date", as_of, days=days)
        .groupBy(*BASELINE_KEYS)
        .agg(
            F.avg("total_sessions").alias("avg_sessions"),
            F.avg("avg_duration").alias("avg_duration"),
            F.avg("deadlock_count").alias("avg_deadlocks"),
            F.avg("exception_count").alias("avg_exceptions"),
        )
    )


def attach_baseline(current: DataFrame, baseline: DataFrame) -> DataFrame:
    """Look the baseline up for each (hour, weekend) row; missing means become 0."""
    means = ["avg_sessions", "avg_duration", "avg_deadlocks", "avg_exceptions"]
    looked_up = baseline.select(*BASELINE_KEYS, *[F.col(c).alias(f"baseline_{c}") for c in means])
    joined = current.join(looked_up, BASELINE_KEYS, "left")
    return joined.fillna(0.0, [f"baseline_{c}" for c in means])


def vector_match(left: DataFrame, right: DataFrame, labels: list[str], op=None, out: str = "value") -> DataFrame:
    """One-to-one match of two instant vectors on their labels, combined by ``op``."""
    combine = op or (lambda a, b: a - b)
    a = left.select(*labels, F.col("value").alias("_a"))
    b = right.select(*labels, F.col("value").alias("_b"))
    return a.join(b, labels).select(*labels, combine(F.col("_a"), F.col("_b")).alias(out))


def attach_thresholds(metrics: DataFrame, thresholds: DataFrame, on: str = "metric") -> DataFrame:
    """Threshold row of each metric row (long form), dropping metrics without one."""
    return metrics.join(thresholds, on)


# Lock threshold, the rollup column it applies to, and whether reaching it already counts.
LOCK_THRESHOLD_COLUMNS = [
    ("deadlock_warning", "total_deadlocks", True),
    ("timeout_warning", "total_timeouts", False),
    ("wait_time_warning", "avg_lock_wait_time", False),
    ("wait_time_critical", "avg_lock_wait_time", False),
    ("lock_intensity_warning", "lock_intensity", False),
]


GROWTH_THRESHOLD_COLUMNS = [
    ("trend_warning", "growth_rate", False),
    ("trend_critical", "growth_rate", False),
]


def threshold_breaches(
    df: DataFrame, thresholds: DataFrame, keys: tuple[str, ...] = ("event_date", "event_hour"), checks=None
) -> DataFrame:
    """Rows of a rollup in which a metric passed its configured threshold, one per breach."""
    watched = [
        F.struct(
            F.lit(name).alias("threshold_name"),
            F.col(column).cast("double").alias("value"),
            F.lit(inclusive).alias("inclusive"),
        )
        for name, column, inclusive in checks or LOCK_THRESHOLD_COLUMNS
    ]
    long_form = df.select(*keys, F.inline(F.array(*watched)))
    joined = attach_thresholds(long_form, thresholds, "threshold_name")
    above = F.col("value") > F.col("threshold_value")
    reached = F.col("inclusive") & (F.col("value") == F.col("threshold_value"))
    return joined.filter(above | reached).select(*keys, "threshold_name", "value", "threshold_value")


def inhibit(alerts: DataFrame, equal: tuple[str, ...] = ("alertname", "instance")) -> DataFrame:
    """Drop warnings for which a critical alert with the same labels exists."""
    critical = alerts.filter(F.col("severity") == "critical").select(*equal).distinct()
    warnings = alerts.filter(F.col("severity") == "warning").join(critical, list(equal), "left_anti")
    return warnings.select(*alerts.columns).unionByName(alerts.filter(F.col("severity") != "warning"))
