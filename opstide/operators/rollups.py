"""Rollups and ranked reports over session, lock and technical-log events.

Every rollup groups the raw rows once with map-side combine.  Distinct counts
and quantiles are exact by default; ``exact=False`` switches to HyperLogLog and
approximate percentiles for the widest scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import distinct_count, pct_change, wait_ms
from ..functions.text import contains_ci, error_text
from ..functions.timeparts import (
    AsOf,
    as_datetime,
    calendar_flags,
    hour_start,
    is_weekend,
    is_work_hour,
    ts_literal,
    within,
)
from .quantiles import add_quantile, approx_quantile

HOUR_KEYS = ["event_date", "event_hour"]


def _type_count(kind: str) -> Column:
    return F.count_if(F.col("event_type") == kind)


DEADLOCKS = ("deadlocks", "DEADLOCK")
TIMEOUTS = ("timeouts", "TTIMEOUT")


def kinds(*pairs: tuple[str, str]) -> list[Column]:
    return [_type_count(kind).alias(name) for name, kind in pairs]


def non_empty(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.col(c) != "")
    return df


# ---- last hour ---------------------------------------------------------------


def last_hour_locks(df: DataFrame, as_of: AsOf, exact: bool = True) -> DataFrame:
    return within(df, "event_datetime", as_of, hours=1).agg(
        F.count("*").alias("total_locks"),
        *kinds(DEADLOCKS, TIMEOUTS),
        wait_ms(F.avg("lock_wait_time")).alias("avg_wait_ms"),
        wait_ms(F.max("lock_wait_time")).alias("max_wait_ms"),
        distinct_count("table_name", exact).alias("tables_involved"),
        distinct_count("session_id", exact).alias("sessions_involved"),
    )


def last_hour_sessions(df: DataFrame, as_of: AsOf, exact: bool = True) -> DataFrame:
    now = ts_literal(as_of)
    rows = within(df, "event_datetime", as_of, hours=1)
    stats = rows.agg(
        F.count("*").alias("sessions"),
        distinct_count("user_name", exact).alias("users"),
        distinct_count("computer_name", exact).alias("computers"),
        F.avg("duration").alias("avg_duration"),
        F.coalesce(F.sum("is_deadlock"), F.lit(0)).alias("deadlocks"),
        F.coalesce(F.sum("is_exception"), F.lit(0)).alias("exceptions"),
        F.coalesce(F.sum("is_timeout"), F.lit(0)).alias("timeouts"),
        *approx_quantile("duration", 0.95, "p95_duration", exact),
    )
    return add_quantile(stats, rows, [], "duration", 0.95, "p95_duration", exact).withColumns(
        {
            "hour_start": hour_start(F.timestamp_add("HOUR", F.lit(-1), now)),
            "is_weekend": is_weekend(F.to_date(now)),
            "is_work_hour": is_work_hour(F.hour(now)),
        }
    )


def last_hour_by_type(df: DataFrame, as_of: AsOf, exact: bool = True) -> DataFrame:
    """Variant for event tables that carry an event type instead of flags."""
    return within(df, "event_datetime", as_of, hours=1).agg(
        F.count("*").alias("sessions"),
        distinct_count("user_name", exact).alias("users"),
        F.coalesce(F.avg("duration"), F.lit(0.0)).alias("avg_duration"),
        *kinds(DEADLOCKS, ("exceptions", "EXCEPTION")),
    )


# ---- hourly and daily rollups ----------------------------------------------


def session_hourly(df: DataFrame, exact: bool = True) -> DataFrame:
    hourly = df.groupBy(*HOUR_KEYS).agg(
        F.count("*").alias("total_sessions"),
        distinct_count("user_name", exact).alias("unique_users"),
        distinct_count("computer_name", exact).alias("unique_computers"),
        F.avg("duration").alias("avg_duration"),
        F.max("duration").alias("max_duration"),
        F.avg("lock_wait_time").alias("avg_lock_wait_time"),
        F.sum("lock_wait_time").alias("total_lock_wait_time"),
        F.sum("is_deadlock").alias("deadlock_count"),
        F.sum("is_exception").alias("exception_count"),
        F.sum("is_timeout").alias("timeout_count"),
        *approx_quantile("duration", 0.95, "p95_duration", exact),
    )
    per_minute = (
        df.groupBy(*HOUR_KEYS, "event_minute")
        .agg(F.count("*").alias("n"))
        .groupBy(*HOUR_KEYS)
        .agg(
            (F.sum("n") / 60).alias("avg_sessions_per_minute"),
            F.max("n").alias("max_sessions_per_minute"),
        )
    )
    joined = hourly.join(per_minute, HOUR_KEYS)
    return calendar_flags(add_quantile(joined, df, HOUR_KEYS, "duration", 0.95, "p95_duration", exact))


def lock_hourly(df: DataFrame, exact: bool = True) -> DataFrame:
    hourly = df.groupBy(*HOUR_KEYS).agg(
        F.count("*").alias("total_lock_events"),
        *kinds(("total_deadlocks", "DEADLOCK"), ("total_timeouts", "TTIMEOUT")),
        F.avg("lock_wait_time").alias("avg_lock_wait_time"),
        F.max("lock_wait_time").alias("max_lock_wait_time"),
        F.min("lock_wait_time").alias("min_lock_wait_time"),
        F.avg("lock_time").alias("avg_lock_time"),
        F.max("lock_time").alias("max_lock_time"),
        distinct_count("session_id", exact).alias("unique_sessions"),
        distinct_count("transaction_id", exact).alias("unique_transactions"),
        distinct_count("user_name", exact).alias("unique_users"),
        *approx_quantile("lock_wait_time", 0.95, "p95_lock_wait_time", exact),
    )
    # Counting per table first answers both "how many tables" and "which one leads".
    named = F.when(F.col("table_name") != "", F.struct("n", "table_name"))
    tables = (
        df.groupBy(*HOUR_KEYS, "table_name")
        .agg(F.count("*").alias("n"))
        .groupBy(*HOUR_KEYS)
        .agg(
            F.count("*").alias("unique_tables"),
            F.coalesce(F.max(named)["table_name"], F.lit("")).alias("top_table"),
        )
    )
    joined = hourly.join(tables, HOUR_KEYS).withColumns(
        {
            "lock_intensity": F.col("total_lock_events") / 60,
            "deadlock_rate": F.col("total_deadlocks").cast("double"),
        }
    )
    quantile = add_quantile(joined, df, HOUR_KEYS, "lock_wait_time", 0.95, "p95_lock_wait_time", exact)
    return calendar_flags(quantile)


def lock_table_daily(df: DataFrame, exact: bool = True) -> DataFrame:
    keys = ["event_date", "table_name"]
    rows = non_empty(df, "table_name")
    daily = rows.groupBy(*keys).agg(
        F.count("*").alias("lock_count"),
        *kinds(("deadlock_count", "DEADLOCK"), ("timeout_count", "TTIMEOUT")),
        F.avg("lock_wait_time").alias("avg_lock_wait_time"),
        F.max("lock_wait_time").alias("max_lock_wait_time"),
        F.avg("lock_time").alias("avg_lock_time"),
        F.max("lock_time").alias("max_lock_time"),
        distinct_count("session_id", exact).alias("unique_sessions"),
        distinct_count("transaction_id", exact).alias("unique_transactions"),
        distinct_count("user_name", exact).alias("unique_users"),
        *approx_quantile("lock_wait_time", 0.95, "p95_lock_wait_time", exact),
    )
    by_day = Window.partitionBy("table_name").orderBy("event_date")
    growth = pct_change(F.lag("lock_count").over(by_day), "lock_count")
    with_p95 = add_quantile(daily, rows, keys, "lock_wait_time", 0.95, "p95_lock_wait_time", exact)
    return with_p95.withColumn("growth_rate", F.coalesce(growth, F.lit(0.0)))


def lock_user_daily(df: DataFrame, exact: bool = True) -> DataFrame:
    return (
        non_empty(df, "user_name")
        .groupBy("event_date", "user_name")
        .agg(
            F.count("*").alias("lock_count"),
            *kinds(("deadlock_count", "DEADLOCK"), ("timeout_count", "TTIMEOUT")),
            F.avg("lock_wait_time").alias("avg_lock_wait_time"),
            F.max("lock_wait_time").alias("max_lock_wait_time"),
            distinct_count("table_name", exact).alias("unique_tables"),
            distinct_count("session_id", exact).alias("unique_sessions"),
        )
    )


def techlog_hourly(df: DataFrame, exact: bool = True) -> DataFrame:
    keys = ["event_date", "hour"]
    hourly = df.groupBy(*keys).agg(
        F.count("*").alias("total_queries"),
        F.avg("duration").alias("avg_duration"),
        F.max("duration").alias("max_duration"),
        F.sum("wait_time").alias("total_wait_time"),
        F.avg("wait_time").alias("avg_wait_time"),
        F.sum("lock_time").alias("total_lock_time"),
        F.avg("lock_time").alias("avg_lock_time"),
        F.count_if(F.col("lock_time") > 0).alias("lock_count"),
        distinct_count("session", exact).alias("unique_sessions"),
        distinct_count("user_name", exact).alias("unique_users"),
        distinct_count("computer", exact).alias("unique_computers"),
        F.count_if(F.contains(F.col("raw_line"), F.lit("Exception"))).alias("errors"),
        *approx_quantile("duration", 0.95, "p95_duration", exact),
    )
    return add_quantile(hourly, df, keys, "duration", 0.95, "p95_duration", exact)


def hourly_metrics(df: DataFrame, exact: bool = True) -> DataFrame:
    """Hourly view over session metrics (one row per request, NULL error = success)."""
    rows = df.withColumn("hour", hour_start("event_time"))
    hourly = rows.groupBy("hour").agg(
        distinct_count("session_id", exact).alias("unique_sessions"),
        F.count("*").alias("total_queries"),
        F.avg("duration").alias("avg_duration"),
        F.sum("lock_time").alias("total_lock_time"),
        F.count_if(F.col("lock_time") > 0).alias("lock_count"),
        F.count("error").alias("error_count"),
        *approx_quantile("duration", 0.95, "p95_duration", exact),
    )
    return add_quantile(hourly, rows, ["hour"], "duration", 0.95, "p95_duration", exact)


def hourly_extract(df: DataFrame, as_of: AsOf, days: int = 30, exact: bool = True) -> DataFrame:
    """Training extract over the same rows as :func:`hourly_metrics`."""
    return (
        within(df, "event_time", as_of, days=days)
        .groupBy(hour_start("event_time").alias("timestamp"))
        .agg(
            distinct_count("session_id", exact).alias("session_count"),
            F.avg("duration").alias("avg_duration"),
            F.count_if(F.col("lock_time") > 0).alias("lock_count"),
            F.avg("lock_time").alias("avg_lock_time"),
            F.count("error").alias("error_count"),
        )
    )


# ---- lock trends -------------------------------------------------------------


def lock_daily(df: DataFrame, as_of: AsOf, days: int = 30, exact: bool = True) -> DataFrame:
    rows = within(df, "event_date", as_of, days=days)
    daily = rows.groupBy("event_date").agg(
        F.count("*").alias("total_locks"),
        *kinds(DEADLOCKS, TIMEOUTS),
        F.avg("lock_wait_time").alias("avg_wait"),
        F.max("lock_wait_time").alias("max_wait"),
        *approx_quantile("lock_wait_time", 0.95, "p95_wait", exact),
    )
    return add_quantile(daily, rows, ["event_date"], "lock_wait_time", 0.95, "p95_wait", exact)


def lock_hour_trend(df: DataFrame, as_of: AsOf, days: int = 7, exact: bool = True) -> DataFrame:
    return (
        within(df, "event_datetime", as_of, days=days)
        .groupBy(hour_start("event_datetime").alias("hour"))
        .agg(
            F.count("*").alias("locks"),
            *kinds(DEADLOCKS, TIMEOUTS),
            F.avg("lock_wait_time").alias("avg_wait"),
            F.max("lock_wait_time").alias("max_wait"),
            distinct_count("session_id", exact).alias("sessions"),
            distinct_count("table_name", exact).alias("tables"),
        )
    )


def top_tables(
    df: DataFrame,
    as_of: AsOf,
    n: int = 50,
    *,
    days: int | None = None,
    hours: int | None = None,
    today: bool = False,
    exact: bool = True,
) -> DataFrame:
    """Tables with most locks in a window of days, of hours, or in the current day."""
    if hours:
        rows = within(df, "event_datetime", as_of, hours=hours)
    else:
        rows = within(df, "event_date", as_of, days=days, today=today)
    return (
        non_empty(rows, "table_name")
        .groupBy("table_name")
        .agg(
            F.count("*").alias("lock_count"),
            *kinds(DEADLOCKS, TIMEOUTS),
            F.avg("lock_wait_time").alias("avg_wait"),
            F.max("lock_wait_time").alias("max_wait"),
            distinct_count("session_id", exact).alias("sessions"),
        )
        .orderBy(F.desc("lock_count"), "table_name")
        .limit(n)
    )


def top_lock_users(df: DataFrame, as_of: AsOf, days: int = 7, n: int = 20, exact: bool = True) -> DataFrame:
    return (
        within(df, "event_date", as_of, days=days)
        .groupBy("user_name")
        .agg(
            F.count("*").alias("locks"),
            *kinds(DEADLOCKS),
            distinct_count("table_name", exact).alias("tables"),
        )
        .orderBy(F.desc("locks"), "user_name")
        .limit(n)
    )


def lock_hour_profile(df: DataFrame, as_of: AsOf, days: int = 7, exact: bool = True) -> DataFrame:
    return (
        within(df, "event_date", as_of, days=days)
        .groupBy(F.hour("event_datetime").alias("hour_of_day"))
        .agg(
            F.avg("lock_wait_time").alias("avg_wait"),
            F.count("*").alias("locks"),
            distinct_count("session_id", exact).alias("sessions"),
        )
    )


# ---- technical-log analysis ---------------------------------------------------


def slow_contexts(df: DataFrame, as_of: AsOf, n: int = 20) -> DataFrame:
    """Slowest contexts since the start of the previous hour."""
    return (
        within(df, "event_datetime", as_of, from_hour=1)
        .groupBy("context")
        .agg(
            F.count("*").alias("cnt"),
            F.avg("duration").alias("avg_duration"),
            F.max("duration").alias("max_duration"),
            F.sum("duration").alias("total_duration"),
        )
        .orderBy(F.desc("avg_duration"), "context")
        .limit(n)
    )


def lock_time_daily(df: DataFrame, as_of: AsOf, days: int = 30, long_lock: int = 1_000_000) -> DataFrame:
    return (
        within(df, "event_date", as_of, days=days)
        .groupBy("event_date")
        .agg(
            F.count("*").alias("total_ops"),
            F.sum("lock_time").alias("total_lock_time"),
            F.avg("lock_time").alias("avg_lock_time"),
            F.count_if(F.col("lock_time") > long_lock).alias("long_locks"),
        )
    )


def user_load(df: DataFrame, as_of: AsOf, days: int = 7, n: int = 20, exact: bool = True) -> DataFrame:
    return (
        non_empty(within(df, "event_date", as_of, days=days), "user_name")
        .groupBy("user_name")
        .agg(
            F.count("*").alias("queries"),
            F.avg("duration").alias("avg_duration"),
            F.sum("duration").alias("total_duration"),
            distinct_count("session", exact).alias("sessions"),
        )
        .orderBy(F.desc("total_duration"), "user_name")
        .limit(n)
    )


def deadlock_hours(df: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    return (
        within(df, "event_date", as_of, days=days)
        .filter(F.col("lock_time") > 0)
        .groupBy(hour_start("event_datetime").alias("hour"))
        .agg(
            F.count_if(contains_ci("raw_line", "deadlock")).alias("deadlocks"),
            F.avg("lock_time").alias("avg_lock_time"),
            F.max("lock_time").alias("max_lock_time"),
        )
        .filter(F.col("deadlocks") > 0)
    )


def hour_profile(df: DataFrame, as_of: AsOf, days: int = 7, exact: bool = True) -> DataFrame:
    return (
        within(df, "event_date", as_of, days=days)
        .groupBy(F.hour("event_datetime").alias("hour_of_day"))
        .agg(
            distinct_count("session", exact).alias("sessions"),
            F.avg("wait_time").alias("avg_wait_time"),
            F.avg("duration").alias("avg_duration"),
        )
    )


def daily_growth(df: DataFrame, as_of: AsOf, days: int = 60) -> DataFrame:
    return (
        within(df, "event_date", as_of, days=days)
        .groupBy("event_date")
        .agg(
            F.count("*").alias("operations"),
            F.sum("duration").alias("total_duration"),
            F.max("duration").alias("peak_duration"),
            F.avg("lock_time").alias("avg_lock_time"),
        )
    )


def top_errors(df: DataFrame, as_of: AsOf, days: int = 7, n: int = 20, exact: bool = True) -> DataFrame:
    return (
        within(df, "event_date", as_of, days=days)
        .filter(F.contains(F.col("raw_line"), F.lit("Exception")))
        .groupBy(error_text("raw_line").alias("error_text"))
        .agg(
            F.count("*").alias("cnt"),
            distinct_count("session", exact).alias("affected_sessions"),
        )
        .orderBy(F.desc("cnt"), "error_text")
        .limit(n)
    )


def hour_features(df: DataFrame) -> DataFrame:
    """Sums and means per (timestamp, hour, weekday) of an hourly extract."""
    return (
        df.groupBy(
            "timestamp",
            F.hour("timestamp").alias("hour"),
            F.weekday("timestamp").alias("day_of_week"),
        )
        .agg(
            F.sum("session_count").alias("session_count"),
            F.avg("avg_duration").alias("avg_duration"),
            F.sum("lock_count").alias("lock_count"),
            F.avg("avg_lock_time").alias("avg_lock_time"),
            F.sum("error_count").alias("error_count"),
        )
    )


# ---- mergeable partials -------------------------------------------------------

PARTIAL_KEYS = HOUR_KEYS


def partial_rollup(df: DataFrame) -> DataFrame:
    """Per-load partial aggregates whose merge is exact for counts, sums and
    extremes and sketch-based for distinct users and the duration quantile."""
    return df.groupBy(*PARTIAL_KEYS).agg(
        F.count("*").alias("n"),
        F.sum("duration").alias("sum_duration"),
        F.min("duration").alias("min_duration"),
        F.max("duration").alias("max_duration"),
        F.sum("is_deadlock").alias("deadlocks"),
        F.sum("is_exception").alias("exceptions"),
        F.sum("is_timeout").alias("timeouts"),
        F.hll_sketch_agg("user_name").alias("users_sketch"),
        F.kll_sketch_agg_bigint("duration").alias("duration_sketch"),
    )


def merge_partials(partials: DataFrame) -> DataFrame:
    """Combine partials of any number of loads and finalise the statistics."""
    sums = ["n", "sum_duration", "deadlocks", "exceptions", "timeouts"]
    merged = partials.groupBy(*PARTIAL_KEYS).agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("min_duration").alias("min_duration"),
        F.max("max_duration").alias("max_duration"),
        F.hll_union_agg("users_sketch").alias("users_sketch"),
        F.kll_merge_agg_bigint("duration_sketch").alias("duration_sketch"),
    )
    return merged.select(
        *PARTIAL_KEYS,
        F.col("n").alias("total_sessions"),
        (F.col("sum_duration") / F.col("n")).alias("avg_duration"),
        "min_duration",
        "max_duration",
        "deadlocks",
        "exceptions",
        "timeouts",
        F.hll_sketch_estimate("users_sketch").alias("approx_users"),
        F.kll_sketch_get_quantile_bigint("duration_sketch", F.lit(0.95)).alias("approx_p95_duration"),
    )
