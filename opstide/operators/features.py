"""Feature columns for the models and reports."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct_change
from ..functions.text import extract_tables
from ..functions.timeparts import AsOf, within

# Model inputs of the session detector, in order.
SESSION_FEATURES = [
    "sessions", "users", "computers", "avg_duration", "p95_duration", "deadlocks", "exceptions", "timeouts",
    "sessions_deviation", "sessions_trend", "error_rate", "hour_sin", "hour_cos", "log_sessions", "log_duration",
]

# Storage name to training name of the hourly session columns.
TRAINING_NAMES = {
    "event_date": "date",
    "event_hour": "hour",
    "total_sessions": "sessions",
    "unique_users": "users",
    "unique_computers": "computers",
    "avg_duration": "avg_duration",
    "p95_duration": "p95_duration",
    "deadlock_count": "deadlocks",
    "exception_count": "exceptions",
    "timeout_count": "timeouts",
    "is_weekend": "is_weekend",
    "is_work_hour": "is_work_hour",
}


def training_rows(session_hourly: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Hourly session rollup of the last ``days`` days under the training column names."""
    recent = within(session_hourly, "event_date", as_of, days=days)
    return recent.select(*[F.col(c).alias(n) for c, n in TRAINING_NAMES.items()])


def at_least_one(c: str | Column) -> Column:
    return F.greatest(F.col(c) if isinstance(c, str) else c, F.lit(1))


def deviation_from(value: str, mean: str) -> Column:
    return (F.col(value) - F.col(mean)) / at_least_one(mean)


def cyclic_hour(hour: str | Column) -> dict[str, Column]:
    angle = F.lit(2 * math.pi) * (F.col(hour) if isinstance(hour, str) else hour) / 24
    return {"hour_sin": F.sin(angle), "hour_cos": F.cos(angle)}


def error_rate(exceptions: str = "exceptions", timeouts: str = "timeouts", sessions: str = "sessions") -> Column:
    return (F.col(exceptions) + F.col(timeouts)) / at_least_one(sessions)


def scale_features(sessions: str = "sessions", duration: str = "avg_duration") -> dict[str, Column]:
    return {"log_sessions": F.log1p(sessions), "log_duration": F.log1p(duration)}


def hour_deviation(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Mean of the same hour of day mapped onto each row, and the relative deviation."""
    same_hour = Window.partitionBy(*keys, "hour")
    return df.withColumn("hour_avg", F.avg("sessions").over(same_hour)).withColumn(
        "sessions_deviation", deviation_from("sessions", "hour_avg")
    )


def rolling_hour_features(df: DataFrame, columns: list[str], keys: tuple[str, ...] = (), order=("date", "hour")) -> DataFrame:
    """7- and 24-row moving means over the hourly rows of each series."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    means = {}
    for c in columns:
        means[f"{c}_ma_7"] = F.avg(c).over(ordered.rowsBetween(-6, 0))
        means[f"{c}_ma_24"] = F.avg(c).over(ordered.rowsBetween(-23, 0))
    return df.withColumns(means)


def session_features(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """All derived columns of the session detector over hourly training rows."""
    rolled = rolling_hour_features(hour_deviation(df, keys), ["sessions"], keys)
    return rolled.withColumns(
        {
            "sessions_trend": F.col("sessions") - F.col("sessions_ma_24"),
            "error_rate": error_rate(),
            **cyclic_hour("hour"),
            **scale_features(),
        }
    )


def legacy_rolling(df: DataFrame) -> DataFrame:
    """Moving means over the older hourly features and the session difference."""
    rolled = rolling_hour_features(df, ["session_count", "avg_duration", "lock_count"], order=("timestamp",))
    return rolled.withColumn("session_count_diff", F.col("session_count") - F.col("session_count_ma_24"))


def slow_queries(df: DataFrame, min_micros: int = 5_000_000) -> DataFrame:
    return df.filter(F.col("duration") > min_micros)


def index_findings(df: DataFrame, stale_days: int = 7) -> DataFrame:
    """Tables of queries that used no index, and how many queries ran on stale statistics.

    One pass: each query unfolds into the findings it supports.
    """

    def finding(kind: str, table: Column) -> Column:
        return F.struct(F.lit(kind).alias("finding"), table.alias("table_name"))

    none = F.array().cast("array<struct<finding:string,table_name:string>>")
    unindexed = F.transform(extract_tables("query_text"), lambda t: finding("missing_index", t))
    missing = F.when(F.col("index_used") == "", unindexed).otherwise(none)
    stale = F.when(F.col("stats_age_days") > stale_days, F.array(finding("old_statistics", F.lit("")))).otherwise(none)
    rows = df.select(F.inline(F.concat(missing, stale)))
    return rows.groupBy("finding", "table_name").agg(F.count("*").alias("queries"))


def flag(condition: Column) -> Column:
    return condition.cast("int")


def operation_features(df: DataFrame) -> DataFrame:
    month, day, weekday = F.month("date"), F.day("date"), F.weekday("date")
    late = day >= 25
    return df.withColumns(
        {
            "month": month,
            "day_of_month": day,
            "day_of_week": weekday,
            "is_weekend": flag(weekday >= 5),
            "is_month_start": flag(day <= 5),
            "is_month_end": flag(late),
            "is_quarter_end": flag((month % 3 == 0) & late),
            "is_year_end": flag((month == 12) & late),
            "log_documents": F.log1p("documents_count"),
            "log_lines": F.log1p("lines_count"),
            "log_db_size": F.log1p("db_size_gb"),
        }
    )


def table_growth_features(df: DataFrame) -> DataFrame:
    """Daily table sizes with calendar columns, lags and the 30-row mean.

    One row per table and day, so each window holds a bounded number of rows.
    """
    table = Window.partitionBy("table_name")
    ordered = table.orderBy("date")
    return df.withColumns(
        {
            "days": F.datediff("date", F.min("date").over(table)),
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "year": F.year("date"),
            "size_lag_30": F.lag("size_gb", 30).over(ordered),
            "size_lag_90": F.lag("size_gb", 90).over(ordered),
            "size_ma_30": F.avg("size_gb").over(ordered.rowsBetween(-29, 0)),
        }
    )


def user_growth_features(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    ordered = Window.partitionBy(*keys).orderBy("month")
    users = F.col("total_users")
    return df.withColumns(
        {
            "month_num": F.row_number().over(ordered) - 1,
            "quarter": F.quarter("month"),
            "year": F.year("month"),
            "users_lag_3": F.lag(users, 3).over(ordered),
            "users_lag_6": F.lag(users, 6).over(ordered),
            "users_lag_12": F.lag(users, 12).over(ordered),
            "users_ma_3": F.avg(users).over(ordered.rowsBetween(-2, 0)),
            "users_ma_6": F.avg(users).over(ordered.rowsBetween(-5, 0)),
            "growth_rate": pct_change(F.lag(users).over(ordered), users),
        }
    )
