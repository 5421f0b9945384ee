"""Session-activity anomalies: thresholds, current features, verdict."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import AsOf, as_datetime, date_literal, hour_start, ts_literal
from ..operators.features import cyclic_hour, error_rate, scale_features
from ..operators.joins import hourly_baseline
from ..operators.rollups import last_hour_sessions

SIGMA_METRICS = ["sessions", "users", "computers", "avg_duration"]


def sigma_thresholds(training: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """Mean, sample deviation and three-sigma bounds, one row per metric."""
    names = metrics or SIGMA_METRICS
    long_form = training.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        [], names, "metric", "value"
    )
    stats = long_form.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return stats.withColumns(
        {"upper_3sigma": F.col("mean") + 3 * F.col("std"), "lower_3sigma": F.col("mean") - 3 * F.col("std")}
    )


def sigma_check(current: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Warnings of current rows (sessions, avg_duration, deadlocks, exceptions).

    Sessions are checked on both sides and duration upwards only, in sigmas from
    the mean; deadlocks and more than ten exceptions always warn and have no
    finite sigma (NULL).
    """
    watched = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
            for c in ("sessions", "avg_duration", "deadlocks", "exceptions")
        ]
    )
    rows = current.select("hour_start", F.inline(watched)).join(thresholds, "metric", "left")
    value, mean, std = F.col("value"), F.col("mean"), F.col("std")
    metric = F.col("metric")
    banded = metric.isin("sessions", "avg_duration")
    high = banded & (value > F.col("upper_3sigma"))
    low = (metric == "sessions") & (value < F.col("lower_3sigma"))
    counted = ((metric == "deadlocks") & (value > 0)) | ((metric == "exceptions") & (value > 10))
    return rows.filter(high | low | counted).select(
        "hour_start",
        F.when(metric == "avg_duration", "duration").otherwise(metric).alias("metric"),
        "value",
        F.when(banded, mean).otherwise(0.0).alias("expected"),
        F.when(banded, F.try_divide(F.abs(value - mean), std)).alias("sigma"),
        F.when(low, "low").otherwise("high").alias("direction"),
    )


def current_features(events: DataFrame, hourly: DataFrame, as_of: AsOf, exact: bool = True) -> DataFrame:
    """Model inputs of the hour before ``as_of`` as one row.

    The deviation is taken from the baseline of the same hour and weekend flag (1
    when there is none) and the trend from the mean of the last 24 hourly counts.
    """
    checked = as_datetime(as_of) - timedelta(hours=1)
    # The checked hour and the weekend flag are known, so both look-ups are
    # filtered scalar subqueries and nothing is joined.
    weekend = int(as_datetime(as_of).isoweekday() >= 6)
    same_hour = (F.col("event_hour") == checked.hour) & (F.col("is_weekend") == weekend)
    baseline = hourly_baseline(hourly.filter(same_hour), as_of).select("avg_sessions")
    hour_time = F.timestamp_add("HOUR", F.col("event_hour"), F.col("event_date").cast("timestamp_ntz"))
    earlier = (
        hourly.filter(F.col("event_date") <= date_literal(checked))
        .select(hour_time.alias("_hour"), "total_sessions")
        .filter(F.col("_hour") < hour_start(ts_literal(checked)))
        .orderBy(F.desc("_hour"))
        .limit(23)
        .agg(F.struct(F.sum("total_sessions").alias("s"), F.count("*").alias("n")))
    )
    now = last_hour_sessions(events, as_of, exact).withColumns({"_mean": baseline.scalar(), "_earlier": earlier.scalar()})
    expected = F.coalesce(F.col("_mean"), F.lit(1.0))
    mean_24 = (F.coalesce(F.col("_earlier.s"), F.lit(0)) + F.col("sessions")) / (F.col("_earlier.n") + 1)
    return now.withColumns(
        {
            "sessions_deviation": (F.col("sessions") - expected) / F.greatest(expected, F.lit(1.0)),
            "sessions_trend": F.col("sessions") - mean_24,
            "error_rate": error_rate(),
            **cyclic_hour(F.hour("hour_start")),
            **scale_features(),
        }
    ).drop("_earlier", "_mean")


def model_warnings(scores: DataFrame) -> DataFrame:
    """Warning rows for rows the model marks as outliers (prediction -1)."""
    return scores.filter(F.col("prediction") == -1).select(
        "hour_start",
        F.lit("ml_model").alias("metric"),
        F.col("score").alias("value"),
        F.lit(None).cast("double").alias("expected"),
        F.lit(None).cast("double").alias("sigma"),
        F.lit(None).cast("string").alias("direction"),
    )


def anomaly_verdict(warnings: DataFrame) -> DataFrame:
    """One verdict per checked hour: number of warnings, ticket priority and subject.

    A NULL sigma means "no finite distance": beyond every bound for counted
    metrics, unknown for the model's own warning.
    """
    counted = F.col("metric").isin("deadlocks", "exceptions")
    extreme = F.max(((F.col("metric") == "deadlocks") | counted | F.coalesce(F.col("sigma") > 5, F.lit(False))).cast("int"))
    strong = F.max(F.coalesce(F.col("sigma") > 3, F.lit(False)).cast("int"))
    deadlock = F.max((F.col("metric") == "deadlocks").cast("int"))
    low = F.max((F.coalesce(F.col("direction"), F.lit("")) == "low").cast("int"))
    return warnings.groupBy("hour_start").agg(
        F.count("*").alias("n_warnings"),
        F.when(extreme == 1, "Highest").when(strong == 1, "High").otherwise("Medium").alias("priority"),
        F.when(deadlock == 1, "[critical] deadlocks detected")
        .when(low == 1, "[preventive] abnormal drop of user activity")
        .otherwise("[preventive] anomalies detected")
        .alias("subject"),
    )


def check_history(current: DataFrame, warnings: DataFrame, as_of: AsOf) -> DataFrame:
    """History row of a check: current metrics, verdict flag, model score, warnings as nested rows."""
    nested = warnings.groupBy("hour_start").agg(
        F.sort_array(F.collect_list(F.struct("metric", "value", "sigma"))).alias("warnings"),
        F.max(F.when(F.col("metric") == "ml_model", F.col("value"))).alias("ml_score"),
    )
    return current.join(nested, "hour_start", "left").select(
        F.lit(str(as_of)).cast("timestamp_ntz").alias("check_time"),
        "hour_start",
        "sessions",
        "users",
        "avg_duration",
        "deadlocks",
        "exceptions",
        F.col("warnings").isNotNull().alias("has_anomaly"),
        "ml_score",
        "warnings",
    )
