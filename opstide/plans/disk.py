"""Disk-fill forecast for every volume in one job.

History holds one row per volume and day, so a volume's window is bounded by the
history length.  Split, regression and quality all use the same partitioning by
volume: one shuffle for the whole chain.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.alerting import worst_level
from ..functions.numeric import t_quantile_975
from ..functions.timeparts import AsOf, as_datetime, date_literal, within
from ..operators.joins import limit_status
from ..operators.windows import chrono_split
from ..sources.tables import usage_history

HORIZONS = (7, 14, 30)


def fit_trend(history: DataFrame, key: str = "volume", order: str = "date", value: str = "used_gb") -> DataFrame:
    """Straight line through the first 80 % of each series, with hold-out quality.

    One row per series: coefficients, sample counts, mean absolute error and R2 on
    the last 20 %, residual deviation over all rows, and the moments needed for
    prediction intervals.
    """
    series = Window.partitionBy(key)
    train, y, x = F.col("is_train"), F.col(value), F.col("_x")
    train_y = F.when(train, y)
    rows = (
        chrono_split(history, [key], order)
        .withColumn("_x", F.datediff(order, F.min(order).over(series)).cast("double"))
        .withColumns(
            {
                "_slope": F.regr_slope(train_y, x).over(series),
                "_intercept": F.regr_intercept(train_y, x).over(series),
            }
        )
        .withColumn("_r", y - (F.col("_intercept") + F.col("_slope") * x))
    )
    test_r, test_y = F.when(~train, F.col("_r")), F.when(~train, y)
    fitted = rows.groupBy(key).agg(
        F.max("_slope").alias("slope"),
        F.max("_intercept").alias("intercept"),
        F.count("*").alias("n"),
        F.count_if(train).alias("train_samples"),
        F.count_if(~train).alias("test_samples"),
        F.max("_x").alias("last_day"),
        F.max(order).alias("metric_date"),
        F.max_by(y, F.col(order)).alias("current_used"),
        F.avg("_x").alias("x_mean"),
        F.regr_sxx(y, x).alias("sxx"),
        F.stddev_pop("_r").alias("residual_std"),
        F.bround(F.avg(F.abs(test_r)), 2).alias("mae"),
        F.sum(test_r * test_r).alias("_sse"),
        F.regr_syy(test_y, test_y).alias("_sst"),
    )
    r2 = F.when(F.col("test_samples") >= 2, F.bround(1 - F.try_divide("_sse", "_sst"), 3))
    return fitted.withColumn("r2", r2).drop("_sse", "_sst")


def predicted(day: Column) -> Column:
    return F.col("intercept") + F.col("slope") * day


def forecast(model: DataFrame, key: str = "volume", horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """Forecast rows (key, horizon) at the given days after the last one."""
    steps = model.withColumn("horizon", F.explode(F.array(*[F.lit(h) for h in horizons])))
    return steps.select(key, "horizon", F.bround(predicted(F.col("last_day") + F.col("horizon")), 2).alias("forecast_gb"))


def days_to_limit(limit: float | Column) -> Column:
    """Days until the limit at the fitted rate; NULL when usage does not grow. Ties round to the even digit, as all figures here."""
    days = F.try_divide(F.lit(limit) - F.col("current_used"), F.col("slope"))
    return F.when(F.col("slope") > 0, F.greatest(F.lit(0.0), F.bround(days, 1)))


def interval_bounds(horizon: int = 14) -> dict[str, Column]:
    """95 % prediction interval ``horizon`` days after the last day."""
    at = F.col("last_day") + horizon
    off = at - F.col("x_mean")
    scale = F.sqrt(1 + F.lit(1.0) / F.col("n") + F.try_divide(off * off, F.col("sxx")))
    margin = t_quantile_975(F.col("n") - 2) * F.col("residual_std") * scale
    return {
        "confidence_interval_lower": F.bround(predicted(at) - margin, 2),
        "confidence_interval_upper": F.bround(predicted(at) + margin, 2),
    }


def prediction_interval(model: DataFrame, horizon: int = 14) -> DataFrame:
    return model.withColumns(interval_bounds(horizon))


def forecast_table(usage: DataFrame, as_of: AsOf, limit: float = 200.0, days: int = 60) -> DataFrame:
    """One forecast row per volume, as stored in the forecast table."""
    model = fit_trend(usage_history(usage, as_of, days))
    at = {f"forecast_{h}d_gb": F.bround(predicted(F.col("last_day") + h), 2) for h in HORIZONS}
    wide = model.withColumns(
        {
            **at,
            "growth_rate_gb_per_day": F.bround("slope", 3),
            "days_to_limit": days_to_limit(limit),
            **interval_bounds(14),
        }
    )
    return wide.select(
        "metric_date",
        "volume",
        F.col("current_used").alias("actual_used_gb"),
        *at,
        "growth_rate_gb_per_day",
        "days_to_limit",
        "confidence_interval_lower",
        "confidence_interval_upper",
        "mae",
        "r2",
    )


def model_quality(usage: DataFrame, as_of: AsOf, days: int = 60) -> DataFrame:
    """Quality history rows of one training run."""
    model = fit_trend(usage_history(usage, as_of, days))
    return model.select(
        F.lit(str(as_of)).cast("timestamp_ntz").alias("train_date"),
        "volume",
        F.lit("linear_regression").alias("model_type"),
        "mae",
        "r2",
        F.bround("slope", 3).alias("growth_rate"),
        F.col("n").alias("samples_count"),
        F.lit(days).alias("training_days"),
    )


def _warning(level: str, kind: str, days, value) -> Column:
    return F.struct(
        F.lit(level).alias("level"),
        F.lit(kind).alias("type"),
        F.lit(days).cast("double").alias("days"),
        value.cast("double").alias("value"),
    )


def disk_warnings(table: DataFrame, limit: float = 200.0, critical_share: float = 0.9) -> DataFrame:
    """Forecast rows with their warnings (array of level, type, days, value) and the worst level."""
    left, used = F.col("days_to_limit"), F.col("actual_used_gb")
    percent = used / limit * 100
    checks = [
        F.when(left <= 7, _warning("critical", "days_to_limit", left, left))
        .when(left <= 14, _warning("warning", "days_to_limit", left, left))
        .when(left <= 30, _warning("info", "days_to_limit", left, left)),
        F.when(percent >= 90, _warning("critical", "usage_percent", None, percent)).when(
            percent >= 80, _warning("warning", "usage_percent", None, percent)
        ),
    ]
    for h in HORIZONS:
        value = F.col(f"forecast_{h}d_gb")
        checks.append(
            F.when(value >= limit, _warning("critical", "forecast", h, value)).when(
                value >= limit * critical_share, _warning("warning", "forecast", h, value)
            )
        )
    warned = table.withColumn("warnings", F.filter(F.array(*checks), lambda w: w.isNotNull()))
    return warned.withColumn("level", worst_level(F.col("warnings")["level"]))


def disk_warnings_legacy(table: DataFrame, limit: float = 200.0) -> DataFrame:
    """Older rules: any forecast above the limit, or usage above 90 % of it."""
    used = F.col("actual_used_gb")
    checks = [
        F.when(F.col(f"forecast_{h}d_gb") > limit, _warning("critical", "forecast", h, F.col(f"forecast_{h}d_gb")))
        for h in HORIZONS
    ]
    checks.append(F.when(used > limit * 0.9, _warning("critical", "current", None, used)))
    return table.withColumn("warnings", F.filter(F.array(*checks), lambda w: w.isNotNull()))


def warning_rows(warned: DataFrame) -> DataFrame:
    """One row per raised warning."""
    return warned.select("metric_date", "volume", F.inline("warnings"))


def warning_messages(warned: DataFrame, limit: float = 200.0) -> DataFrame:
    """Outbox rows: one rendered message per volume with warnings."""
    message = F.format_string(
        "Volume %s: %.1f GB used, %.1f GB free, growth %.2f GB/day, %d warnings, forecasts 7/14/30 days: %.1f / %.1f / %.1f GB",
        F.col("volume").cast("string"),
        F.col("actual_used_gb"),
        F.lit(limit) - F.col("actual_used_gb"),
        F.col("growth_rate_gb_per_day"),
        F.size("warnings"),
        *[F.col(f"forecast_{h}d_gb") for h in HORIZONS],
    )
    return warned.filter(F.size("warnings") > 0).select("metric_date", "volume", "level", message.alias("message"))


def fleet_status(table: DataFrame) -> DataFrame:
    """All volumes with the status that follows from the days left."""
    return table.select(
        "volume", "actual_used_gb", "days_to_limit", limit_status("days_to_limit", info=False).alias("status")
    )


def growth_rate_30d(usage: DataFrame, as_of: AsOf, days: int = 30) -> DataFrame:
    """Range of the used space over the days between first and last sample, per volume."""
    recent = within(usage, "date", as_of, days=days)
    spread = F.max("used_gb") - F.min("used_gb")
    return recent.groupBy("volume").agg(
        F.try_divide(spread, F.datediff(F.max("date"), F.min("date")).cast("double")).alias("growth_rate"),
        F.max_by("used_gb", "date").alias("last_used_gb"),
    )


def days_to_full(usage: DataFrame, as_of: AsOf, limit: float = 200.0, days: int = 30) -> DataFrame:
    """(limit - last value) / 30-day growth rate, per volume, from one pass over the history up to ``as_of``."""
    start = as_datetime(as_of) - timedelta(days=days)
    recent = F.col("date").between(date_literal(start), date_literal(as_of))
    used, day = F.when(recent, F.col("used_gb")), F.when(recent, F.col("date"))
    growth = F.try_divide(F.max(used) - F.min(used), F.datediff(F.max(day), F.min(day)).cast("double"))
    last = F.max_by("used_gb", "date")
    known = usage.filter(F.col("date") <= date_literal(as_of))
    return known.groupBy("volume").agg(F.try_divide(F.lit(limit) - last, growth).alias("days_to_full"))


def latest_quality(quality: DataFrame) -> DataFrame:
    """Error of the newest model per volume."""
    return quality.groupBy("volume").agg(F.max("train_date").alias("train_date"), F.max_by("mae", "train_date").alias("mae"))


def forecast_series(table: DataFrame, as_of: AsOf, days: int = 30, limit: float = 200.0) -> DataFrame:
    """Chart rows: actual values, forecasts moved to the day they speak about, the limit line."""

    def point(name: str, shift: int, value: Column) -> Column:
        return F.struct(
            F.date_add("metric_date", shift).alias("time"), F.lit(name).alias("series"), value.cast("double").alias("value")
        )

    points = [point("actual", 0, F.col("actual_used_gb")), point("limit", 0, F.lit(limit))]
    points += [point(f"forecast_{h}d", h, F.col(f"forecast_{h}d_gb")) for h in (7, 14)]
    # One pass over the forecasts: each row unfolds into its chart points.
    series = within(table, "metric_date", as_of, days=days).select("volume", F.inline(F.array(*points)))
    return series.filter(~F.startswith("series", F.lit("forecast")) | F.col("value").isNotNull())
