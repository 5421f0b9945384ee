"""Growth forecasts: table sizes, licences, event intervals, peaks, seasonal series."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import next_version
from ..functions.timeparts import AsOf, date_literal
from ..operators.features import table_growth_features, user_growth_features
from ..operators.regress import fit_ols, fit_penalised, linear_value
from ..operators.windows import interval_stats

# Model inputs and report horizons of the table forecast.
TABLE_FEATURES = ["days", "month", "quarter", "size_lag_30", "size_lag_90", "size_ma_30"]
REPORT_DAYS = (30, 90, 180)


# ---- table sizes --------------------------------------------------------------


def table_models(stats: DataFrame, min_rows: int = 60) -> DataFrame:
    """One linear model per table with the state needed to forecast on."""
    frame = table_growth_features(stats).fillna(0.0, ["size_lag_30", "size_lag_90"])
    last = frame.groupBy("table_name").agg(
        F.max("date").alias("last_date"),
        F.max_by("days", "date").alias("last_days"),
        F.max_by("size_gb", "date").alias("current_size"),
    )
    models = fit_ols(frame, ["table_name"], TABLE_FEATURES, "size_gb")
    return models.filter(F.col("n") >= min_rows).join(last, "table_name")


def _roll_tables(days_ahead: int):
    def forecast(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            coef = np.array(pdf["coef"].tolist(), dtype=float).reshape(len(pdf), -1)
            size = pdf["current_size"].to_numpy(float)
            start = pd.to_datetime(pdf["last_date"])
            steps = np.empty((len(pdf), days_ahead))
            for i in range(days_ahead):
                day = start + pd.Timedelta(days=i + 1)
                ahead = steps[:, :i]
                lag_30 = ahead[:, -30] if i >= 30 else size
                lag_90 = ahead[:, -90] if i >= 90 else size
                mean_30 = ahead[:, -30:].mean(axis=1) if i >= 30 else size
                columns = [pdf["last_days"] + i + 1, day.dt.month, day.dt.quarter, lag_30, lag_90, mean_30]
                features = np.column_stack([np.ones(len(pdf)), *[np.asarray(c, dtype=float) for c in columns]])
                steps[:, i] = (coef * features).sum(axis=1)
            for i in range(days_ahead):
                yield pd.DataFrame(
                    {
                        "table_name": pdf["table_name"],
                        "day": i + 1,
                        "date": (start + pd.Timedelta(days=i + 1)).dt.date,
                        "forecast_gb": steps[:, i],
                        "current_size": size,
                    }
                )

    return forecast


def table_growth_forecast(stats: DataFrame, days_ahead: int = 180) -> DataFrame:
    """Recursive daily forecast per table; each step feeds on the earlier ones."""
    models = table_models(stats).select("table_name", "coef", "last_date", "last_days", "current_size")
    schema = "table_name string, day int, date date, forecast_gb double, current_size double"
    return models.mapInPandas(_roll_tables(days_ahead), schema)


def table_growth_report(stats: DataFrame, limit_gb: float = 300.0) -> DataFrame:
    """Current size, forecasts at 30/90/180 days, growth per day and the day the limit is passed."""
    value = F.col("forecast_gb")
    at = [F.max(F.when(F.col("day") == d, value)).alias(f"forecast_{d}d") for d in REPORT_DAYS]
    report = table_growth_forecast(stats, max(REPORT_DAYS)).groupBy("table_name").agg(
        F.max("current_size").alias("current_size"),
        *at,
        F.min(F.when(value > limit_gb, F.struct("day", "forecast_gb"))).alias("_crossing"),
    )
    return report.select(
        "table_name",
        "current_size",
        *[f"forecast_{d}d" for d in REPORT_DAYS],
        ((F.col("forecast_30d") - F.col("current_size")) / 30).alias("growth_rate"),
        F.col("_crossing.day").alias("days_to_limit"),
        F.col("_crossing.forecast_gb").alias("size_at_limit"),
    )


def multi_growth(stats: DataFrame) -> DataFrame:
    """All tables fitted at once on day number, month and quarter."""
    frame = table_growth_features(stats)
    return fit_ols(frame, ["table_name"], ["days", "month", "quarter"], "size_gb")


# ---- licences -------------------------------------------------------------------

USER_FEATURES = ["month_num", "users_lag_3", "users_lag_6", "users_ma_3"]


def _quadratic(features: list[str]) -> list[Column]:
    """The features and all their pairwise products."""
    single = [F.col(c).cast("double") for c in features]
    return [*single, *[a * b for i, a in enumerate(single) for b in single[i:]]]


def user_growth_model(monthly: DataFrame) -> DataFrame:
    """Quadratic model of the user count over months with complete features: coefficients and R2."""
    frame = user_growth_features(monthly).dropna()
    return fit_ols(frame, [], _quadratic(USER_FEATURES), "total_users")


def user_growth_fit(monthly: DataFrame) -> DataFrame:
    """Actual and modelled users per month."""
    frame = user_growth_features(monthly).dropna()
    model = frame.withColumn("coef", user_growth_model(monthly).select("coef").scalar())
    return model.select("month", "total_users", linear_value(_quadratic(USER_FEATURES)).alias("fitted_users"))


FORECAST_FEATURES = ["month_num", "users_lag_3", "users_lag_6", "users_before_3"]


def user_growth_forecast(monthly: DataFrame, months: int = 12, keys: tuple[str, ...] = ()) -> DataFrame:
    """Users of the next ``months`` months, each step fed with the earlier ones; at least zero.

    The quadratic model takes the mean of the three months before instead of the
    mean that holds the month itself, which is not known ahead. Only the newest six
    months of each key are rolled on, as one array; keys without six months have no row.
    """
    ordered = Window.partitionBy(*keys).orderBy("month")
    before = F.avg("total_users").over(ordered.rowsBetween(-3, -1))
    frame = user_growth_features(monthly, keys).withColumn("users_before_3", before)
    known = frame.select(*keys, "total_users", *FORECAST_FEATURES).dropna()
    models = fit_ols(known, list(keys), _quadratic(FORECAST_FEATURES), "total_users").select(*keys, "coef")
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("month")))
    state = (
        frame.withColumn("_rank", newest)
        .groupBy(*keys)
        .agg(
            F.sort_array(F.collect_list(F.when(F.col("_rank") <= 6, F.struct("month", "total_users")))).alias("_recent"),
            F.max("month").alias("_last"),
            F.count("*").alias("_n"),
        )
        .filter(F.size("_recent") == 6)
        .withColumn("_users", F.transform("_recent.total_users", lambda u: u.cast("double")))
    )
    rows = state.join(models, list(keys)) if keys else state.withColumn("coef", models.select("coef").scalar())

    def ahead(users: Column, step: Column) -> Column:
        back = lambda i: F.element_at(users, -i)
        single = [(F.col("_n") - 1 + step).cast("double"), back(3), back(6), (back(1) + back(2) + back(3)) / 3]
        features = [*single, *[a * b for i, a in enumerate(single) for b in single[i:]]]
        return F.concat(users, F.array(F.greatest(linear_value(features), F.lit(0.0))))

    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(months)), F.col("_users"), ahead)
    steps = rows.select(*keys, "_last", F.posexplode(F.slice(rolled, 7, months)).alias("_step", "users_forecast"))
    return steps.filter(F.col("users_forecast").isNotNull()).select(
        *keys, F.add_months("_last", F.col("_step") + 1).alias("month"), "users_forecast"
    )


def license_plan(forecast: DataFrame, safety: float = 1.1, price: float = 1800.0, order: str = "month") -> DataFrame:
    """Licences, cost and growth against the first period for a user forecast."""
    first = F.first("users_forecast").over(Window.partitionBy().orderBy(order))
    licences = F.floor(F.col("users_forecast") * F.lit(safety)).cast("bigint")
    return forecast.withColumns(
        {
            "licenses_needed": licences,
            "cost": licences * F.lit(price),
            "growth": (F.try_divide(F.col("users_forecast").cast("double"), first) - 1) * 100,
        }
    )


# ---- intervals between events ------------------------------------------------------


def next_event(df: DataFrame, key: str) -> DataFrame:
    """Expected next event per key: last date plus the mean gap, one deviation either way."""
    stats = interval_stats(df, key)

    def shifted(days: Column) -> Column:
        return F.date_add("last_date", F.floor(days).cast("int"))

    mean, std = F.col("avg_interval"), F.col("std_interval")
    return stats.filter(mean.isNotNull()).select(
        key,
        "last_version",
        next_version("last_version").alias("next_version"),
        shifted(mean).alias("next_date"),
        shifted(mean - std).alias("confidence_low"),
        shifted(mean + std).alias("confidence_high"),
        "trend",
    )


def upgrade_windows(predicted: DataFrame, as_of: AsOf, key: str, days: int = 60, lead: int = 30) -> DataFrame:
    """Keys whose next event is close, with the date preparation has to be done by."""
    left = F.datediff("next_date", date_literal(as_of))
    return predicted.withColumn("days_left", left).filter(F.col("days_left") < days).select(
        key, "next_version", "days_left", F.date_sub("next_date", lead).alias("deadline")
    )


# ---- peaks ---------------------------------------------------------------------------


def peaks(forecast: DataFrame, value: str, threshold: float) -> DataFrame:
    """Forecast points above a threshold and by how much."""
    return forecast.filter(F.col(value) > threshold).withColumns(
        {"threshold": F.lit(float(threshold)), "excess": F.col(value) - threshold}
    )


def risk_hours(forecast: DataFrame, cpu: float = 80.0, sessions: float = 400.0) -> DataFrame:
    """Hours in which CPU or session forecasts pass their bounds."""
    return forecast.filter((F.col("cpu_usage") > cpu) | (F.col("active_sessions") > sessions))


# ---- seasonal and autoregressive series ---------------------------------------------

DAY_HOURS, WEEK_HOURS, YEAR_HOURS = 24.0, 168.0, 8766.0


def _waves(t: Column, period: float, order: int, name: str) -> dict[str, Column]:
    out = {}
    for k in range(1, order + 1):
        angle = t * (2 * math.pi * k / period)
        out[f"{name}_sin_{k}"] = F.sin(angle)
        out[f"{name}_cos_{k}"] = F.cos(angle)
    return out


def seasonal_columns(t: Column, seasons: dict[str, int], day: Column, holidays: list[str]) -> dict[str, Column]:
    """Trend, Fourier terms per season (``t`` in hours) and a holiday indicator."""
    periods = {"daily": DAY_HOURS, "weekly": WEEK_HOURS, "yearly": YEAR_HOURS}
    columns = {"trend": t / YEAR_HOURS}
    for name, order in seasons.items():
        columns |= _waves(t, periods[name], order, name)
    if holidays:
        columns["holiday"] = day.isin([date_literal(h) for h in holidays]).cast("double")
    return columns


def _hours(ts: Column) -> Column:
    return F.unix_date(F.to_date(ts)).cast("double") * 24 + F.hour(ts) + F.minute(ts) / 60


def _bends(elapsed: Column, length: Column, changes: int, history: float) -> list[Column]:
    """Time passed since each of ``changes`` points spread evenly over the first ``history`` of a series, 0 before."""
    points = [length * (history * j / (changes + 1)) for j in range(1, changes + 1)]
    return [F.greatest(elapsed - point, F.lit(0.0)) / YEAR_HOURS for point in points]


def _seasonal_models(
    df: DataFrame, key: str, ts: str, value: str, seasons: dict[str, int], holidays: list[str],
    changes: int, history: float, penalty: float,
) -> tuple[DataFrame, DataFrame, list[Column]]:
    """Span and model per series, and the feature columns over ``_ts`` beside a span."""
    timed = df.select(key, F.col(ts).cast("timestamp_ntz").alias("_ts"), F.col(value).cast("double").alias("_v"))
    span = timed.groupBy(key).agg(
        F.max("_ts").alias("_end"), F.min(_hours(F.col("_ts"))).alias("_t0"), F.max(_hours(F.col("_ts"))).alias("_t1")
    )
    elapsed = _hours(F.col("_ts")) - F.col("_t0")
    features = list(seasonal_columns(elapsed, seasons, F.to_date("_ts"), holidays).values())
    bends = _bends(elapsed, F.col("_t1") - F.col("_t0"), changes, history)
    rows = timed.join(span, key).withColumn("_log", F.log1p("_v"))
    models = fit_penalised(rows, [key], features, bends, "_log", penalty) if bends else fit_ols(rows, [key], features, "_log")
    return span, models, [*features, *bends]


def seasonal_forecast(
    df: DataFrame,
    key: str,
    periods: int,
    *,
    ts: str = "ts",
    value: str = "value",
    step_hours: int = 1,
    seasons: dict[str, int] | None = None,
    holidays: list[str] | None = None,
    changes: int = 0,
    history: float = 0.8,
    penalty: float = 1.0,
) -> DataFrame:
    """Multiplicative trend-and-season forecast for every series at once.

    ``log(1 + value)`` is regressed on a trend, Fourier terms and holidays; the
    next ``periods`` steps after each series' last sample are predicted.  With
    ``changes`` the trend may bend at that many points, see :func:`trend_changes`;
    the last slope goes on into the forecast.
    """
    seasons = seasons or {"daily": 3, "weekly": 2}
    span, models, features = _seasonal_models(df, key, ts, value, seasons, holidays or [], changes, history, penalty)
    offsets = F.sequence(F.lit(1), F.lit(periods))
    future = span.withColumn("step", F.explode(offsets)).withColumn(
        "_ts", F.timestamp_add("HOUR", F.col("step") * step_hours, F.col("_end"))
    )
    predicted = F.expm1(linear_value(features))
    return future.join(models, key).select(key, "step", F.col("_ts").alias("ts"), predicted.alias("forecast"))


def trend_changes(
    df: DataFrame,
    key: str,
    *,
    ts: str = "ts",
    value: str = "value",
    seasons: dict[str, int] | None = None,
    holidays: list[str] | None = None,
    changes: int = 25,
    history: float = 0.8,
    penalty: float = 1.0,
) -> DataFrame:
    """Times at which a series' trend bends: (key, ts, slope_before, slope_after), slopes of ``log(1 + value)`` per year.

    The trend may bend at ``changes`` points spread evenly over the first ``history`` of
    each series' span.  Bends are penalised by their absolute size, so those that noise
    explains are exactly zero and have no row; what remains is shrunk, and a bend between
    two points may show at both.  A series without a bend has no row, and its forecast is
    that of the straight trend.  All series are fitted in one job from summed products.
    """
    seasons = seasons or {"daily": 3, "weekly": 2}
    holidays = holidays or []
    span, models, features = _seasonal_models(df, key, ts, value, seasons, holidays, changes, history, penalty)
    straight = len(features) - changes
    bends = F.slice("coef", straight + 2, changes)  # after the constant and the features of the straight trend
    before = F.element_at("coef", 2) + F.aggregate(F.slice(bends, F.lit(1), F.col("_at")), F.lit(0.0), lambda a, x: a + x)
    hours = F.col("_t0") + (F.col("_t1") - F.col("_t0")) * history * (F.col("_at") + 1) / (changes + 1)
    found = models.select(key, "coef", F.posexplode(bends).alias("_at", "_bend")).filter(F.col("_bend") != 0)
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return found.join(span, key).select(
        key,
        F.timestamp_add("SECOND", F.round(hours * 3600).cast("long"), epoch).alias("ts"),
        before.alias("slope_before"),
        (before + F.col("_bend")).alias("slope_after"),
    )


def _roll_ar(lags: int, steps: int):
    def forecast(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            coef = np.array(pdf["coef"].tolist(), dtype=float).reshape(len(pdf), -1)
            recent = np.array(pdf["recent"].tolist(), dtype=float).reshape(len(pdf), -1)
            level = pdf["last_value"].to_numpy(float)
            start = pd.to_datetime(pdf["last_date"])
            for step in range(1, steps + 1):
                change = coef[:, 0] + (coef[:, 1:] * recent[:, ::-1]).sum(axis=1)
                recent = np.column_stack([recent[:, 1:], change])
                level = level + change
                yield pd.DataFrame(
                    {
                        "key": pdf["key"].astype(str),
                        "step": step,
                        "date": (start + pd.Timedelta(days=step)).dt.date,
                        "forecast": level,
                    }
                )

    return forecast


def ar_forecast(daily: DataFrame, key: str, value: str, *, date: str = "date", lags: int = 7, steps: int = 30) -> DataFrame:
    """Autoregression on daily differences, rolled ``steps`` days ahead for every series.

    One row per key and day, so windows are bounded by the calendar.
    """
    ordered = Window.partitionBy(key).orderBy(date)
    change = F.col(value).cast("double") - F.lag(value).over(ordered)
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    differenced = daily.withColumn("_d", change)
    frame = differenced.withColumns({n: F.lag("_d", i + 1).over(ordered) for i, n in enumerate(names)})
    models = fit_ols(frame, [key], names, "_d").filter(F.col("n") > lags)
    newest = F.col("_rank") <= lags
    state = (
        differenced.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(date))))
        .filter(newest)
        .groupBy(key)
        .agg(
            F.sort_array(F.collect_list(F.struct(date, "_d"))).alias("_recent"),
            F.max(date).alias("last_date"),
            F.max_by(F.col(value).cast("double"), F.col(date)).alias("last_value"),
        )
        .select(key, "last_date", "last_value", F.col("_recent._d").alias("recent"))
    )
    rows = models.join(state, key).select(F.col(key).cast("string").alias("key"), "coef", "recent", "last_date", "last_value")
    return rows.mapInPandas(_roll_ar(lags, steps), "key string, step int, date date, forecast double")


def arma_fit(
    daily: DataFrame, key: str, value: str, *, date: str = "date", lags: int = 7, averages: int = 7, long: int = 14
) -> tuple[DataFrame, DataFrame]:
    """Autoregression with moving-average terms on daily differences, fitted in two regressions.

    A long autoregression yields the errors; the change of a day is then regressed on
    its own lags and on the lagged errors.  Both come from grouped sums.  Returns the
    models (key, n, coef: constant, lags, errors) and the rows (key, date, ``_v``, ``_d``,
    first-stage error ``_e``).  Days without a value are no rows of a regression.
    """
    ordered = Window.partitionBy(key).orderBy(date)
    level = F.col("_v")
    base = daily.select(F.col(key), F.col(date), F.col(value).cast("double").alias("_v"))
    differenced = base.withColumn("_d", level - F.lag(level).over(ordered))
    past = [f"_d{i}" for i in range(1, max(lags, long) + 1)]
    frame = differenced.withColumns({n: F.lag("_d", i + 1).over(ordered) for i, n in enumerate(past)})
    first = fit_ols(frame, [key], past[:long], "_d").filter(F.col("n") > long + 1).select(key, F.col("coef").alias("_long"))
    gap = F.col("_d") - linear_value(past[:long], "_long")
    # What rounding leaves of a series told exactly is no error to regress on.
    error = F.when(F.abs(gap) > 1e-9 * F.abs("_d"), gap).when(gap.isNotNull(), 0.0)
    errors = frame.join(first, key).withColumn("_e", error).drop("_long")
    shocks = [f"_e{i}" for i in range(1, averages + 1)]
    second = errors.withColumns({n: F.lag("_e", i + 1).over(ordered) for i, n in enumerate(shocks)})
    models = fit_ols(second, [key], [*past[:lags], *shocks], "_d").filter(F.col("n") > lags + averages + 1)
    return models, errors.select(key, date, "_v", "_d", "_e")


def _roll_arma(key: str, date: str, lags: int, averages: int, steps: int):
    def forecast(group: tuple, pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or model.empty:
            return pd.DataFrame({"key": [], "step": [], "date": [], "forecast": []})
        pdf = pdf.sort_values(date)
        coef = np.asarray(model["coef"].iloc[0], dtype=float)
        phi, theta = coef[1 : lags + 1], coef[lags + 1 :]
        changes = pdf["_d"].to_numpy(float)
        errors = np.nan_to_num(pdf["_e"].to_numpy(float))
        # The model's own errors, if its moving average can be inverted; else those of the long autoregression stay.
        roots = np.roots(np.concatenate([[1.0], theta]))
        if not len(roots) or np.abs(roots).max() < 1:
            filled = np.nan_to_num(changes)
            for i in range(max(lags, averages) + 1, len(filled)):
                told = coef[0] + phi @ filled[i - lags : i][::-1] + theta @ errors[i - averages : i][::-1]
                errors[i] = filled[i] - told
        recent = list(np.nan_to_num(changes[-lags:]))
        shocks = list(errors[-averages:])
        level = pdf["_v"].dropna().iloc[-1]
        out = []
        for _ in range(steps):
            change = coef[0] + phi @ np.array(recent[-lags:][::-1]) + theta @ np.array(shocks[-averages:][::-1])
            recent.append(change)
            shocks.append(0.0)
            level += change
            out.append(level)
        start = pd.Timestamp(pdf[date].iloc[-1])
        days = [(start + pd.Timedelta(days=i)).date() for i in range(1, steps + 1)]
        return pd.DataFrame({"key": str(group[0]), "step": range(1, steps + 1), "date": days, "forecast": out})

    return forecast


def arma_forecast(
    daily: DataFrame, key: str, value: str, *, date: str = "date", lags: int = 7, averages: int = 7, long: int = 14, steps: int = 30
) -> DataFrame:
    """Every series rolled ``steps`` days ahead with lags and moving-average terms, see :func:`arma_fit`.

    A series is one row per day, so a task that filters one holds as many rows as its calendar has days.
    """
    models, rows = arma_fit(daily, key, value, date=date, lags=lags, averages=averages, long=long)
    roll = _roll_arma(key, date, lags, averages, steps)
    fitted = models.select(F.col(key).alias("_key"), "coef").groupBy("_key")
    return rows.groupBy(key).cogroup(fitted).applyInPandas(roll, "key string, step int, date date, forecast double")
