"""Disk forecast M1-M7 and its joins and dashboards J2, J5, A26, A30, P22."""

from functools import reduce

from pyspark.sql import functions as F

from ..operators import joins as J
from ..plans import disk as D
from ..sources import tables
from .bindings import AS_OF
from .q_rollups import last_days
from .registry import query

LIMIT = 112.0


def split_sql(day):
    return f"""(SELECT date, volume, used_gb, CAST(date - min(date) OVER (PARTITION BY volume) AS double) AS x,
  row_number() OVER (PARTITION BY volume ORDER BY date) <= floor(count(*) OVER (PARTITION BY volume) * 0.8::double) AS tr
  FROM disk_usage WHERE date >= DATE '{day}' - 60 AND date <= DATE '{day}')"""


Z = 1.959963984540054
T_QUANTILE = f"""CASE WHEN n - 2 >= 5 THEN {Z} + {(Z**3 + Z) / 4!r} / (n - 2)
  + {(5 * Z**5 + 16 * Z**3 + 3 * Z) / 96!r} / pow(n - 2, 2)
  + {(3 * Z**7 + 19 * Z**5 + 17 * Z**3 - 15 * Z) / 384!r} / pow(n - 2, 3)
  + {(79 * Z**9 + 776 * Z**7 + 1482 * Z**5 - 1920 * Z**3 - 945 * Z) / 92160!r} / pow(n - 2, 4)
  WHEN n - 2 = 1 THEN 12.7062 WHEN n - 2 = 2 THEN 4.3027 WHEN n - 2 = 3 THEN 3.1824 WHEN n - 2 = 4 THEN 2.7764 END"""


def model_sql(day=AS_OF[:10]):
    rows = split_sql(day)
    return f"""(
SELECT c.*, round_even(q.mae, 2) AS mae, CASE WHEN n - train >= 2 THEN round_even(1 - sse / nullif(sst, 0), 3) END AS r2, q.residual_std
FROM (SELECT volume, regr_slope(used_gb, x) FILTER (WHERE tr) AS slope, regr_intercept(used_gb, x) FILTER (WHERE tr) AS intercept,
        count(*) AS n, count(*) FILTER (WHERE tr) AS train, max(x) AS last_day, max(date) AS metric_date,
        arg_max(used_gb, date) AS current_used, avg(x) AS x_mean, regr_sxx(used_gb, x) AS sxx FROM {rows} GROUP BY 1) c
JOIN (SELECT r.volume, avg(abs(used_gb - a - b * x)) FILTER (WHERE NOT tr) AS mae,
        sum(pow(used_gb - a - b * x, 2)) FILTER (WHERE NOT tr) AS sse,
        var_pop(used_gb) FILTER (WHERE NOT tr) * count(*) FILTER (WHERE NOT tr) AS sst,
        stddev_pop(used_gb - a - b * x) AS residual_std
      FROM {rows} r JOIN (SELECT volume, regr_slope(used_gb, x) FILTER (WHERE tr) AS b,
                            regr_intercept(used_gb, x) FILTER (WHERE tr) AS a FROM {rows} GROUP BY 1) k ON r.volume = k.volume
      GROUP BY 1) q ON c.volume = q.volume)"""


DAYS_LEFT = f"CASE WHEN slope > 0 THEN greatest(0.0, round_even(({LIMIT} - current_used) / slope, 1)) END"


def forecast_sql(day=AS_OF[:10]):
    margin = f"({T_QUANTILE}) * residual_std * sqrt(1 + 1.0 / n + pow(last_day + 14 - x_mean, 2) / nullif(sxx, 0))"
    steps = ", ".join(f"round_even(intercept + slope * (last_day + {h}), 2) AS forecast_{h}d_gb" for h in D.HORIZONS)
    return f"""(
SELECT metric_date, volume, current_used AS actual_used_gb, {steps}, round_even(slope, 3) AS growth_rate_gb_per_day,
  {DAYS_LEFT} AS days_to_limit,
  round_even(intercept + slope * (last_day + 14) - {margin}, 2) AS confidence_interval_lower,
  round_even(intercept + slope * (last_day + 14) + {margin}, 2) AS confidence_interval_upper, mae, r2
FROM {model_sql(day)})"""


def _model(t):
    return D.fit_trend(tables.usage_history(t.disk_usage, AS_OF))


def _table(t, as_of=AS_OF):
    return D.forecast_table(t.disk_usage, as_of, LIMIT)


@query("m1_fit_trend", f"""
SELECT volume, round(slope, 4) AS slope, round(intercept, 4) AS intercept, n, train AS train_samples
FROM {model_sql()}""")
def _(t):
    return _model(t).select("volume", "slope", "intercept", "n", "train_samples")


@query("m2_trend_quality", f"SELECT volume, mae, r2 FROM {model_sql()}")
def _(t):
    return _model(t).select("volume", "mae", "r2")


@query("m3_forecast", f"""
SELECT volume, CAST(h AS int) AS horizon, round_even(intercept + slope * (last_day + h), 2) AS forecast_gb
FROM {model_sql()}, (SELECT unnest([7, 14, 30]) AS h)""")
def _(t):
    return D.forecast(_model(t))


@query("m4_days_to_limit", f"SELECT volume, {DAYS_LEFT} AS days_to_limit FROM {model_sql()}")
def _(t):
    return _model(t).select("volume", D.days_to_limit(LIMIT).alias("days_to_limit"))


@query("m5_prediction_interval", f"""
SELECT volume, confidence_interval_lower, confidence_interval_upper FROM {forecast_sql()}""")
def _(t):
    return D.prediction_interval(_model(t)).select("volume", "confidence_interval_lower", "confidence_interval_upper")


@query("m6_disk_warnings", f"""
WITH f AS {forecast_sql()},
w AS (
  SELECT volume, metric_date, CASE WHEN days_to_limit <= 7 THEN 'critical' WHEN days_to_limit <= 14 THEN 'warning'
    WHEN days_to_limit <= 30 THEN 'info' END AS level, 'days_to_limit' AS type, days_to_limit AS days, days_to_limit AS value FROM f
  UNION ALL
  SELECT volume, metric_date, CASE WHEN actual_used_gb / {LIMIT} * 100 >= 90 THEN 'critical'
    WHEN actual_used_gb / {LIMIT} * 100 >= 80 THEN 'warning' END, 'usage_percent', NULL, actual_used_gb / {LIMIT} * 100 FROM f
  {' '.join(f"""UNION ALL SELECT volume, metric_date, CASE WHEN forecast_{h}d_gb >= {LIMIT} THEN 'critical'
    WHEN forecast_{h}d_gb >= {LIMIT} * 0.9::double THEN 'warning' END, 'forecast', {h}, forecast_{h}d_gb FROM f""" for h in D.HORIZONS)})
SELECT metric_date, volume, level, type, round(days, 4) AS days, round(value, 4) AS value FROM w WHERE level IS NOT NULL""")
def _(t):
    return D.warning_rows(D.disk_warnings(_table(t), LIMIT))


@query("m6_disk_level", f"""
SELECT volume, CASE WHEN days_to_limit <= 7 OR actual_used_gb / {LIMIT} * 100 >= 90 OR
    greatest(forecast_7d_gb, forecast_14d_gb, forecast_30d_gb) >= {LIMIT} THEN 'critical'
  WHEN days_to_limit <= 14 OR actual_used_gb / {LIMIT} * 100 >= 80 OR
    greatest(forecast_7d_gb, forecast_14d_gb, forecast_30d_gb) >= {LIMIT} * 0.9 THEN 'warning'
  WHEN days_to_limit <= 30 THEN 'info' END AS level
FROM {forecast_sql()}""")
def _(t):
    return D.disk_warnings(_table(t), LIMIT).select("volume", "level")


@query("m6_disk_warnings_legacy", f"""
SELECT volume, CAST((coalesce(forecast_7d_gb > {LIMIT}, false)::int + coalesce(forecast_14d_gb > {LIMIT}, false)::int
  + coalesce(forecast_30d_gb > {LIMIT}, false)::int + (actual_used_gb > {LIMIT} * 0.9)::int) AS int) AS n_warnings
FROM {forecast_sql()}""")
def _(t):
    return D.disk_warnings_legacy(_table(t), LIMIT).select("volume", F.size("warnings").alias("n_warnings"))


@query("m7_fleet_status", f"""
SELECT volume, round(actual_used_gb, 4) AS actual_used_gb, days_to_limit, CASE WHEN days_to_limit <= 7 THEN 'critical'
  WHEN days_to_limit <= 14 THEN 'warning' ELSE 'normal' END AS status FROM {forecast_sql()}""")
def _(t):
    return D.fleet_status(_table(t))


@query("p22_render_message", f"""
WITH f AS {forecast_sql()}
SELECT volume, CASE WHEN actual_used_gb / {LIMIT} * 100 >= 80 THEN 1 ELSE 0 END AS usage_warned,
  printf('Volume %s', CAST(volume AS varchar)) AS prefix
FROM f WHERE days_to_limit <= 30 OR actual_used_gb / {LIMIT} * 100 >= 80 OR
  greatest(forecast_7d_gb, forecast_14d_gb, forecast_30d_gb) >= {LIMIT} * 0.9""")
def _(t):
    rendered = D.warning_messages(D.disk_warnings(_table(t), LIMIT), LIMIT)
    used = F.regexp_extract("message", r": ([0-9.]+) GB used", 1).cast("double")
    return rendered.select(
        "volume",
        F.when(used / LIMIT * 100 >= 79.99, 1).otherwise(0).alias("usage_warned"),
        F.split_part("message", F.lit(":"), F.lit(1)).alias("prefix"),
    )


DATES = ["2024-01-15 00:00:00", "2024-01-22 00:00:00", AS_OF]


def _history(t):
    return reduce(lambda a, b: a.unionByName(b), [_table(t, d) for d in DATES])


HISTORY_SQL = "(" + " UNION ALL ".join(f"SELECT * FROM {forecast_sql(d[:10])}" for d in DATES) + ")"


@query("j2_disk_status", f"""
SELECT u.date, u.volume, round(u.used_gb, 4) AS actual_used, forecast_7d_gb, forecast_14d_gb, forecast_30d_gb,
  growth_rate_gb_per_day, days_to_limit, CASE WHEN days_to_limit <= 7 THEN 'critical' WHEN days_to_limit <= 14 THEN 'warning'
  WHEN days_to_limit <= 30 THEN 'info' ELSE 'normal' END AS status
FROM disk_usage u LEFT JOIN {forecast_sql()} f ON u.date = f.metric_date AND u.volume = f.volume""")
def _(t):
    return J.disk_status(t.disk_usage, _table(t))


GROWTH_SQL = f"""(SELECT volume, (max(used_gb) - min(used_gb)) / nullif(max(date) - min(date), 0)::double AS growth_rate,
  arg_max(used_gb, date) AS last_used_gb FROM disk_usage WHERE {last_days(30, 'date')} GROUP BY 1)"""


@query("j5_days_to_full", f"""
SELECT volume, round((200.0 - last_used_gb) / nullif(growth_rate, 0), 4) AS days_to_full FROM {GROWTH_SQL}""")
def _(t):
    return D.days_to_full(t.disk_usage, AS_OF)


@query("a26_growth_rate_30d", f"""
SELECT volume, round(growth_rate, 4) AS growth_rate, round(last_used_gb, 4) AS last_used_gb FROM {GROWTH_SQL}""")
def _(t):
    return D.growth_rate_30d(t.disk_usage, AS_OF)


@query("a26_latest_quality", f"""
SELECT volume, max(d) AS train_date, arg_max(mae, d) AS mae FROM (
{' UNION ALL '.join(f"SELECT volume, mae, TIMESTAMP '{d}' AS d FROM {model_sql(d[:10])}" for d in DATES)}) GROUP BY 1""")
def _(t):
    runs = [D.model_quality(t.disk_usage, d) for d in DATES]
    return D.latest_quality(reduce(lambda a, b: a.unionByName(b), runs))


@query("a30_forecast_series", f"""
WITH h AS (SELECT * FROM {HISTORY_SQL} WHERE {last_days(30, 'metric_date')})
SELECT volume, metric_date AS time, 'actual' AS series, round(actual_used_gb, 4) AS value FROM h
UNION ALL SELECT volume, metric_date + 7, 'forecast_7d', forecast_7d_gb FROM h WHERE forecast_7d_gb IS NOT NULL
UNION ALL SELECT volume, metric_date + 14, 'forecast_14d', forecast_14d_gb FROM h WHERE forecast_14d_gb IS NOT NULL
UNION ALL SELECT volume, metric_date, 'limit', 200.0 FROM h""")
def _(t):
    return D.forecast_series(_history(t), AS_OF)
