"""Joins J1, J3, J4, J6-J8 and windows W1-W16."""

from pyspark.sql import functions as F

from ..functions.timeparts import hour_start
from ..operators import features as X
from ..operators import joins as J
from ..operators import rollups as R
from ..operators import sliced as S
from ..operators import windows as W
from ..sources import samples, tables
from .bindings import AS_OF
from .q_features import SESSION_FEATURES_SQL, TRAINING, session_frame, stored_session_hourly
from .q_rollups import DL, HOURLY_EXTRACT, NOW, SESSION_HOURLY, TT, last_days
from .registry import query


def pairs_sql(kind, unit, days, tail=""):
    return f"""
SELECT a.table_name AS table1, b.table_name AS table2, count(*) AS conflicts
FROM lock_events a JOIN lock_events b ON date_trunc('{unit}', a.event_datetime) = date_trunc('{unit}', b.event_datetime)
  AND a.session_id <> b.session_id AND a.event_type = '{kind}' AND b.event_type = '{kind}'
WHERE {last_days(days, 'a.event_date')} AND a.table_name < b.table_name
GROUP BY 1, 2 {tail}"""


@query("j1_conflict_pairs", pairs_sql("DEADLOCK", "minute", 30))
def _(t):
    """Event times stored to the minute."""
    minute = F.timestamp_add("MINUTE", F.minute("event_datetime"), hour_start("event_datetime"))
    return J.conflict_pairs(t.lock_events.withColumn("event_datetime", minute), "DEADLOCK", AS_OF, days=30)


TOP_PAIRS = "ORDER BY conflicts DESC, table1, table2 LIMIT 20"


@query("j1_conflict_pairs_lock", pairs_sql("LOCK", "second", 30, TOP_PAIRS))
def _(t):
    return J.conflict_pairs(t.lock_events, "LOCK", AS_OF, days=30, limit=20)


@query("j1_conflict_pairs_crowded", pairs_sql("DEADLOCK", "hour", 7))
def _(t):
    crowded = t.lock_events.withColumn("event_datetime", hour_start("event_datetime"))
    return J.conflict_pairs(crowded, "DEADLOCK", AS_OF)


@query("j3_hour_average", f"""
SELECT date, hour, round(hour_avg, 4) AS hour_avg FROM ({SESSION_FEATURES_SQL})""")
def _(t):
    rows = X.training_rows(R.session_hourly(t.session_events), AS_OF)
    return X.hour_deviation(rows).select("date", "hour", "hour_avg")


@query("j4_hourly_baseline", f"""
WITH h AS ({SESSION_HOURLY.replace("round(avg(duration), 4)", "avg(duration)")}),
b AS (SELECT event_hour, is_weekend, avg(total_sessions) AS s, avg(avg_duration) AS d, avg(deadlock_count) AS dl,
        avg(exception_count) AS ex FROM h WHERE {last_days(30)} GROUP BY 1, 2)
SELECT h.event_date, h.event_hour, h.is_weekend, round(coalesce(s, 0), 4) AS baseline_avg_sessions,
  round(coalesce(d, 0), 4) AS baseline_avg_duration, round(coalesce(dl, 0), 4) AS baseline_avg_deadlocks,
  round(coalesce(ex, 0), 4) AS baseline_avg_exceptions
FROM h LEFT JOIN b ON h.event_hour = b.event_hour AND h.is_weekend = b.is_weekend""")
def _(t):
    hourly = stored_session_hourly(t)
    return J.attach_baseline(hourly.select("event_date", *J.BASELINE_KEYS), J.hourly_baseline(hourly, AS_OF))


@query("j6_vector_match", f"""
WITH a AS (SELECT instance, arg_max(value, ts) AS v FROM metric_samples WHERE ts <= {NOW} GROUP BY 1),
b AS (SELECT instance, arg_max(value, ts) AS v FROM metric_samples WHERE ts <= {NOW} - INTERVAL 1 DAY GROUP BY 1)
SELECT a.instance, a.v - b.v AS value, a.v - b.v > 0 AS alarm FROM a JOIN b USING (instance)""")
def _(t):
    now = samples.instant(t.metric_samples, "active_sessions", AS_OF, ["instance"])
    before = samples.instant(t.metric_samples, "active_sessions", "2024-01-30 00:00:00", ["instance"])
    matched = J.vector_match(now, before, ["instance"])
    return matched.withColumn("alarm", F.col("value") > 0)


@query("j7_attach_thresholds", f"""
WITH h AS (SELECT event_date, event_hour, count(*) AS n, avg(lock_wait_time) AS w FROM lock_events GROUP BY 1, 2),
m AS (SELECT event_date, event_hour, 'n' AS metric, CAST(n AS double) AS value FROM h
      UNION ALL SELECT event_date, event_hour, 'w', w FROM h),
th AS (SELECT metric, avg(value) AS mean, stddev_samp(value) AS std FROM m GROUP BY 1)
SELECT event_date, event_hour, metric, round(value, 4) AS value, round(mean, 4) AS mean, round(std, 4) AS std
FROM m JOIN th USING (metric)""")
def _(t):
    hourly = t.lock_events.groupBy("event_date", "event_hour").agg(
        F.count("*").cast("double").alias("n"), F.avg("lock_wait_time").alias("w")
    )
    metrics = hourly.unpivot(["event_date", "event_hour"], ["n", "w"], "metric", "value")
    stats = metrics.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    return J.attach_thresholds(metrics, stats)


@query("j8_inhibit", """
SELECT * FROM alerts a WHERE NOT (severity = 'warning' AND EXISTS (SELECT 1 FROM alerts c
  WHERE c.severity = 'critical' AND c.alertname = a.alertname AND c.instance = a.instance AND c.ts::date = a.ts::date))""")
def _(t):
    daily = t.alerts.withColumn("day", F.to_date("ts"))
    return J.inhibit(daily, ("alertname", "instance", "day")).drop("day")


# ---- windows ---------------------------------------------------------------------

SEVEN = "ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"


@query("w1_trend_7d", f"""
SELECT event_date, round(avg(lock_wait_time), 4) AS avg_wait,
  round(avg(avg(lock_wait_time)) OVER (ORDER BY event_date {SEVEN}), 4) AS trend_7d
FROM lock_events GROUP BY event_date""")
def _(t):
    return W.trend_7d(t.lock_events)


@query("w2_daily_deviation", f"""
SELECT event_date, queries, sessions, round(avg(queries) OVER w, 4) AS avg_7d,
  round(stddev_samp(queries) OVER w, 4) AS std_7d,
  round((queries - avg(queries) OVER w) / nullif(stddev_samp(queries) OVER w, 0), 4) AS deviation
FROM (SELECT event_date, count(*) AS queries, count(DISTINCT session) AS sessions
      FROM techlog WHERE {last_days(30)} GROUP BY 1)
WINDOW w AS (ORDER BY event_date {SEVEN})""")
def _(t):
    return W.daily_deviation(t.techlog, AS_OF)


@query("w3_rolling_hour_features", f"""
SELECT date, hour, round(sessions_ma_7, 4) AS sessions_ma_7, round(sessions_ma_24, 4) AS sessions_ma_24,
  round(sessions_trend, 4) AS sessions_trend
FROM ({SESSION_FEATURES_SQL})""")
def _(t):
    return session_frame(t).select("date", "hour", "sessions_ma_7", "sessions_ma_24", "sessions_trend")


@query("w3_legacy_rolling", f"""
SELECT timestamp, session_count, round(avg(session_count) OVER a, 4) AS session_count_ma_7,
  round(avg(avg_duration) OVER a, 4) AS avg_duration_ma_7, round(avg(lock_count) OVER a, 4) AS lock_count_ma_7,
  round(avg(session_count) OVER b, 4) AS session_count_ma_24, round(avg(avg_duration) OVER b, 4) AS avg_duration_ma_24,
  round(avg(lock_count) OVER b, 4) AS lock_count_ma_24,
  round(session_count - avg(session_count) OVER b, 4) AS session_count_diff
FROM ({HOURLY_EXTRACT})
WINDOW a AS (ORDER BY timestamp {SEVEN}), b AS (ORDER BY timestamp ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)""")
def _(t):
    features = R.hour_features(R.hourly_extract(t.session_metrics, AS_OF))
    unused = ["hour", "day_of_week", "avg_duration", "lock_count", "avg_lock_time", "error_count"]
    return X.legacy_rolling(features).drop(*unused)


@query("w4_hour_deviation", f"""
SELECT date, hour, round(sessions_deviation, 4) AS sessions_deviation FROM ({SESSION_FEATURES_SQL})""")
def _(t):
    return session_frame(t).select("date", "hour", "sessions_deviation")


@query("w5_table_growth_features", """
SELECT date, table_name, round(size_gb, 9) AS size_gb,
  CAST(date - min(date) OVER (PARTITION BY table_name) AS int) AS days,
  CAST(month(date) AS int) AS month, CAST(quarter(date) AS int) AS quarter, CAST(year(date) AS int) AS year,
  round(lag(size_gb, 30) OVER w, 9) AS size_lag_30, round(lag(size_gb, 90) OVER w, 9) AS size_lag_90,
  round(avg(size_gb) OVER (PARTITION BY table_name ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 9) AS size_ma_30
FROM table_stats WINDOW w AS (PARTITION BY table_name ORDER BY date)""", digits=9)
def _(t):
    return X.table_growth_features(t.table_stats)


@query("w6_user_growth_features", """
SELECT month, total_users, CAST(row_number() OVER w - 1 AS int) AS month_num, CAST(quarter(month) AS int) AS quarter,
  CAST(year(month) AS int) AS year, lag(total_users, 3) OVER w AS users_lag_3, lag(total_users, 6) OVER w AS users_lag_6,
  lag(total_users, 12) OVER w AS users_lag_12,
  round(avg(total_users) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS users_ma_3,
  round(avg(total_users) OVER (ORDER BY month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 4) AS users_ma_6,
  round((total_users - lag(total_users) OVER w) / nullif(lag(total_users) OVER w, 0)::double * 100, 4) AS growth_rate
FROM license_stats WINDOW w AS (ORDER BY month)""")
def _(t):
    return X.user_growth_features(t.license_stats)


@query("w7_event_gaps", """
SELECT product, date, events, CAST(date - lag(date) OVER (PARTITION BY product ORDER BY date) AS int) AS gap
FROM (SELECT product, date, count(*) AS events FROM releases GROUP BY 1, 2)""")
def _(t):
    return W.event_gaps(t.releases, "product").drop("index", "last_version")


WEEK_DAYS = f"""(SELECT CAST(event_datetime AS date) AS d, avg(lock_wait_time) AS w,
  row_number() OVER (ORDER BY CAST(event_datetime AS date)) AS rn, count(*) OVER () AS n FROM lock_events
  WHERE event_datetime >= {NOW} - INTERVAL 7 DAY AND event_datetime <= {NOW} GROUP BY 1)"""


def trend_sql(early, late, enough, digits):
    return f"""
SELECT round(CASE WHEN f > 0 THEN (s - f) / f * 100 ELSE 0 END, {digits}) AS trend_pct,
  round(f / 1000, 4) AS avg_first_ms, round(s / 1000, 4) AS avg_second_ms
FROM (SELECT avg(CASE WHEN {early} THEN w END) AS f, avg(CASE WHEN {late} THEN w END) AS s, count(*) AS days
      FROM {WEEK_DAYS}) WHERE days >= {enough}"""


@query("w8_weekly_trend", trend_sql("rn <= n // 2", "rn > n // 2", 2, 4))
def _(t):
    return W.weekly_trend(t.lock_events, AS_OF)


@query("w9_weekly_trend_ends", trend_sql("rn <= 3", "rn > n - 3", 4, 1))
def _(t):
    return W.weekly_trend(t.lock_events, AS_OF, mode="ends")


LOCK_DAILY = f"""(SELECT event_date, count(*) AS total_locks, {DL} AS deadlocks, {TT} AS timeouts,
  avg(lock_wait_time) AS avg_wait, max(lock_wait_time) AS max_wait FROM lock_events WHERE {last_days(30)} GROUP BY 1)"""


def _pct(name):
    base, now = f"base_avg_{name}", f"current_avg_{name}"
    return f"CASE WHEN {base} = 0 THEN CASE WHEN {now} > 0 THEN 100.0 ELSE 0.0 END ELSE ({now} - {base}) / {base} * 100 END"


LOCK_TRENDS = f"""(SELECT *, {_pct('locks')} AS locks_trend_pct, {_pct('deadlocks')} AS deadlocks_trend_pct,
  {_pct('wait')} AS wait_time_trend_pct
FROM (SELECT count(*) AS days_analyzed,
        avg(total_locks) FILTER (WHERE rn <= 7) AS base_avg_locks, avg(total_locks) FILTER (WHERE rn > n - 7) AS current_avg_locks,
        avg(deadlocks) FILTER (WHERE rn <= 7) AS base_avg_deadlocks, avg(deadlocks) FILTER (WHERE rn > n - 7) AS current_avg_deadlocks,
        avg(avg_wait) FILTER (WHERE rn <= 7) AS base_avg_wait, avg(avg_wait) FILTER (WHERE rn > n - 7) AS current_avg_wait,
        max(deadlocks) AS max_deadlocks_day, first(event_date ORDER BY deadlocks DESC, event_date) AS max_deadlocks_date,
        max(max_wait) AS max_wait_time, first(event_date ORDER BY max_wait DESC, event_date) AS max_wait_date
      FROM (SELECT *, row_number() OVER (ORDER BY event_date) AS rn, count(*) OVER () AS n FROM {LOCK_DAILY}))
WHERE days_analyzed >= 7)"""
TREND_DOUBLES = [f"{b}_avg_{m}" for b in ("base", "current") for m in ("locks", "deadlocks", "wait")] + [
    "locks_trend_pct", "deadlocks_trend_pct", "wait_time_trend_pct"
]


def replace_rounded(columns):
    return f"REPLACE ({', '.join(f'round({c}, 4) AS {c}' for c in columns)})"


@query("w10_lock_trends", f"SELECT * {replace_rounded(TREND_DOUBLES)} FROM {LOCK_TRENDS}")
def _(t):
    return W.lock_trends(R.lock_daily(t.lock_events, AS_OF))


SPLIT = f"""(SELECT date, volume, used_gb, CAST(date - min(date) OVER (PARTITION BY volume) AS int) AS x,
  row_number() OVER (PARTITION BY volume ORDER BY date) <= floor(count(*) OVER (PARTITION BY volume) * 0.8::double) AS is_train
  FROM disk_usage WHERE {last_days(60, 'date')})"""


@query("w11_chrono_split", f"SELECT date, volume, is_train FROM {SPLIT}")
def _(t):
    history = tables.usage_history(t.disk_usage, AS_OF)
    return W.chrono_split(history, ["volume"], "date").select("date", "volume", "is_train")


@query("w12_first_crossing", """
WITH m AS (SELECT table_name, avg(size_gb) AS bound FROM table_stats GROUP BY 1)
SELECT table_name, min(date) AS first_horizon, round(arg_min(size_gb, date), 4) AS value_at_crossing
FROM table_stats JOIN m USING (table_name) WHERE size_gb > bound GROUP BY 1""")
def _(t):
    bounds = t.table_stats.groupBy("table_name").agg(F.avg("size_gb").alias("bound"))
    rows = t.table_stats.join(bounds, "table_name")
    return W.first_crossing(rows, ["table_name"], "date", "size_gb", F.col("bound"))


WIDE = ["_AF", "_AO", "_NF", "_NO", "_RF", "_RO"]


@query("w13_wide_ffill", f"""
SELECT date, {', '.join(f'round(last_value("{c}" IGNORE NULLS) OVER w, 4) AS "{c}"' for c in WIDE)}
FROM (SELECT date, {', '.join(f"""avg(size_gb) FILTER (WHERE table_name = '{c}') AS "{c}" """ for c in WIDE)}
      FROM table_stats GROUP BY date)
WINDOW w AS (ORDER BY date ROWS UNBOUNDED PRECEDING)""")
def _(t):
    names = sorted(r["table_name"] for r in t.table_stats.select("table_name").distinct().collect())
    return W.wide_ffill(t.table_stats, names)


@query("w14_control_chart", f"""
WITH c AS (SELECT instance, ts, value, avg(value) OVER w AS mean, stddev_pop(value) OVER w AS std
  FROM metric_samples WHERE ts <= {NOW}
  WINDOW w AS (PARTITION BY instance ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW))
SELECT instance, ts, value, round(mean, 9) AS mean, round(std, 9) AS std, round(mean + 3 * std, 9) AS upper,
  round(mean - 3 * std, 9) + 0.0::double AS lower, round(abs(value - mean) / nullif(std, 0), 9) AS sigma,
  coalesce(abs(value - mean) / nullif(std, 0) > 3, false) AS alarm
FROM c""", digits=9)
def _(t):
    return S.control_chart(t.metric_samples, AS_OF, ["instance"])


@query("w15_counter_rate", """
WITH d AS (SELECT *, value - lag(value) OVER (PARTITION BY instance ORDER BY ts) AS c FROM metric_samples),
i AS (SELECT *, CASE WHEN c < 0 THEN value ELSE coalesce(c, 0) END AS inc FROM d),
r AS (SELECT *, sum(inc) OVER (PARTITION BY instance ORDER BY ts RANGE BETWEEN INTERVAL 3599999999 MICROSECOND PRECEDING
        AND CURRENT ROW) / 3600 AS rs,
      sum(inc) OVER (PARTITION BY instance ORDER BY ts RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING
        AND CURRENT ROW) / 86400 AS rl FROM i)
SELECT metric, instance, ts, value, round(rs, 4) AS rate_short, round(rl, 4) AS rate_long,
  round(rs / nullif(rl, 0), 4) AS ratio, coalesce(rs / nullif(rl, 0) > 1.5, false) AS alarm FROM r""")
def _(t):
    return S.counter_rate(t.metric_samples, ["instance"])


@query("w16_hold_for", """
WITH g AS (SELECT *, value > 2 AS c, sum(CASE WHEN value > 2 THEN 0 ELSE 1 END) OVER (PARTITION BY instance ORDER BY ts) AS grp
  FROM metric_samples),
r AS (SELECT *, min(CASE WHEN c THEN ts END) OVER (PARTITION BY instance, grp) AS rs FROM g)
SELECT metric, instance, ts, value, c AS condition, CASE WHEN c THEN rs END AS run_start,
  CASE WHEN NOT c THEN 'inactive' WHEN ts - rs >= INTERVAL 3 HOUR THEN 'firing' ELSE 'pending' END AS state
FROM r""")
def _(t):
    return S.hold_for(t.metric_samples, ["instance"], F.col("value") > 2, 3 * 3600)
