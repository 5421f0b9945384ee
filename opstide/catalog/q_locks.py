"""Lock risk M8-M11 and session detector M12-M14, M17, M18, ST6 batch twin."""

from pyspark.sql import functions as F

from ..operators import features as X
from ..operators import rollups as R
from ..operators import sliced as S
from ..operators import windows as W
from ..plans import locks as L
from ..plans import sessions as Q
from ..plans.iforest import fit_scaler, standardise
from .bindings import AS_OF
from .q_features import SESSION_FEATURES_SQL, TRAINING, session_frame, stored_session_hourly
from .q_rollups import DL, LAST_HOUR, NOW, SESSION_HOURLY, TT, last_days
from .q_windows import LOCK_DAILY, LOCK_TRENDS, TREND_DOUBLES, replace_rounded, trend_sql
from .registry import query

STATS = f"""SELECT count(*) AS total_locks, {DL} AS deadlocks, {TT} AS timeouts,
  coalesce(avg(lock_wait_time) / 1000, 0.0) AS avg_wait_ms, coalesce(max(lock_wait_time) / 1000, 0.0) AS max_wait_ms
  FROM lock_events WHERE {LAST_HOUR}"""
TABLES = f"""SELECT string_agg(table_name || ':' || n, ',' ORDER BY n DESC, table_name DESC) FROM (
  SELECT table_name, count(*) AS n FROM lock_events WHERE {LAST_HOUR} AND table_name <> ''
  GROUP BY 1 ORDER BY n DESC, table_name LIMIT 10)"""
HALVES = trend_sql("rn <= n // 2", "rn > n // 2", 2, 12)
ENDS = trend_sql("rn <= 3", "rn > n - 3", 4, 1)


def risk_sql(critical_wait, trend, extra):
    return f"""
SELECT total_locks, deadlocks, timeouts, round(avg_wait_ms, 4) AS avg_wait_ms, round(max_wait_ms, 4) AS max_wait_ms,
  round(trend_pct, 4) AS trend_pct, tables, risk_score, CASE WHEN risk_score >= 70 THEN 'critical'
  WHEN risk_score >= 40 THEN 'high' WHEN risk_score >= 20 THEN 'warning' ELSE 'normal' END AS risk_level
FROM (SELECT *, CAST((CASE WHEN deadlocks >= 1 THEN 50 ELSE 0 END)
    + (CASE WHEN {critical_wait} > 1000 THEN 30 WHEN avg_wait_ms > 500 THEN 15 ELSE 0 END)
    + (CASE WHEN trend_pct > 100 THEN 40 WHEN trend_pct > 50 THEN 20 ELSE 0 END) {extra} AS int) AS risk_score
  FROM (SELECT s.*, (SELECT trend_pct FROM ({trend})) AS trend_pct, ({TABLES}) AS tables FROM ({STATS}) s))"""


def _flat_risk(risk):
    listed = F.array_join(
        F.transform("tables", lambda x: F.concat(x["table_name"], F.lit(":"), x["lock_count"].cast("string"))), ","
    )
    return risk.withColumn("tables", F.nullif(listed, F.lit(""))).drop(
        "warnings", "tables_involved", "sessions_involved", "message"
    )


@query("m8_lock_risk", risk_sql("max_wait_ms", HALVES, ""))
def _(t):
    return _flat_risk(L.lock_risk(t.lock_events, AS_OF))


@query("m9_lock_risk_doc", risk_sql("avg_wait_ms", ENDS, "+ (CASE WHEN timeouts > 10 THEN 10 ELSE 0 END)"))
def _(t):
    return _flat_risk(L.lock_risk(t.lock_events, AS_OF, variant="doc"))


@query("m8_risk_message", f"""
SELECT printf('%d locks, %d deadlocks, %d timeouts', total_locks, deadlocks, timeouts) AS counts FROM ({STATS})""")
def _(t):
    message = L.risk_message(L.lock_risk(t.lock_events, AS_OF))
    return message.select(F.regexp_extract("message", r"\d+ locks, \d+ deadlocks, \d+ timeouts", 0).alias("counts"))


@query("m10_lock_trend_risk", f"""
SELECT *, CASE WHEN risk_score >= 50 THEN 'critical' WHEN risk_score >= 25 THEN 'high' WHEN risk_score >= 10 THEN 'warning'
  ELSE 'normal' END AS risk_level
FROM (SELECT * {replace_rounded(TREND_DOUBLES)}, CAST(
    (CASE WHEN current_avg_deadlocks > 0 THEN 30 WHEN deadlocks_trend_pct > 50 THEN 20 ELSE 0 END)
    + (CASE WHEN current_avg_wait > 1000000 THEN 25 WHEN wait_time_trend_pct > 100 THEN 20
       WHEN wait_time_trend_pct > 50 THEN 10 ELSE 0 END)
    + (CASE WHEN locks_trend_pct > 100 THEN 15 WHEN locks_trend_pct > 50 THEN 10 ELSE 0 END) AS int) AS risk_score
  FROM {LOCK_TRENDS})""")
def _(t):
    trends = W.lock_trends(R.lock_daily(t.lock_events, AS_OF))
    return L.lock_trend_risk(trends).drop("warnings")


def forecast_sql(x):
    return f"""
WITH d AS (SELECT *, {x} AS x FROM {LOCK_DAILY}),
m AS (SELECT regr_slope(total_locks, x) AS bl, regr_intercept(total_locks, x) AS al, regr_slope(avg_wait, x) AS bw,
        regr_intercept(avg_wait, x) AS aw, max(x) AS last, count(*) AS n FROM d),
f AS (SELECT CAST(h AS int) AS day, al + bl * (last + h) AS fl, aw + bw * (last + h) AS fw, bl, bw
      FROM m, (SELECT unnest(range(1, 8)) AS h) WHERE n >= 14)
SELECT day, round(fl, 4) AS forecast_locks, round(fw, 4) AS forecast_wait,
  round(least(100.0, fw / 1000000 * 10), 4) AS deadlock_probability,
  (SELECT min(day) FROM f WHERE least(100.0, fw / 1000000 * 10) > 70) AS days_to_deadlock,
  round(bl, 4) AS trend_locks, round(bw, 4) AS trend_wait FROM f"""


@query("m11_lock_forecast", forecast_sql("row_number() OVER (ORDER BY event_date) - 1"))
def _(t):
    return L.lock_forecast(R.lock_daily(t.lock_events, AS_OF))


@query("m11_lock_forecast_by_date", forecast_sql("event_date - min(event_date) OVER ()"))
def _(t):
    return L.lock_forecast(R.lock_daily(t.lock_events, AS_OF), by="date")


THRESHOLDS = f"""(SELECT metric, avg(v) AS mean, stddev_samp(v) AS std FROM (
  {' UNION ALL '.join(f"SELECT '{m}' AS metric, CAST({m} AS double) AS v FROM {TRAINING}" for m in Q.SIGMA_METRICS)})
  GROUP BY 1)"""


def _training(t):
    return X.training_rows(stored_session_hourly(t), AS_OF)


@query("m12_sigma_thresholds", f"""
SELECT metric, round(mean, 4) AS mean, round(std, 4) AS std, round(mean + 3 * std, 4) AS upper_3sigma,
  round(mean - 3 * std, 4) AS lower_3sigma FROM {THRESHOLDS}""")
def _(t):
    return Q.sigma_thresholds(_training(t))


# Every training hour checked against the thresholds: the hourly check, replayed.
CHECKS = f"""(
WITH h AS (SELECT date + INTERVAL 1 HOUR * hour AS hour_start, * FROM {TRAINING}), th AS (SELECT * FROM {THRESHOLDS})
SELECT hour_start, 'sessions' AS metric, CAST(sessions AS double) AS value, mean AS expected, abs(sessions - mean) / nullif(std, 0) AS sigma,
  CASE WHEN sessions < mean - 3 * std THEN 'low' ELSE 'high' END AS direction
FROM h, th WHERE metric = 'sessions' AND (sessions > mean + 3 * std OR sessions < mean - 3 * std)
UNION ALL SELECT hour_start, 'duration', avg_duration, mean, abs(avg_duration - mean) / nullif(std, 0), 'high'
FROM h, th WHERE metric = 'avg_duration' AND avg_duration > mean + 3 * std
UNION ALL SELECT hour_start, 'deadlocks', deadlocks, 0, NULL, 'high' FROM h WHERE deadlocks > 0
UNION ALL SELECT hour_start, 'exceptions', exceptions, 0, NULL, 'high' FROM h WHERE exceptions > 10)"""


def _checked(t):
    rows = _training(t)
    hour_start = F.timestamp_add("HOUR", F.col("hour"), F.col("date").cast("timestamp_ntz"))
    current = rows.withColumn("hour_start", hour_start)
    return Q.sigma_check(current, Q.sigma_thresholds(rows))


@query("m13_sigma_check", f"""
SELECT hour_start, metric, round(value, 4) AS value, round(expected, 4) AS expected, round(sigma, 4) AS sigma, direction
FROM {CHECKS}""")
def _(t):
    return _checked(t)


@query("m17_current_features", f"""
WITH h AS (SELECT event_date + INTERVAL 1 HOUR * event_hour AS hs, * FROM ({SESSION_HOURLY})),
c AS (SELECT {NOW} - INTERVAL 1 HOUR AS hour_start, count(*) AS sessions, sum(is_exception) AS ex, sum(is_timeout) AS tt,
        avg(duration) AS d, CASE WHEN isodow(DATE '{AS_OF[:10]}') IN (6, 7) THEN 1 ELSE 0 END AS wk
      FROM session_events WHERE {LAST_HOUR}),
b AS (SELECT avg(total_sessions) AS a FROM h, c WHERE event_hour = hour(hour_start) AND is_weekend = wk AND {last_days(30)}),
e AS (SELECT sum(total_sessions) AS s, count(*) AS n FROM (SELECT total_sessions FROM h, c WHERE hs < hour_start ORDER BY hs DESC LIMIT 23))
SELECT hour_start, sessions, round((sessions - coalesce(a, 1)) / greatest(coalesce(a, 1), 1), 4) AS sessions_deviation,
  round(sessions - (s + sessions) / (n + 1), 4) AS sessions_trend, round((ex + tt) / greatest(sessions, 1), 4) AS error_rate,
  round(sin(2 * pi() * hour(hour_start) / 24), 4) AS hour_sin, round(cos(2 * pi() * hour(hour_start) / 24), 4) AS hour_cos,
  round(ln(1 + sessions), 4) AS log_sessions, round(ln(1 + d), 4) AS log_duration
FROM c, b, e""")
def _(t):
    row = Q.current_features(t.session_events, stored_session_hourly(t), AS_OF)
    derived = "sessions_deviation sessions_trend error_rate hour_sin hour_cos log_sessions log_duration".split()
    return row.select("hour_start", "sessions", *derived)


@query("m18_anomaly_verdict", f"""
SELECT hour_start, count(*) AS n_warnings,
  CASE WHEN bool_or(metric IN ('deadlocks', 'exceptions') OR coalesce(sigma > 5, false)) THEN 'Highest'
    WHEN bool_or(coalesce(sigma > 3, false)) THEN 'High' ELSE 'Medium' END AS priority,
  CASE WHEN bool_or(metric = 'deadlocks') THEN '[critical] deadlocks detected'
    WHEN bool_or(direction = 'low') THEN '[preventive] abnormal drop of user activity'
    ELSE '[preventive] anomalies detected' END AS subject
FROM {CHECKS} GROUP BY 1""")
def _(t):
    return Q.anomaly_verdict(_checked(t))


@query("s12_check_history", f"""
WITH w AS (SELECT hour_start, count(*) AS n FROM {CHECKS} GROUP BY 1)
SELECT date + INTERVAL 1 HOUR * hour AS hour_start, sessions, deadlocks, w.n IS NOT NULL AS has_anomaly,
  CAST(coalesce(w.n, 0) AS int) AS n_warnings
FROM {TRAINING} LEFT JOIN w ON w.hour_start = date + INTERVAL 1 HOUR * hour""")
def _(t):
    rows = _training(t)
    hour_start = F.timestamp_add("HOUR", F.col("hour"), F.col("date").cast("timestamp_ntz"))
    current = rows.withColumn("hour_start", hour_start)
    history = Q.check_history(current, Q.sigma_check(current, Q.sigma_thresholds(rows)), AS_OF)
    return history.select(
        "hour_start", "sessions", "deadlocks", "has_anomaly", F.coalesce(F.size("warnings"), F.lit(0)).alias("n_warnings")
    )


SCALED = ["sessions", "users", "avg_duration", "sessions_deviation"]


@query("m14_standardise", f"""
SELECT date, hour, {', '.join(f'round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 4) + 0.0::double AS {c}' for c in SCALED)}
FROM ({SESSION_FEATURES_SQL})""")
def _(t):
    frame = session_frame(t)
    return standardise(frame, fit_scaler(frame, SCALED)).select("date", "hour", *SCALED)


NOTIFICATIONS = """
WITH RECURSIVE m AS (SELECT DISTINCT alertname, instance, ts FROM alerts),
r AS (SELECT alertname, instance, min(ts) AS ts FROM m GROUP BY 1, 2
  UNION ALL
  SELECT r.alertname, r.instance, (SELECT min(m.ts) FROM m WHERE m.alertname = r.alertname AND m.instance = r.instance
    AND m.ts >= r.ts + INTERVAL 24 HOUR) FROM r WHERE r.ts IS NOT NULL)
SELECT alertname, instance, ts AS notified_at FROM r WHERE ts IS NOT NULL"""


@query("st6_notification_times", NOTIFICATIONS)
def _(t):
    return S.notification_times(t.alerts, ["alertname", "instance"])
