"""Aggregations A1-A18, A23, A29."""

from pyspark.sql import functions as F

from ..operators import rollups as R
from .bindings import AS_OF
from .registry import query

NOW = f"TIMESTAMP '{AS_OF}'"
DAY = f"DATE '{AS_OF[:10]}'"

# Shared pieces of checking SQL.
DL = "count(*) FILTER (WHERE event_type = 'DEADLOCK')"
TT = "count(*) FILTER (WHERE event_type = 'TTIMEOUT')"
WEEKEND = "CASE WHEN isodow(event_date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend"
WORK = "CASE WHEN event_hour BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS is_work_hour"


def last_days(n, column="event_date"):
    return f"{column} >= {DAY} - {n} AND {column} <= {DAY}"


def avg(column, name, digits=4):
    return f"round(avg({column}), {digits}) AS {name}"


def p95(column, name):
    return f"round(quantile_cont(CAST({column} AS double), 0.95), 4) AS {name}"


def total(column, name):
    return f"CAST(sum({column}) AS bigint) AS {name}"


LAST_HOUR = f"event_datetime >= {NOW} - INTERVAL 1 HOUR AND event_datetime <= {NOW}"


@query("a1_last_hour_locks", f"""
SELECT count(*) AS total_locks, {DL} AS deadlocks, {TT} AS timeouts,
  coalesce(round(avg(lock_wait_time) / 1000, 4), 0.0) AS avg_wait_ms,
  coalesce(round(max(lock_wait_time) / 1000, 4), 0.0) AS max_wait_ms,
  count(DISTINCT table_name) AS tables_involved, count(DISTINCT session_id) AS sessions_involved
FROM lock_events WHERE {LAST_HOUR}""")
def _(t):
    return R.last_hour_locks(t.lock_events, AS_OF)


@query("a2_last_hour_sessions", f"""
SELECT {NOW} - INTERVAL 1 HOUR AS hour_start, count(*) AS sessions, count(DISTINCT user_name) AS users,
  count(DISTINCT computer_name) AS computers, {avg('duration', 'avg_duration')}, {p95('duration', 'p95_duration')},
  {total('is_deadlock', 'deadlocks')}, {total('is_exception', 'exceptions')}, {total('is_timeout', 'timeouts')},
  CASE WHEN isodow({DAY}) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN hour({NOW}) BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS is_work_hour
FROM session_events WHERE {LAST_HOUR}""")
def _(t):
    return R.last_hour_sessions(t.session_events, AS_OF)


@query("a2_last_hour_by_type", f"""
SELECT count(*) AS sessions, count(DISTINCT user_name) AS users, coalesce(round(avg(duration), 4), 0.0) AS avg_duration,
  {DL} AS deadlocks, count(*) FILTER (WHERE event_type = 'EXCEPTION') AS exceptions
FROM session_events WHERE {LAST_HOUR}""")
def _(t):
    return R.last_hour_by_type(t.session_events, AS_OF)


SESSION_HOURLY = f"""
SELECT b.*, round(m.per_minute, 4) AS avg_sessions_per_minute, m.peak AS max_sessions_per_minute
FROM (SELECT event_date, event_hour, count(*) AS total_sessions, count(DISTINCT user_name) AS unique_users,
        count(DISTINCT computer_name) AS unique_computers, {avg('duration', 'avg_duration')},
        {p95('duration', 'p95_duration')}, max(duration) AS max_duration,
        {avg('lock_wait_time', 'avg_lock_wait_time')}, {total('lock_wait_time', 'total_lock_wait_time')},
        {total('is_deadlock', 'deadlock_count')}, {total('is_exception', 'exception_count')},
        {total('is_timeout', 'timeout_count')}, {WEEKEND}, {WORK}
      FROM session_events GROUP BY event_date, event_hour) b
JOIN (SELECT event_date, event_hour, sum(n) / 60 AS per_minute, max(n) AS peak
      FROM (SELECT event_date, event_hour, event_minute, count(*) AS n FROM session_events GROUP BY 1, 2, 3)
      GROUP BY 1, 2) m USING (event_date, event_hour)"""


@query("a3_session_hourly", SESSION_HOURLY)
def _(t):
    return R.session_hourly(t.session_events)


LOCK_HOURLY = f"""
SELECT b.*, coalesce(x.table_name, '') AS top_table
FROM (SELECT event_date, event_hour, count(*) AS total_lock_events, {DL} AS total_deadlocks, {TT} AS total_timeouts,
        {avg('lock_wait_time', 'avg_lock_wait_time')}, max(lock_wait_time) AS max_lock_wait_time,
        {p95('lock_wait_time', 'p95_lock_wait_time')}, min(lock_wait_time) AS min_lock_wait_time,
        {avg('lock_time', 'avg_lock_time')}, max(lock_time) AS max_lock_time,
        count(DISTINCT table_name) AS unique_tables, count(DISTINCT session_id) AS unique_sessions,
        count(DISTINCT transaction_id) AS unique_transactions, count(DISTINCT user_name) AS unique_users,
        round(count(*) / 60.0, 4) AS lock_intensity, CAST({DL} AS double) AS deadlock_rate, {WEEKEND}, {WORK}
      FROM lock_events GROUP BY event_date, event_hour) b
LEFT JOIN (SELECT event_date, event_hour, table_name,
             row_number() OVER (PARTITION BY event_date, event_hour ORDER BY count(*) DESC, table_name DESC) AS rn
           FROM lock_events WHERE table_name <> '' GROUP BY event_date, event_hour, table_name) x
  ON b.event_date = x.event_date AND b.event_hour = x.event_hour AND x.rn = 1"""


@query("a4_lock_hourly", LOCK_HOURLY)
def _(t):
    return R.lock_hourly(t.lock_events)


LOCK_TABLE_DAILY = f"""
SELECT *, coalesce(round((lock_count - lag(lock_count) OVER w) / CAST(lag(lock_count) OVER w AS double) * 100, 4), 0.0)
  AS growth_rate
FROM (SELECT event_date, table_name, count(*) AS lock_count, {DL} AS deadlock_count, {TT} AS timeout_count,
        {avg('lock_wait_time', 'avg_lock_wait_time')}, max(lock_wait_time) AS max_lock_wait_time,
        {p95('lock_wait_time', 'p95_lock_wait_time')}, {avg('lock_time', 'avg_lock_time')},
        max(lock_time) AS max_lock_time, count(DISTINCT session_id) AS unique_sessions,
        count(DISTINCT transaction_id) AS unique_transactions, count(DISTINCT user_name) AS unique_users
      FROM lock_events WHERE table_name <> '' GROUP BY event_date, table_name)
WINDOW w AS (PARTITION BY table_name ORDER BY event_date)"""


@query("a5_lock_table_daily", LOCK_TABLE_DAILY)
def _(t):
    return R.lock_table_daily(t.lock_events)


LOCK_USER_DAILY = f"""
SELECT event_date, user_name, count(*) AS lock_count, {DL} AS deadlock_count, {TT} AS timeout_count,
  {avg('lock_wait_time', 'avg_lock_wait_time')}, max(lock_wait_time) AS max_lock_wait_time,
  count(DISTINCT table_name) AS unique_tables, count(DISTINCT session_id) AS unique_sessions
FROM lock_events WHERE user_name <> '' GROUP BY event_date, user_name"""


@query("a6_lock_user_daily", LOCK_USER_DAILY)
def _(t):
    return R.lock_user_daily(t.lock_events)


TECHLOG_HOURLY = f"""
SELECT event_date, hour, count(*) AS total_queries, {avg('duration', 'avg_duration')}, max(duration) AS max_duration,
  {p95('duration', 'p95_duration')}, {total('wait_time', 'total_wait_time')}, {avg('wait_time', 'avg_wait_time')},
  {total('lock_time', 'total_lock_time')}, {avg('lock_time', 'avg_lock_time')},
  count(*) FILTER (WHERE lock_time > 0) AS lock_count, count(DISTINCT session) AS unique_sessions,
  count(DISTINCT user_name) AS unique_users, count(DISTINCT computer) AS unique_computers,
  count(*) FILTER (WHERE contains(raw_line, 'Exception')) AS errors
FROM techlog GROUP BY event_date, hour"""


@query("a7_techlog_hourly", TECHLOG_HOURLY)
def _(t):
    return R.techlog_hourly(t.techlog)


@query("a8_hourly_metrics", f"""
SELECT date_trunc('hour', event_time) AS hour, count(DISTINCT session_id) AS unique_sessions,
  count(*) AS total_queries, {avg('duration', 'avg_duration')}, {p95('duration', 'p95_duration')},
  {total('lock_time', 'total_lock_time')}, count(CASE WHEN lock_time > 0 THEN 1 END) AS lock_count,
  count(error) AS error_count
FROM session_metrics GROUP BY 1""")
def _(t):
    return R.hourly_metrics(t.session_metrics)


HOURLY_EXTRACT = f"""
SELECT date_trunc('hour', event_time) AS timestamp, count(DISTINCT session_id) AS session_count,
  avg(duration) AS avg_duration, count(CASE WHEN lock_time > 0 THEN 1 END) AS lock_count,
  avg(lock_time) AS avg_lock_time, count(error) AS error_count
FROM session_metrics WHERE event_time >= {NOW} - INTERVAL 30 DAY AND event_time <= {NOW} GROUP BY 1"""


@query("a8_hourly_extract", f"""
SELECT * REPLACE (round(avg_duration, 4) AS avg_duration, round(avg_lock_time, 4) AS avg_lock_time)
FROM ({HOURLY_EXTRACT})""")
def _(t):
    return R.hourly_extract(t.session_metrics, AS_OF)


@query("a9_lock_daily", f"""
SELECT event_date, count(*) AS total_locks, {DL} AS deadlocks, {TT} AS timeouts, {avg('lock_wait_time', 'avg_wait')},
  max(lock_wait_time) AS max_wait, {p95('lock_wait_time', 'p95_wait')}
FROM lock_events WHERE {last_days(30)} GROUP BY event_date""")
def _(t):
    return R.lock_daily(t.lock_events, AS_OF)


@query("a10_lock_hour_trend", f"""
SELECT date_trunc('hour', event_datetime) AS hour, count(*) AS locks, {DL} AS deadlocks, {TT} AS timeouts,
  {avg('lock_wait_time', 'avg_wait')}, max(lock_wait_time) AS max_wait, count(DISTINCT session_id) AS sessions,
  count(DISTINCT table_name) AS tables
FROM lock_events WHERE event_datetime >= {NOW} - INTERVAL 7 DAY AND event_datetime <= {NOW} GROUP BY 1""")
def _(t):
    return R.lock_hour_trend(t.lock_events, AS_OF)


def top_tables_sql(condition, n):
    return f"""
SELECT table_name, count(*) AS lock_count, {DL} AS deadlocks, {TT} AS timeouts, {avg('lock_wait_time', 'avg_wait')},
  max(lock_wait_time) AS max_wait, count(DISTINCT session_id) AS sessions
FROM lock_events WHERE table_name <> '' AND {condition}
GROUP BY table_name ORDER BY lock_count DESC, table_name LIMIT {n}"""


@query("a11_top_tables_days", top_tables_sql(last_days(1), 50))
def _(t):
    return R.top_tables(t.lock_events, AS_OF, 50, days=1)


@query("a11_top_tables_hour", top_tables_sql(LAST_HOUR, 10))
def _(t):
    return R.top_tables(t.lock_events, AS_OF, 10, hours=1)


YESTERDAY = "2024-01-30 12:00:00"


@query("a11_top_tables_today", top_tables_sql("event_date = DATE '2024-01-30'", 20))
def _(t):
    return R.top_tables(t.lock_events, YESTERDAY, 20, today=True)


@query("a12_slow_contexts", f"""
SELECT context, count(*) AS cnt, {avg('duration', 'avg_duration')}, max(duration) AS max_duration,
  {total('duration', 'total_duration')}
FROM techlog WHERE {LAST_HOUR} GROUP BY context ORDER BY avg(duration) DESC, context LIMIT 20""")
def _(t):
    return R.slow_contexts(t.techlog, AS_OF)


@query("a13_lock_time_daily", f"""
SELECT event_date, count(*) AS total_ops, {total('lock_time', 'total_lock_time')}, {avg('lock_time', 'avg_lock_time')},
  count(*) FILTER (WHERE lock_time > 1000000) AS long_locks
FROM techlog WHERE {last_days(30)} GROUP BY event_date""")
def _(t):
    return R.lock_time_daily(t.techlog, AS_OF)


@query("a14_user_load", f"""
SELECT user_name, count(*) AS queries, {avg('duration', 'avg_duration')}, {total('duration', 'total_duration')},
  count(DISTINCT session) AS sessions
FROM techlog WHERE {last_days(7)} AND user_name <> '' GROUP BY user_name
ORDER BY sum(duration) DESC, user_name LIMIT 20""")
def _(t):
    return R.user_load(t.techlog, AS_OF)


@query("a14_top_lock_users", f"""
SELECT user_name, count(*) AS locks, {DL} AS deadlocks, count(DISTINCT table_name) AS tables
FROM lock_events WHERE {last_days(7)} GROUP BY user_name ORDER BY locks DESC, user_name LIMIT 20""")
def _(t):
    return R.top_lock_users(t.lock_events, AS_OF)


@query("a15_deadlock_hours", f"""
SELECT date_trunc('hour', event_datetime) AS hour,
  count(*) FILTER (WHERE position('deadlock' IN lower(raw_line)) > 0) AS deadlocks,
  {avg('lock_time', 'avg_lock_time')}, max(lock_time) AS max_lock_time
FROM techlog WHERE {last_days(30)} AND lock_time > 0 GROUP BY 1 HAVING deadlocks > 0""")
def _(t):
    return R.deadlock_hours(t.techlog, AS_OF)


@query("a16_hour_profile", f"""
SELECT CAST(hour(event_datetime) AS int) AS hour_of_day, count(DISTINCT session) AS sessions,
  {avg('wait_time', 'avg_wait_time')}, {avg('duration', 'avg_duration')}
FROM techlog WHERE {last_days(7)} GROUP BY 1""")
def _(t):
    return R.hour_profile(t.techlog, AS_OF)


@query("a16_lock_hour_profile", f"""
SELECT CAST(hour(event_datetime) AS int) AS hour_of_day, {avg('lock_wait_time', 'avg_wait')}, count(*) AS locks,
  count(DISTINCT session_id) AS sessions
FROM lock_events WHERE {last_days(7)} GROUP BY 1""")
def _(t):
    return R.lock_hour_profile(t.lock_events, AS_OF)


@query("a17_daily_growth", f"""
SELECT event_date, count(*) AS operations, {total('duration', 'total_duration')}, max(duration) AS peak_duration,
  {avg('lock_time', 'avg_lock_time')}
FROM techlog WHERE {last_days(60)} GROUP BY event_date""")
def _(t):
    return R.daily_growth(t.techlog, AS_OF)


@query("a18_top_errors", f"""
SELECT regexp_extract(raw_line, 'Exception in .*?: ([^\\n]*)', 1) AS error_text, count(*) AS cnt,
  count(DISTINCT session) AS affected_sessions
FROM techlog WHERE position('Exception' IN raw_line) > 0 AND {last_days(7)}
GROUP BY 1 ORDER BY cnt DESC, error_text LIMIT 20""")
def _(t):
    return R.top_errors(t.techlog, AS_OF)


def _two_loads(t):
    """The same rows arriving as two separate loads."""
    first = F.col("session_id") % 2 == 0
    rows = t.session_events
    return R.partial_rollup(rows.filter(first)).unionByName(R.partial_rollup(rows.filter(~first)))


@query("a23_merge_partials", f"""
SELECT event_date, event_hour, count(*) AS total_sessions, {avg('duration', 'avg_duration')},
  min(duration) AS min_duration, max(duration) AS max_duration, {total('is_deadlock', 'deadlocks')},
  {total('is_exception', 'exceptions')}, {total('is_timeout', 'timeouts')}
FROM session_events GROUP BY event_date, event_hour""")
def _(t):
    return R.merge_partials(_two_loads(t)).drop("approx_users", "approx_p95_duration")


@query("a23_merge_sketches")
def _(t):
    merged = R.merge_partials(_two_loads(t))
    return merged.select("event_date", "event_hour", "approx_users", "approx_p95_duration")


@query("a23_sketch_error", """
SELECT event_date, event_hour, true AS users_close, true AS p95_within_range FROM session_events GROUP BY 1, 2""")
def _(t):
    """Sketch estimates of merged partials against the exact figures of every hour."""
    merged = R.merge_partials(_two_loads(t))
    exact = t.session_events.groupBy("event_date", "event_hour").agg(F.count_distinct("user_name").alias("users"))
    joined = merged.join(exact, ["event_date", "event_hour"])
    return joined.select(
        "event_date",
        "event_hour",
        (F.abs(F.col("approx_users") - F.col("users")) <= 1 + 0.05 * F.col("users")).alias("users_close"),
        F.col("approx_p95_duration").between(F.col("min_duration"), F.col("max_duration")).alias("p95_within_range"),
    )


@query("a29_hour_features", f"""
SELECT timestamp, CAST(hour(timestamp) AS int) AS hour, CAST(isodow(timestamp) - 1 AS int) AS day_of_week,
  {total('session_count', 'session_count')}, {avg('avg_duration', 'avg_duration')}, {total('lock_count', 'lock_count')},
  {avg('avg_lock_time', 'avg_lock_time')}, {total('error_count', 'error_count')}
FROM ({HOURLY_EXTRACT}) GROUP BY timestamp, hour(timestamp), isodow(timestamp)""")
def _(t):
    return R.hour_features(R.hourly_extract(t.session_metrics, AS_OF))
