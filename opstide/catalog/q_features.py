"""Projections and predicates P7-P23."""

from pyspark.sql import functions as F

from ..functions import alerting as A
from ..functions import numeric, text, timeparts
from ..operators import features as X
from ..operators import rollups as R
from ..session import materialise
from .bindings import AS_OF
from .q_rollups import DAY, LAST_HOUR, NOW, SESSION_HOURLY, last_days
from .registry import query



@query("p7_within", f"""
SELECT 'last hour' AS span, count(*) AS n, max(lock_wait_time) AS peak FROM lock_events WHERE {LAST_HOUR}
UNION ALL SELECT '7 days', count(*), max(lock_wait_time) FROM lock_events WHERE {last_days(7)}
UNION ALL SELECT '7 exact days', count(*), max(lock_wait_time) FROM lock_events
  WHERE event_datetime >= {NOW} - INTERVAL 7 DAY AND event_datetime <= {NOW}
UNION ALL SELECT 'from previous hour', count(*), max(lock_wait_time) FROM lock_events
  WHERE event_datetime BETWEEN TIMESTAMP '2024-01-30 11:00:00' AND TIMESTAMP '2024-01-30 12:30:00'
UNION ALL SELECT 'today', count(*), max(lock_wait_time) FROM lock_events WHERE event_date = DATE '2024-01-30'""")
def _(t):
    rows, noon = t.lock_events, "2024-01-30 12:30:00"
    spans = {
        "last hour": timeparts.within(rows, "event_datetime", AS_OF, hours=1),
        "7 days": timeparts.within(rows, "event_date", AS_OF, days=7),
        "7 exact days": timeparts.within(rows, "event_datetime", AS_OF, days=7),
        "from previous hour": timeparts.within(rows, "event_datetime", noon, from_hour=1),
        "today": timeparts.within(rows, "event_date", noon, today=True),
    }
    parts = [
        df.agg(F.count("*").alias("n"), F.max("lock_wait_time").alias("peak")).select(F.lit(k).alias("span"), "n", "peak")
        for k, df in spans.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("p8_non_empty", """
SELECT table_name, count(*) AS n FROM lock_events WHERE table_name <> '' AND user_name <> '' GROUP BY 1""")
def _(t):
    return R.non_empty(t.lock_events, "table_name", "user_name").groupBy("table_name").agg(F.count("*").alias("n"))


@query("p9_calendar_flags", """
SELECT event_date, event_hour, CASE WHEN isodow(event_date) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN event_hour BETWEEN 9 AND 18 THEN 1 ELSE 0 END AS is_work_hour, count(*) AS n
FROM session_events GROUP BY ALL""")
def _(t):
    flagged = timeparts.calendar_flags(t.session_events)
    return flagged.groupBy("event_date", "event_hour", "is_weekend", "is_work_hour").agg(F.count("*").alias("n"))


@query("p10_unit_conversion", """
SELECT event_id, coalesce(round(user_id * 1048576 * 97 / 1073741824.0::double, 2), 0.0) AS used_gb,
  coalesce(round(nullif(event_id, 0) * 100 / 1000.0::double, 4), 0.0) AS wait_ms
FROM events""")
def _(t):
    used, wait = F.col("user_id") * 1048576 * 97, F.nullif(F.col("event_id"), F.lit(0)) * 100
    return t.events.select(
        "event_id", numeric.bytes_to_gb(used).alias("used_gb"), numeric.wait_ms(wait).alias("wait_ms")
    )


@query("p11_contains_ci", """
SELECT event_date, count(*) FILTER (WHERE position('deadlock' IN lower(raw_line)) > 0) AS deadlocks,
  count(*) FILTER (WHERE position('Exception' IN raw_line) > 0) AS exceptions
FROM techlog GROUP BY 1""")
def _(t):
    return t.techlog.groupBy("event_date").agg(
        F.count_if(text.contains_ci("raw_line", "deadlock")).alias("deadlocks"),
        F.count_if(F.contains("raw_line", F.lit("Exception"))).alias("exceptions"),
    )


@query("p12_error_text", """
SELECT regexp_extract(raw_line, 'Exception in .*?: ([^\\n]*)', 1) AS error_text, count(*) AS n FROM techlog GROUP BY 1""")
def _(t):
    return t.techlog.groupBy(text.error_text("raw_line").alias("error_text")).agg(F.count("*").alias("n"))


def _has(word):
    return f"contains(lower(error_text), '{word}')"


LABEL = f"""CASE WHEN {_has('прав')} OR {_has('доступ')} THEN 'permission_error'
  WHEN {_has('деление')} AND {_has('ноль')} THEN 'division_by_zero'
  WHEN {_has('блокировк')} OR {_has('deadlock')} THEN 'lock_timeout'
  WHEN {_has('сет')} OR {_has('connection')} THEN 'network_error'
  WHEN {_has('конверт')} OR {_has('convert')} THEN 'conversion_error'
  WHEN {_has('баз')} OR {_has('db')} THEN 'db_error' ELSE 'interface_error' END"""


@query("p13_label_errors", f"SELECT doc_id, {LABEL} AS error_type FROM error_events")
def _(t):
    return text.with_error_type(t.error_events).select("doc_id", "error_type")


@query("p14_normalise_text", """
SELECT doc_id, concat(coalesce(lower(error_text), ''), ' ', coalesce(operation_name, '')) AS text_for_vector
FROM error_events""")
def _(t):
    return t.error_events.select("doc_id", text.normalise_text("error_text", "operation_name").alias("text_for_vector"))


@query("p15_extract_tables", """
SELECT query_id, array_to_string(list_sort(list_distinct(regexp_extract_all(query_text, '_([A-Za-z]+[0-9]*)', 1))), ',')
  AS tables
FROM slow_queries""")
def _(t):
    names = F.array_join(F.array_sort(text.extract_tables("query_text")), ",")
    return t.slow_queries.select("query_id", names.alias("tables"))


@query("p16_slow_queries", "SELECT query_id, duration FROM slow_queries WHERE duration > 5000000")
def _(t):
    return X.slow_queries(t.slow_queries).select("query_id", "duration")


@query("p16_index_findings", """
SELECT 'missing_index' AS finding, table_name, count(*) AS queries
FROM (SELECT unnest(list_distinct(regexp_extract_all(query_text, '_([A-Za-z]+[0-9]*)', 1))) AS table_name
      FROM slow_queries WHERE index_used = '') GROUP BY 2
UNION ALL
SELECT 'old_statistics', '', count(*) FROM slow_queries WHERE stats_age_days > 7 HAVING count(*) > 0""")
def _(t):
    return X.index_findings(t.slow_queries)


@query("p17_operation_features", """
SELECT op_id, CAST(month(date) AS int) AS month, CAST(day(date) AS int) AS day_of_month,
  CAST(isodow(date) - 1 AS int) AS day_of_week, CAST(isodow(date) >= 6 AS int) AS is_weekend,
  CAST(day(date) <= 5 AS int) AS is_month_start, CAST(day(date) >= 25 AS int) AS is_month_end,
  CAST(month(date) % 3 = 0 AND day(date) >= 25 AS int) AS is_quarter_end,
  CAST(month(date) = 12 AND day(date) >= 25 AS int) AS is_year_end,
  round(ln(1 + documents_count), 4) AS log_documents, round(ln(1 + lines_count), 4) AS log_lines,
  round(ln(1 + db_size_gb), 4) AS log_db_size
FROM operation_log""")
def _(t):
    kept = ["date", "documents_count", "lines_count", "db_size_gb", "duration_minutes", "operation_name"]
    return X.operation_features(t.operation_log).drop(*kept)


TRAINING = f"""(SELECT event_date AS date, event_hour AS hour, total_sessions AS sessions, unique_users AS users,
  unique_computers AS computers, avg_duration, p95_duration, deadlock_count AS deadlocks,
  exception_count AS exceptions, timeout_count AS timeouts, is_weekend, is_work_hour
  FROM ({SESSION_HOURLY.replace("round(avg(duration), 4)", "avg(duration)")}) WHERE {last_days(30)})"""

SESSION_FEATURES_SQL = f"""
SELECT *, (sessions - hour_avg) / greatest(hour_avg, 1) AS sessions_deviation,
  sessions - sessions_ma_24 AS sessions_trend, sin(2 * pi() * hour / 24) AS hour_sin, cos(2 * pi() * hour / 24) AS hour_cos,
  (exceptions + timeouts) / greatest(sessions, 1) AS error_rate, ln(1 + sessions) AS log_sessions,
  ln(1 + avg_duration) AS log_duration
FROM (SELECT *, avg(sessions) OVER (PARTITION BY hour) AS hour_avg,
        avg(sessions) OVER (ORDER BY date, hour ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS sessions_ma_7,
        avg(sessions) OVER (ORDER BY date, hour ROWS BETWEEN 23 PRECEDING AND CURRENT ROW) AS sessions_ma_24
      FROM {TRAINING})"""

FEATURE_DOUBLES = (
    "avg_duration p95_duration hour_avg sessions_ma_7 sessions_ma_24 sessions_deviation sessions_trend hour_sin "
    "hour_cos error_rate log_sessions log_duration"
).split()


def stored_session_hourly(t):
    """The hourly session rollup as a written table, for queries that read it more than once."""
    return materialise(R.session_hourly(t.session_events), "session_hourly")


def session_frame(t):
    return X.session_features(X.training_rows(R.session_hourly(t.session_events), AS_OF))


@query("p18_session_features", f"""
SELECT * REPLACE ({', '.join(f'round({c}, 4) + 0.0::double AS {c}' for c in FEATURE_DOUBLES)}) FROM ({SESSION_FEATURES_SQL})""")
def _(t):
    return session_frame(t)


@query("p19_next_version", """
SELECT DISTINCT version, CASE WHEN TRY_CAST(nullif(split_part(version, '.', 3), '') AS bigint) IS NULL THEN '?.?.?'
  ELSE split_part(version, '.', 1) || '.' || split_part(version, '.', 2) || '.' ||
       CAST(CAST(split_part(version, '.', 3) AS bigint) + 1 AS varchar) END AS next_version
FROM (SELECT version FROM releases UNION ALL SELECT left(version, 3) FROM releases)""")
def _(t):
    short = t.releases.select(F.substring("version", 1, 3).alias("version"))
    both = t.releases.select("version").unionByName(short).distinct()
    return both.select("version", text.next_version("version").alias("next_version"))


@query("p20_priority", """
SELECT severity, CASE severity WHEN 'critical' THEN 'Highest' WHEN 'warning' THEN 'High' ELSE 'Medium' END AS priority,
  count(*) AS n
FROM (SELECT severity FROM alerts UNION ALL SELECT 'other' FROM alerts) GROUP BY 1, 2""")
def _(t):
    rows = t.alerts.select("severity").unionByName(t.alerts.select(F.lit("other").alias("severity")))
    return rows.groupBy("severity", A.priority("severity").alias("priority")).agg(F.count("*").alias("n"))


@query("p21_due_date", f"""
SELECT query_id, CAST({DAY} + CAST(CASE WHEN d <= 7 THEN greatest(1, d - 1) WHEN d <= 14 THEN greatest(2, d - 2)
    ELSE greatest(3, d - 3) END AS int) AS date) AS due,
  CAST({DAY} + CAST(CASE level WHEN 'critical' THEN greatest(1, d - 1) WHEN 'warning' THEN greatest(2, d - 2) END AS int)
    AS date) AS disk_due
FROM (SELECT query_id, CAST(query_id % 30 AS int) AS d,
        CASE query_id % 3 WHEN 0 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'info' END AS level FROM slow_queries)""")
def _(t):
    kind = F.col("query_id") % 3
    rows = t.slow_queries.select(
        "query_id",
        (F.col("query_id") % 30 + 0.4).alias("d"),
        F.when(kind == 0, "critical").when(kind == 1, "warning").otherwise("info").alias("level"),
    )
    return rows.select(
        "query_id", A.due_date("d", AS_OF).alias("due"), A.disk_due_date("level", "d", AS_OF).alias("disk_due")
    )


def payload():
    """An alert record as the JSON text a receiver would get."""
    return F.to_json(
        F.struct(
            F.when(F.col("severity") == "info", "resolved").otherwise("firing").alias("status"),
            F.create_map(
                F.lit("alertname"), F.col("alertname"), F.lit("instance"), F.col("instance"),
                F.lit("severity"), F.col("severity"), F.lit("zone"), F.concat(F.lit("z-"), F.col("instance")),
            ).alias("labels"),
            F.create_map(F.lit("value"), F.col("value").cast("int").cast("string")).alias("annotations"),
        )
    )


def _flat(t):
    return A.flatten_alerts(t.alerts.select("ts", payload().alias("payload")))


@query("p23_flatten_alerts", """
SELECT ts, CASE severity WHEN 'info' THEN 'resolved' ELSE 'firing' END AS status, alertname, instance, 'unknown' AS job,
  severity, CAST(CAST(trunc(value) AS int) AS varchar) AS value, alertname AS summary
FROM alerts""")
def _(t):
    return _flat(t).drop("payload", "extra_labels")


@query("p23_extra_labels", """
SELECT alertname, instance, 'zone' AS label, 'z-' || instance AS label_value, count(*) AS n
FROM alerts GROUP BY 1, 2""")
def _(t):
    rows = A.exploded_labels(_flat(t), ["alertname", "instance"])
    return rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
