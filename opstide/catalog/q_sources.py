"""Sources S1-S6, sinks S8-S15 and parsing P1-P6."""

from pyspark.sql import functions as F

from ..operators import joins as J
from ..operators import parsing as P
from ..operators import rollups as R
from ..operators.features import training_rows
from ..session import scratch_path
from ..sinks import tables as K
from ..sources import logs, records, samples, tables
from .bindings import AS_OF
from .q_rollups import DAY, DL, NOW, SESSION_HOURLY, TT, avg, last_days, total
from .registry import query

LINE_TS = "strptime(substr(line, 1, 21), '%Y%m%d %H:%M:%S.%g')"


def rx(pattern, column="line"):
    return f"regexp_extract({column}, '{pattern}', 1)"


def rx_int(pattern, column="line"):
    return f"coalesce(TRY_CAST(nullif({rx(pattern, column)}, '') AS bigint), 0)"


# ---- sources -------------------------------------------------------------------


def _log_folder(t):
    """The log lines as plain and gzip text files in the shared folder."""
    path = scratch_path(t.spark, "logs")
    lines = t.log_lines
    even = F.col("event_id") % 2 == 0
    lines.filter(even).select("line").write.text(f"{path}/plain")
    lines.filter(~even).select("line").write.text(f"{path}/packed", compression="gzip")
    return path


@query("s1_read_log_lines", f"""
SELECT CAST(event_id % 2 AS int) AS packed, CAST({LINE_TS} AS date) AS day, count(*) AS lines,
  CAST(sum(length(line)) AS bigint) AS chars
FROM log_lines GROUP BY 1, 2""")
def _(t):
    lines = logs.read_log_lines(t.spark, _log_folder(t), "*.txt", gzip_partitions=8)
    return lines.groupBy(
        F.endswith("file", F.lit(".gz")).cast("int").alias("packed"),
        F.to_date(P.header_time(F.col("line"))).alias("day"),
    ).agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))


def _wrapped_folder(t, lines, fields):
    """Two of three records wrapped before the named fields, as plain and gzip text files in the shared folder."""
    path = scratch_path(t.spark, "wrapped")
    wrapped = F.regexp_replace("line", f",({'|'.join(fields)})=", ",\n$1=")
    lines = lines.select("event_id", F.when(F.col("event_id") % 3 == 0, F.col("line")).otherwise(wrapped).alias("line"))
    even = F.col("event_id") % 2 == 0
    lines.filter(even).select("line").write.text(f"{path}/plain")
    lines.filter(~even).select("line").write.text(f"{path}/packed", compression="gzip")
    return records.read_log_records(t.spark, path, "*.txt", gzip_partitions=8)


SESSION_WRAPS = ["computerName", "session", "lockWaitTime"]
LOCK_WRAPS = ["session", "userName", "tableName", "lockType", "lockWaitTime", "dbpid"]


@query("s1_wrapped_records", """
SELECT CAST(event_id % 2 AS int) AS packed, count(*) AS records, CAST(sum(length(line)) AS bigint) AS chars,
  count(DISTINCT line) AS different
FROM lock_lines GROUP BY 1""")
def _(t):
    found = _wrapped_folder(t, t.lock_lines, LOCK_WRAPS)
    return found.groupBy(F.endswith("file", F.lit(".gz")).cast("int").alias("packed")).agg(
        F.count("*").alias("records"), F.sum(F.length("line")).alias("chars"), F.countDistinct("line").alias("different")
    )


@query("s2_file_event_hour", """
SELECT DISTINCT strftime(ts, '%y%m%d%H') || '.log' AS file, CAST(ts AS date) AS file_date, CAST(hour(ts) AS int) AS file_hour
FROM events
UNION ALL
SELECT DISTINCT strftime(ts, '%Y%m%d') || '.log.gz', CAST(ts AS date), CAST(NULL AS int) FROM events""")
def _(t):
    hourly = t.events.select(F.concat(F.date_format("ts", "yyMMddHH"), F.lit(".log")).alias("file"))
    daily = t.events.select(F.concat(F.date_format("ts", "yyyyMMdd"), F.lit(".log.gz")).alias("file"))
    return logs.file_event_hour(hourly.distinct().unionByName(daily.distinct()))


@query("s3_scan_events", f"""
SELECT event_date, event_type, count(*) AS n FROM lock_events WHERE {last_days(7)} GROUP BY 1, 2""")
def _(t):
    path = scratch_path(t.spark, "lock_events")
    K.append_lock_events(t.lock_events, path)
    scan = tables.scan_events(t.spark, path, AS_OF, days=7)
    return scan.groupBy("event_date", "event_type").agg(F.count("*").alias("n"))


@query("s4_usage_history", f"""
SELECT date, volume, round(used_gb, 4) AS used_gb FROM disk_usage WHERE {last_days(60, 'date')}""")
def _(t):
    return tables.usage_history(t.disk_usage, AS_OF)


@query("s5_training_set", f"""
SELECT event_date AS date, event_hour AS hour, total_sessions AS sessions, unique_users AS users,
  unique_computers AS computers, avg_duration, p95_duration, deadlock_count AS deadlocks,
  exception_count AS exceptions, timeout_count AS timeouts, is_weekend, is_work_hour
FROM ({SESSION_HOURLY}) WHERE {last_days(30)}""")
def _(t):
    path = scratch_path(t.spark, "training")
    tables.write_training(training_rows(R.session_hourly(t.session_events), AS_OF), path, "csv")
    return tables.read_training(t.spark, path, "csv")


@query("s6_instant", f"""
SELECT instance, max(ts) AS ts, arg_max(value, ts) AS value FROM metric_samples
WHERE metric = 'active_sessions' AND ts <= {NOW} GROUP BY instance""")
def _(t):
    return samples.instant(t.metric_samples, "active_sessions", AS_OF, ["instance"])


# A series whose newest sample is over a day old is not shown, and no older sample is read.
@query("s6_instant_fresh", f"""
SELECT instance, max(ts) AS ts, arg_max(value, ts) AS value FROM metric_samples
WHERE metric = 'active_sessions' AND ts >= {NOW} - INTERVAL 24 HOUR AND ts <= {NOW} GROUP BY instance""")
def _(t):
    return samples.instant(t.metric_samples, "active_sessions", AS_OF, ["instance"], hours=24)


@query("s6_tagged_samples", """
SELECT instance, metric, count(*) AS n, max(value) AS peak FROM metric_samples GROUP BY instance, metric""")
def _(t):
    tags = samples.tagged(t.metric_samples, ["instance"])
    return tags.groupBy(F.col("tags")["instance"].alias("instance"), "metric").agg(
        F.count("*").alias("n"), F.max("value").alias("peak")
    )


# ---- sinks ---------------------------------------------------------------------


@query("s8_append_session_events", f"""
SELECT CAST(year(event_date) * 100 + month(event_date) AS int) AS event_month, event_date, user_name, count(*) AS n,
  {total('duration', 'duration')}, max(length(left(computer_name, 100))) AS width
FROM session_events GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "session_events")
    K.append_session_events(t.session_events, path)
    return t.spark.read.parquet(path).groupBy("event_month", "event_date", "user_name").agg(
        F.count("*").alias("n"),
        F.sum("duration").alias("duration"),
        F.max(F.length("computer_name").cast("bigint")).alias("width"),
    )


@query("s9_append_lock_events", f"""
SELECT CAST(year(event_date) * 100 + month(event_date) AS int) AS event_month, event_date, table_name,
  count(*) AS n, {total('lock_wait_time', 'lock_wait_time')}, '' AS raw_line
FROM lock_events GROUP BY ALL""")
def _(t):
    path = scratch_path(t.spark, "lock_events")
    K.append_lock_events(t.lock_events, path)
    return t.spark.read.parquet(path).groupBy("event_month", "event_date", "table_name").agg(
        F.count("*").alias("n"), F.sum("lock_wait_time").alias("lock_wait_time"), F.max("raw_line").alias("raw_line")
    )


def _usage_rows(t, created, even=None, shift=0):
    rows = t.disk_usage.withColumns(
        {
            "used_gb": F.col("used_gb") + shift,
            "created": F.lit(created),
            "month": K.event_month("date"),
        }
    )
    return rows if even is None else rows.filter((F.col("volume") % 2 == 0) == F.lit(even))


@query("s10_upsert_latest", """
SELECT date, volume, round(used_gb + CASE WHEN volume % 2 = 0 THEN 1 ELSE 0 END, 4) AS used_gb,
  CASE WHEN volume % 2 = 0 THEN 2 ELSE 1 END AS created
FROM disk_usage""")
def _(t):
    path = scratch_path(t.spark, "disk_usage")
    K.upsert_latest(_usage_rows(t, 1), path, ["date", "volume"], "created")
    K.upsert_latest(_usage_rows(t, 2, even=True, shift=1), path, ["date", "volume"], "created")
    return t.spark.read.parquet(path).drop("month")


@query("s11_insert_absent", """
SELECT date, volume, round(used_gb + CASE WHEN volume % 2 = 0 THEN 0 ELSE 5 END, 4) AS used_gb FROM disk_usage""")
def _(t):
    path = scratch_path(t.spark, "disk_usage")
    K.insert_absent(_usage_rows(t, 1, even=True), path, ["date", "volume"])
    K.insert_absent(_usage_rows(t, 2, shift=5), path, ["date", "volume"])
    return t.spark.read.parquet(path).drop("month", "created")


@query("s12_append_history", """
SELECT event_date, CAST(to_json(list({'n': n, 'table_name': table_name} ORDER BY n DESC, table_name DESC)) AS varchar) AS tables
FROM (SELECT event_date, table_name, count(*) AS n FROM lock_events GROUP BY 1, 2) GROUP BY event_date""")
def _(t):
    counts = t.lock_events.groupBy("event_date", "table_name").agg(F.count("*").alias("n"))
    nested = counts.groupBy("event_date").agg(
        F.sort_array(F.collect_list(F.struct("n", "table_name")), asc=False).alias("tables")
    )
    path = scratch_path(t.spark, "checks")
    K.append_history(nested, path)
    return t.spark.read.parquet(path)


@query("s13_write_outbox", """
SELECT ts, severity, instance, value, alertname || ' on ' || instance AS message, 'false' AS acknowledged
FROM alerts WHERE severity = 'critical'""")
def _(t):
    raised = t.alerts.filter(F.col("severity") == "critical").select(
        "ts", "severity", "instance", "value", F.concat("alertname", F.lit(" on "), "instance").alias("message")
    )
    path = scratch_path(t.spark, "outbox")
    K.write_outbox(raised, path)
    return t.spark.read.parquet(path).withColumn("acknowledged", F.col("acknowledged").cast("string"))


@query("s14_retain", """
SELECT event_date, count(*) AS n FROM session_events WHERE event_date >= DATE '2024-01-15' GROUP BY 1""")
def _(t):
    path = scratch_path(t.spark, "session_events")
    K.append_session_events(t.session_events, path)
    K.retain(t.spark, path, "2024-04-15 00:00:00", "session_events")
    return t.spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"))


@query("s15_threshold_breaches", f"""
WITH h AS (SELECT event_date, event_hour, {DL} AS d, {TT} AS tt, avg(lock_wait_time) AS w, count(*) / 60.0 AS i
           FROM lock_events GROUP BY 1, 2)
SELECT event_date, event_hour, 'deadlock_warning' AS threshold_name, CAST(d AS double) AS value, 1.0::double AS threshold_value
  FROM h WHERE d >= 1
UNION ALL SELECT event_date, event_hour, 'timeout_warning', tt, 10 FROM h WHERE tt > 10
UNION ALL SELECT event_date, event_hour, 'wait_time_warning', round(w, 4), 500000 FROM h WHERE w > 500000
UNION ALL SELECT event_date, event_hour, 'wait_time_critical', round(w, 4), 1000000 FROM h WHERE w > 1000000
UNION ALL SELECT event_date, event_hour, 'lock_intensity_warning', round(i, 4), 1000 FROM h WHERE i > 1000""")
def _(t):
    return J.threshold_breaches(R.lock_hourly(t.lock_events), K.default_thresholds(t.spark))


@query("s15_growth_breaches", """
WITH d AS (SELECT event_date, table_name, count(*) AS n FROM lock_events WHERE table_name <> '' GROUP BY 1, 2),
g AS (SELECT event_date, table_name, (n - lag(n) OVER w) / CAST(lag(n) OVER w AS double) * 100 AS v FROM d
  WINDOW w AS (PARTITION BY table_name ORDER BY event_date))
SELECT event_date, table_name, threshold_name, round(v, 4) AS value, threshold_value
FROM g JOIN (VALUES ('trend_warning', 50.0::double), ('trend_critical', 100.0::double)) t(threshold_name, threshold_value) ON v > threshold_value""")
def _(t):
    return J.threshold_breaches(
        R.lock_table_daily(t.lock_events),
        K.default_thresholds(t.spark),
        ("event_date", "table_name"),
        J.GROWTH_THRESHOLD_COLUMNS,
    )


# ---- parsing -------------------------------------------------------------------

HEAD = f"""event_id, {LINE_TS} AS event_datetime, CAST({LINE_TS} AS date) AS event_date,
  CAST(hour({LINE_TS}) AS int) AS event_hour, CAST(minute({LINE_TS}) AS int) AS event_minute"""

HEAD_COLUMNS = ["event_datetime", "event_date", "event_hour", "event_minute"]


@query("p1_parse_session_lines", f"""
SELECT {HEAD}, {rx('[ ,]([A-Z_]+),')} AS event_type, {rx_int('session=([0-9]+)')} AS session_id,
  {rx_int('duration=([0-9]+)')} AS duration, {rx_int('lockWaitTime=([0-9]+)')} AS lock_wait_time,
  {rx_int('lockTime=([0-9]+)')} AS lock_time, {rx_int('connection=([0-9]+)')} AS connection_id,
  {rx_int('transaction=([0-9]+)')} AS transaction_id, {rx('userName="([^"]*)"')} AS user_name,
  {rx('computerName="([^"]*)"')} AS computer_name, {rx('processName=([^,]+)')} AS process_name,
  {rx('app-id="([^"]*)"')} AS app_name, {rx('dbms="([^"]*)"')} AS dbms, {rx('func="([^"]*)"')} AS func,
  CAST(line ILIKE '%deadlock%' AS int) AS is_deadlock,
  CAST(line ILIKE '%exception%' OR line ILIKE '%error%' AS int) AS is_exception,
  CAST(line ILIKE '%ttimeout%' AS int) AS is_timeout, left(line, 1000) AS raw_line
FROM log_lines""")
def _(t):
    return P.parse_session_lines(t.log_lines)


@query("p2_parse_lock_lines", f"""
SELECT {HEAD}, {rx('[ ,]([A-Z_]+),')} AS event_type, {rx_int('session=([0-9]+)')} AS session_id,
  {rx_int('transaction=([0-9]+)')} AS transaction_id, {rx_int('lockWaitTime=([0-9]+)')} AS lock_wait_time,
  {rx_int('lockTime=([0-9]+)')} AS lock_time, {rx_int('dbpid=([0-9]+)')} AS dbpid,
  {rx('userName="([^"]*)"')} AS user_name, {rx('processName=([^,]+)')} AS process_name,
  {rx('tableName="?([^",]+)"?')} AS table_name, {rx('lockType="?([^",]+)"?')} AS lock_type,
  {rx('lockMode="?([^",]+)"?')} AS lock_mode, {rx('lockName="?([^",]+)"?')} AS lock_name
FROM lock_lines WHERE {rx('[ ,]([A-Z_]+),')} IN ('LOCK', 'DEADLOCK', 'TTIMEOUT', 'SDBL')""")
def _(t):
    return P.parse_lock_lines(t.lock_lines)


@query("p1_wrapped_session_records", f"""
SELECT {HEAD.removeprefix('event_id, ')}, {rx('[ ,]([A-Z_]+),')} AS event_type, {rx_int('session=([0-9]+)')} AS session_id,
  {rx_int('duration=([0-9]+)')} AS duration, {rx_int('lockWaitTime=([0-9]+)')} AS lock_wait_time,
  {rx_int('lockTime=([0-9]+)')} AS lock_time, {rx('userName="([^"]*)"')} AS user_name,
  {rx('computerName="([^"]*)"')} AS computer_name, {rx('processName=([^,]+)')} AS process_name, left(line, 1000) AS raw_line
FROM log_lines""")
def _(t):
    parsed = P.parse_session_lines(_wrapped_folder(t, t.log_lines, SESSION_WRAPS))
    return parsed.select(
        *HEAD_COLUMNS, "event_type", "session_id", "duration", "lock_wait_time", "lock_time", "user_name", "computer_name", "process_name", "raw_line"
    )


@query("p2_wrapped_lock_records", f"""
SELECT {HEAD.removeprefix('event_id, ')}, {rx('[ ,]([A-Z_]+),')} AS event_type, {rx_int('session=([0-9]+)')} AS session_id,
  {rx_int('transaction=([0-9]+)')} AS transaction_id, {rx_int('lockWaitTime=([0-9]+)')} AS lock_wait_time,
  {rx_int('lockTime=([0-9]+)')} AS lock_time, {rx_int('dbpid=([0-9]+)')} AS dbpid,
  {rx('userName="([^"]*)"')} AS user_name, {rx('processName=([^,]+)')} AS process_name,
  {rx('tableName="?([^",]+)"?')} AS table_name, {rx('lockType="?([^",]+)"?')} AS lock_type,
  {rx('lockMode="?([^",]+)"?')} AS lock_mode, {rx('lockName="?([^",]+)"?')} AS lock_name
FROM lock_lines WHERE {rx('[ ,]([A-Z_]+),')} IN ('LOCK', 'DEADLOCK', 'TTIMEOUT', 'SDBL')""")
def _(t):
    return P.parse_lock_lines(_wrapped_folder(t, t.lock_lines, LOCK_WRAPS)).drop("file")


def rx_or_null(pattern, kind="varchar"):
    """What the pattern finds, null where it finds nothing."""
    return f"CAST(CASE WHEN regexp_matches(line, '{pattern}') THEN regexp_extract(line, '{pattern}', 1) END AS {kind})"


@query("p3_parse_legacy_lines", f"""
SELECT event_id, CAST(substr(line, 1, 2) AS int) AS hour, CAST(substr(line, 4, 2) AS int) AS minute,
  CAST(substr(line, 7, 2) AS int) AS second, CAST(substr(line, 10, 3) AS int) AS millisecond,
  CAST({rx('duration=([0-9]+)')} AS bigint) AS duration, CAST({rx('waitTime=([0-9]+)')} AS bigint) AS wait_time,
  CAST({rx('.*session=([0-9]+)')} AS bigint) AS session, {rx('user="([^"]*)"')} AS user,
  nullif({rx('context="([^"]*)"')}, '') AS context, {rx_or_null('lockTime=([0-9]+)', 'bigint')} AS lock_time,
  {rx_or_null('transaction=([0-9]+)', 'bigint')} AS transaction, {rx_or_null('connection=([0-9]+)', 'bigint')} AS connection,
  {rx_or_null('computer="([^"]*)"')} AS computer, {rx_or_null('app-id="([^"]*)"')} AS app_id, {rx_or_null('data="([^"]*)"')} AS data,
  {rx_or_null('dbms="([^"]*)"')} AS dbms, {rx_or_null('dbpid=([0-9]+)', 'bigint')} AS dbpid,
  {rx_or_null('block="([^"]*)"')} AS block, {rx_or_null('func="([^"]*)"')} AS func, line AS raw_line
FROM legacy_lines""")
def _(t):
    return P.parse_legacy_lines(t.legacy_lines)


@query("p4_defaults", f"""
SELECT {rx_int('dbpid=([0-9]+)')} = 0 AS no_dbpid, {rx('lockName="?([^",]+)"?')} = '' AS no_name, count(*) AS n
FROM lock_lines WHERE {rx('[ ,]([A-Z_]+),')} IN ('LOCK', 'DEADLOCK', 'TTIMEOUT', 'SDBL') GROUP BY ALL""")
def _(t):
    parsed = P.parse_lock_lines(t.lock_lines)
    return parsed.groupBy(
        (F.col("dbpid") == 0).alias("no_dbpid"), (F.col("lock_name") == "").alias("no_name")
    ).agg(F.count("*").alias("n"))


@query("p5_line_flags", """
SELECT CAST(line ILIKE '%deadlock%' AS int) AS is_deadlock,
  CAST(line ILIKE '%exception%' OR line ILIKE '%error%' AS int) AS is_exception,
  CAST(line ILIKE '%ttimeout%' AS int) AS is_timeout, count(*) AS n
FROM (SELECT line FROM lock_lines UNION ALL SELECT line FROM log_lines) GROUP BY 1, 2, 3""")
def _(t):
    lines = t.lock_lines.select("line").unionByName(t.log_lines.select("line"))
    return P.parse_session_lines(lines).groupBy(*P.FLAGS).agg(F.count("*").alias("n"))


@query("p6_parse_stats", f"""
SELECT strftime({LINE_TS}, '%y%m%d%H') || '.log' AS file, count(*) AS lines,
  count(*) FILTER (WHERE event_id % 17 <> 0 AND event_id % 19 <> 0) AS parsed,
  count(*) FILTER (WHERE event_id % 17 = 0 AND event_id % 19 <> 0) AS rejected,
  count(*) FILTER (WHERE event_id % 19 = 0) AS blank
FROM log_lines GROUP BY 1""")
def _(t):
    damaged = F.when(F.col("event_id") % 19 == 0, "  ").when(F.col("event_id") % 17 == 0, F.expr("substr(line, 5)"))
    lines = t.log_lines.select(
        F.concat(F.date_format(P.header_time(F.col("line")), "yyMMddHH"), F.lit(".log")).alias("file"),
        damaged.otherwise(F.col("line")).alias("line"),
    )
    return P.parse_stats(lines)
