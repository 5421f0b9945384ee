"""Streaming ST1-ST5, ST7, ST8, run over the event table as a file stream."""

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.tables import event_month
from ..sources.logs import stream_log_lines
from ..streaming import alerts as A
from ..streaming import compaction as C
from ..streaming import ingest as I
from ..streaming import rollups as R
from .q_locks import NOTIFICATIONS
from .q_rollups import DL, LOCK_HOURLY, LOCK_TABLE_DAILY, LOCK_USER_DAILY, TECHLOG_HOURLY, TT, WEEKEND, WORK, avg, total
from .q_sources import LINE_TS
from .registry import query


def events_stream(t):
    """The events table read as a stream."""
    return (
        t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)
    )


def streamed(t, view):
    return t.view(view, events=events_stream(t))


def stored(t, stream, shape, name):
    """What ``shape`` stores of every micro-batch."""
    path = scratch_path(t.spark, name)
    R.run_partials(stream, shape, path, f"{path}__checkpoint").awaitTermination()
    return t.spark.read.parquet(path)


def in_batches(t, view, n=12):
    """A view over the events, which arrive in ``n`` files of their own and so in ``n`` micro-batches."""
    folder = scratch_path(t.spark, "arrivals")
    t.events.repartitionByRange(n, "ts").write.parquet(folder)
    return t.view(view, events=t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(folder))


def without_sketches(df):
    return df.drop(*[c for c in df.columns if c.startswith("approx_")])


@query("st1_session_hourly_stream", f"""
SELECT event_date, event_hour, count(*) AS total_sessions, {avg('duration', 'avg_duration')}, max(duration) AS max_duration,
  {avg('lock_wait_time', 'avg_lock_wait_time')}, {total('lock_wait_time', 'total_lock_wait_time')},
  {total('is_deadlock', 'deadlock_count')}, {total('is_exception', 'exception_count')}, {total('is_timeout', 'timeout_count')},
  {WEEKEND}, {WORK}
FROM session_events GROUP BY event_date, event_hour""")
def _(t):
    partials = stored(t, streamed(t, "session_events"), R.session_hour_partials, "session_hourly")
    return without_sketches(R.session_hourly(partials))


@query("st1_lock_hourly_stream", f"""
SELECT * EXCLUDE (p95_lock_wait_time, unique_sessions, unique_transactions, unique_users) FROM ({LOCK_HOURLY})""")
def _(t):
    return without_sketches(R.lock_hourly(stored(t, streamed(t, "lock_events"), R.lock_hour_partials, "lock_hourly")))


@query("st1_lock_table_daily_stream", f"""
SELECT * EXCLUDE (p95_lock_wait_time, unique_sessions, unique_transactions, unique_users) FROM ({LOCK_TABLE_DAILY})""")
def _(t):
    return without_sketches(R.lock_table_daily(stored(t, streamed(t, "lock_events"), R.lock_table_day_partials, "lock_table_daily")))


@query("st1_lock_user_daily_stream", f"""
SELECT * EXCLUDE (unique_tables, unique_sessions) FROM ({LOCK_USER_DAILY})""")
def _(t):
    return without_sketches(R.lock_user_daily(stored(t, streamed(t, "lock_events"), R.lock_user_day_partials, "lock_user_daily")))


@query("st1_techlog_hourly_stream", f"""
SELECT * EXCLUDE (p95_duration, unique_sessions, unique_users, unique_computers) FROM ({TECHLOG_HOURLY})""")
def _(t):
    return without_sketches(R.techlog_hourly(stored(t, streamed(t, "techlog"), R.techlog_hour_partials, "techlog_hourly")))


@query("st1_lock_hourly_compacted", f"""
SELECT * EXCLUDE (p95_lock_wait_time, unique_sessions, unique_transactions, unique_users) FROM ({LOCK_HOURLY})""")
def _(t):
    """Twelve micro-batches, merged three by three into two levels before they are read."""
    path = scratch_path(t.spark, "lock_hourly")
    R.run_partials(in_batches(t, "lock_events"), R.lock_hour_partials, path, f"{path}__checkpoint").awaitTermination()
    C.compact(t.spark, path, R.LOCK_HOUR.merged, fanout=3)
    return without_sketches(R.lock_hourly(C.read_partials(t.spark, path)))


@query("st2_session_event_stream", f"""
SELECT CAST({LINE_TS} AS date) AS event_date, regexp_extract(line, 'userName="([^"]*)"', 1) AS user_name, count(*) AS n,
  CAST(sum(CAST(regexp_extract(line, 'duration=([0-9]+)', 1) AS bigint)) AS bigint) AS duration
FROM log_lines GROUP BY 1, 2""")
def _(t):
    folder = scratch_path(t.spark, "incoming")
    t.log_lines.select("line").write.text(folder, compression="gzip")
    events = I.drained(I.session_event_stream(stream_log_lines(t.spark, folder, "*.{txt,txt.gz}")), "session_events")
    return events.groupBy("event_date", "user_name").agg(F.count("*").alias("n"), F.sum("duration").alias("duration"))


@query("st2_lock_event_stream", f"""
SELECT regexp_extract(line, '[ ,]([A-Z_]+),', 1) AS event_type, count(*) AS n FROM lock_lines
WHERE regexp_extract(line, '[ ,]([A-Z_]+),', 1) IN ('LOCK', 'DEADLOCK', 'TTIMEOUT', 'SDBL') GROUP BY 1""")
def _(t):
    events = I.drained(I.lock_event_stream(streamed(t, "lock_lines").drop("event_id")), "lock_events")
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


@query("st3_deduplicated", f"""
SELECT CAST({LINE_TS} AS date) AS event_date, count(DISTINCT line) AS n FROM log_lines GROUP BY 1""")
def _(t):
    """Every line arrives twice."""
    lines = streamed(t, "log_lines").drop("event_id")
    twice = lines.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy").withColumn("file", F.lit("events"))
    path = scratch_path(t.spark, "deduplicated")
    I.run_deduplicated(twice, I.session_event_stream, path, f"{path}__checkpoint").awaitTermination()
    return t.spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"))


@query("st3_positioned_records", f"""
SELECT CAST({LINE_TS} AS date) AS event_date, 2 * count(*) AS n FROM log_lines GROUP BY 1""")
def _(t):
    """Every line stands twice in its file, and every file arrives twice."""
    folder, path = scratch_path(t.spark, "incoming"), scratch_path(t.spark, "positioned")
    copies = t.log_lines.select("line", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy"))
    copies.select(F.concat_ws("\n", "line", "line").alias("line"), "copy").write.partitionBy("copy").text(folder)
    lines = I.stream_placed_lines(t.spark, folder, "*.txt", max_files=4)
    I.run_positioned(lines, I.session_event_stream, path, f"{path}__checkpoint").awaitTermination()
    return t.spark.read.parquet(path).groupBy("event_date").agg(F.count("*").alias("n"))


@query("st4_rolling_last_hour", f"""
WITH w AS (SELECT unnest(range(0, 4)) AS k),
e AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, event_datetime) + INTERVAL 15 MINUTE * (k + 1) AS as_of FROM lock_events, w)
SELECT as_of, count(*) AS total_locks, {DL} AS deadlocks, {TT} AS timeouts,
  round(avg(lock_wait_time) / 1000, 4) AS avg_wait_ms, round(max(lock_wait_time) / 1000, 4) AS max_wait_ms
FROM e GROUP BY 1""")
def _(t):
    return without_sketches(R.rolling_last_hour(stored(t, streamed(t, "lock_events"), R.lock_quarter_partials, "last_hour")))


# At every quarter the score that the lock risk would give at that time, end excluded; the trend is over exact spans.
@query("st4_rolling_risk", f"""
WITH w AS (SELECT unnest(range(0, 4)) AS k),
e AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, event_datetime) + INTERVAL 15 MINUTE * (k + 1) AS as_of FROM lock_events, w),
s AS (SELECT as_of, count(*) AS total_locks, {DL} AS deadlocks, {TT} AS timeouts,
  avg(lock_wait_time) / 1000 AS avg_wait_ms, max(lock_wait_time) / 1000 AS max_wait_ms FROM e GROUP BY 1),
d AS (SELECT as_of, CAST(event_datetime AS date) AS day, avg(lock_wait_time) AS wait FROM s JOIN lock_events
  ON event_datetime < as_of AND event_datetime >= as_of - INTERVAL 7 DAY GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY day) AS rn, count(*) OVER (PARTITION BY as_of) AS n FROM d),
h AS (SELECT as_of, avg(wait) FILTER (WHERE rn <= n // 2) AS a, avg(wait) FILTER (WHERE rn > n // 2) AS b FROM r GROUP BY 1 HAVING count(*) >= 2),
t AS (SELECT as_of, CASE WHEN a > 0 THEN (b - a) / a * 100 ELSE 0 END AS trend_pct FROM h),
p AS (SELECT s.*, trend_pct, CAST((CASE WHEN deadlocks >= 1 THEN 50 ELSE 0 END)
    + (CASE WHEN max_wait_ms > 1000 THEN 30 WHEN avg_wait_ms > 500 THEN 15 ELSE 0 END)
    + (CASE WHEN trend_pct > 100 THEN 40 WHEN trend_pct > 50 THEN 20 ELSE 0 END) AS int) AS risk_score FROM s LEFT JOIN t USING (as_of))
SELECT * REPLACE (round(avg_wait_ms, 4) AS avg_wait_ms, round(max_wait_ms, 4) AS max_wait_ms, round(trend_pct, 4) AS trend_pct),
  CASE WHEN risk_score >= 70 THEN 'critical' WHEN risk_score >= 40 THEN 'high' WHEN risk_score >= 20 THEN 'warning'
  ELSE 'normal' END AS risk_level FROM p""")
def _(t):
    risk = R.rolling_risk(stored(t, streamed(t, "lock_events"), R.lock_quarter_partials, "rolling_risk"))
    return without_sketches(risk).drop("warnings")


@query("st4_rolling_sessions", f"""
WITH w AS (SELECT unnest(range(0, 4)) AS k),
e AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, event_datetime) + INTERVAL 15 MINUTE * (k + 1) AS as_of FROM session_events, w)
SELECT as_of, count(*) AS sessions, {avg('duration', 'avg_duration')}, {total('is_deadlock', 'deadlocks')},
  {total('is_exception', 'exceptions')}, {total('is_timeout', 'timeouts')}
FROM e GROUP BY 1""")
def _(t):
    return without_sketches(R.rolling_sessions(stored(t, streamed(t, "session_events"), R.session_quarter_partials, "last_hour_sessions")))


@query("st5_alert_states", """
WITH s AS (SELECT event_type AS instance, ts, value FROM events),
g AS (SELECT *, value > 30 AS c, sum(CASE WHEN value > 30 THEN 0 ELSE 1 END) OVER (PARTITION BY instance ORDER BY ts) AS grp FROM s),
r AS (SELECT *, min(CASE WHEN c THEN ts END) OVER (PARTITION BY instance, grp) AS rs FROM g)
SELECT instance, ts, value, c AS condition, CASE WHEN c THEN rs END AS run_start,
  CASE WHEN NOT c THEN 'inactive' WHEN ts - rs >= INTERVAL 30 MINUTE THEN 'firing' ELSE 'pending' END AS state FROM r""")
def _(t):
    samples = events_stream(t).select(F.col("event_type").alias("instance"), "ts", "value")
    kept = stored(t, samples, lambda batch: batch, "samples")
    return A.alert_states(kept, ["instance"], F.col("value") > 30, 1800)


@query("st5_alert_transitions", """
WITH s AS (SELECT event_type AS instance, ts, value FROM events),
g AS (SELECT *, value > 30 AS c, sum(CASE WHEN value > 30 THEN 0 ELSE 1 END) OVER (PARTITION BY instance ORDER BY ts) AS grp FROM s),
r AS (SELECT *, min(CASE WHEN c THEN ts END) OVER (PARTITION BY instance, grp) AS rs FROM g),
a AS (SELECT instance, ts, CASE WHEN c THEN rs END AS run_start,
  CASE WHEN NOT c THEN 'inactive' WHEN ts - rs >= INTERVAL 30 MINUTE THEN 'firing' ELSE 'pending' END AS state FROM r),
b AS (SELECT *, lag(state, 1, 'inactive') OVER (PARTITION BY instance ORDER BY ts) AS before FROM a)
SELECT instance, ts, state, run_start FROM b WHERE state <> before""")
def _(t):
    """The samples arrive in four files, in order of time."""
    folder, path = scratch_path(t.spark, "samples"), scratch_path(t.spark, "transitions")
    first, last = t.events.agg(F.min("ts"), F.max("ts")).first()
    part = F.floor(4 * (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.lit(first).cast("timestamp"))) / max((last - first).total_seconds() * 1e6 + 1, 1))
    for n in range(4):
        t.events.where(part == n).select("event_type", "ts", "value").coalesce(1).write.mode("append").parquet(folder)
    samples = t.spark.readStream.schema("event_type string, ts timestamp_ntz, value double").option("maxFilesPerTrigger", 1).parquet(folder)
    samples = samples.withColumnRenamed("event_type", "instance")
    A.run_transitions(samples, path, f"{path}__checkpoint", ["instance"], F.col("value") > 30, 1800).awaitTermination()
    return t.spark.read.parquet(path).drop("batch")


@query("st6_notifications_stream", NOTIFICATIONS)
def _(t):
    kept = stored(t, streamed(t, "alerts"), lambda batch: batch, "alerts")
    return A.notifications(kept, ["alertname", "instance"])


@query("st7_run_upserts", """
SELECT CAST(ts AS date) AS date, event_type, count(*) AS n, max(event_id) AS last_event FROM events GROUP BY 1, 2""")
def _(t):
    day = F.to_date("ts")
    counts = events_stream(t).groupBy(day.alias("date"), "event_type").agg(
        F.count("*").alias("n"), F.max("event_id").alias("last_event")
    )
    path = scratch_path(t.spark, "daily_counts")
    stream = counts.withColumn("event_month", event_month("date"))
    I.run_upserts(stream, path, f"{path}__checkpoint", ["date", "event_type"], "last_event", "event_month").awaitTermination()
    return t.spark.read.parquet(path).drop("event_month")


@query("st8_conflict_pairs_stream", """
SELECT second, table1, table2, count(*) AS conflicts
FROM (SELECT date_trunc('second', a.event_datetime) AS second, a.table_name AS table1, b.table_name AS table2
      FROM lock_events a JOIN lock_events b ON date_trunc('second', a.event_datetime) = date_trunc('second', b.event_datetime)
        AND a.session_id <> b.session_id AND a.event_type = 'LOCK' AND b.event_type = 'LOCK' AND a.table_name < b.table_name)
GROUP BY 1, 2, 3""")
def _(t):
    return R.conflict_pairs(stored(t, streamed(t, "lock_events"), R.second_partials("LOCK"), "conflicts"))
