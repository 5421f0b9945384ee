"""Reports A19-A22, A24, A25, A27, A28, A31-A35 and growth plans M24-M33."""

from pyspark.sql import functions as F

from ..functions.text import ERROR_DEFAULT, ERROR_RULES
from ..functions.timeparts import within
from ..operators import reports as E
from ..operators import windows as W
from ..operators import sliced as S
from ..plans import advice as V
from ..plans import growth as G
from .bindings import AS_OF, ORDERS_AS_OF
from .q_features import LABEL
from .q_rollups import DAY, NOW, avg, last_days, total
from .registry import query

TYPED = f"(SELECT *, {LABEL} AS error_type FROM error_events)"

ROLE_ERRORS = f"""(SELECT user_role, error_type, n, CAST(sum(n) OVER (PARTITION BY user_role) AS bigint) AS total_errors,
  CAST(row_number() OVER (PARTITION BY user_role ORDER BY n DESC, error_type) AS int) AS rank
  FROM (SELECT user_role, error_type, count(*) AS n FROM {TYPED} GROUP BY 1, 2))"""


@query("a19_errors_by_role", f"SELECT * FROM {ROLE_ERRORS} WHERE rank <= 3")
def _(t):
    return E.errors_by_role(t.error_events)


KINDS = [*dict.fromkeys(label for label, _ in ERROR_RULES), ERROR_DEFAULT]


@query("a19_role_matrix", f"""
SELECT user_role, {', '.join(f"count(*) FILTER (WHERE error_type = '{k}') AS {k}" for k in KINDS)} FROM {TYPED} GROUP BY 1""")
def _(t):
    return E.role_matrix(t.error_events, KINDS)


USER_ERRORS = f"""(SELECT user_name, CAST(sum(n) AS bigint) AS total_errors,
  string_agg(error_type || '=' || n, ',' ORDER BY error_type) AS error_types
  FROM (SELECT user_name, error_type, count(*) AS n FROM {TYPED} GROUP BY 1, 2) GROUP BY 1 HAVING sum(n) >= 10)"""


@query("a20_users_for_training", f"SELECT * FROM {USER_ERRORS}")
def _(t):
    users = E.users_for_training(t.error_events)
    pairs = F.transform(
        F.map_entries("error_types"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))
    )
    return users.withColumn("error_types", F.array_join(pairs, ","))


USERS = f"""(SELECT user_name, {', '.join(f'avg({c}) AS {c}' for c in E.EFFICIENCY)}, arg_min(department, date) AS department,
  arg_min(role, date) AS role FROM user_efficiency GROUP BY 1)"""
ROUND_USERS = ", ".join(f"round({c}, 8) AS {c}" for c in E.EFFICIENCY)


@query("a21_user_stats", f"SELECT * REPLACE ({ROUND_USERS}) FROM {USERS}", digits=8)
def _(t):
    return E.user_stats(t.user_efficiency)


def _labelled(t):
    """Queries with a fixed cluster label."""
    return t.slow_queries.withColumn("cluster", (F.col("query_id") % 10).cast("int"))


@query("a22_cluster_profile", f"""
SELECT CAST(query_id % 10 AS int) AS cluster, count(*) AS count, {avg('duration', 'avg_duration')},
  max(duration) AS max_duration FROM slow_queries GROUP BY 1""")
def _(t):
    return E.cluster_profile(_labelled(t), ["duration"])


@query("a22_slowest_cluster", """
SELECT CAST(query_id % 10 AS int) AS cluster, round(avg(duration), 4) AS avg_duration FROM slow_queries GROUP BY 1
ORDER BY avg(duration) DESC, cluster LIMIT 1""")
def _(t):
    return E.leading_cluster(E.cluster_profile(_labelled(t), ["duration"]), "avg_duration")


@query("a22_describe", f"""
SELECT department, count(active_hours) AS count, {avg('active_hours', 'mean')}, round(stddev_samp(active_hours), 4) AS std,
  round(min(active_hours), 4) AS min, round(max(active_hours), 4) AS max,
  {', '.join(f'round(quantile_cont(active_hours, {p}), 4) AS {n}' for n, p in (('q25', 0.25), ('q50', 0.5), ('q75', 0.75)))}
FROM {USERS} GROUP BY 1""")
def _(t):
    return E.describe_measure(E.user_stats(t.user_efficiency), "active_hours", ["department"])


@query("a22_value_counts", f"SELECT department, role, count(*) AS n FROM {USERS} GROUP BY 1, 2")
def _(t):
    return E.value_counts(E.user_stats(t.user_efficiency), "role", ["department"])


@query("a24_tickets_daily", f"""
SELECT created_date AS date, count(*) AS tickets_count, {avg('first_response_time', 'first_response_time')},
  {avg('resolution_time', 'resolution_time')} FROM support_tickets GROUP BY 1""")
def _(t):
    return E.tickets_daily(t.support_tickets)


INTERVALS = """(
WITH o AS (SELECT *, row_number() OVER w AS rn, date - lag(date) OVER w AS gap FROM releases
  WINDOW w AS (PARTITION BY product ORDER BY date, version))
SELECT product, count(*) AS count, avg(gap) AS avg_interval, stddev_samp(gap) AS std_interval,
  CAST(min(gap) AS int) AS min_interval, CAST(max(gap) AS int) AS max_interval, max(date) AS last_date,
  first(version ORDER BY date DESC, version DESC) AS last_version,
  CASE WHEN count(gap) > 3 THEN regr_slope(gap, rn - 2) END AS trend
FROM o GROUP BY product)"""


@query("a25_interval_stats", f"""
SELECT * REPLACE (round(avg_interval, 4) AS avg_interval, round(std_interval, 4) AS std_interval, round(trend, 4) + 0.0::double AS trend)
FROM {INTERVALS}""")
def _(t):
    return W.interval_stats(t.releases, "product")


@query("a27_recent_anomalies", f"""
SELECT ts AS detected_at, instance AS metric_name, value AS actual_value, round(mean, 9) AS expected_value,
  round(abs(value - mean) / nullif(std, 0), 9) AS deviation_sigma
FROM (SELECT *, avg(value) OVER w AS mean, stddev_pop(value) OVER w AS std FROM metric_samples
  WINDOW w AS (PARTITION BY instance ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW))
WHERE abs(value - mean) / nullif(std, 0) > 2 AND ts >= {NOW} - INTERVAL 7 DAY AND ts <= {NOW}""", digits=9)
def _(t):
    chart = S.control_chart(t.metric_samples, AS_OF, ["instance"], sigmas=2.0, last_days=7)
    found = chart.filter("alarm").select(
        F.col("ts").alias("detected_at"),
        F.col("instance").alias("metric_name"),
        F.col("value").alias("actual_value"),
        F.col("mean").alias("expected_value"),
        F.col("sigma").alias("deviation_sigma"),
    )
    return E.recent_anomalies(found, AS_OF)


PLAN = """(SELECT month, CAST(floor(total_users * 1.1::double) AS bigint) AS licenses_needed,
  CAST(floor(total_users * 1.1::double) AS bigint) * 1800.0::double AS cost, total_users AS users_forecast,
  (total_users / first_value(total_users) OVER (ORDER BY month)::double - 1) * 100 AS growth FROM license_stats)"""


def _plan(t):
    return G.license_plan(t.license_stats.withColumnRenamed("total_users", "users_forecast"))


@query("a28_budget_check", f"""
SELECT CASE WHEN c > b THEN 'critical' ELSE 'ok' END AS status, c AS total_cost, b AS budget,
  CASE WHEN c > b THEN c - b END AS deficit, CASE WHEN c <= b THEN b - c END AS surplus
FROM (SELECT sum(cost) AS c, 20000000.0::double AS b FROM {PLAN})""")
def _(t):
    return E.budget_check(_plan(t), 20_000_000)


@query("m27_license_plan", f"SELECT * REPLACE (round(growth, 4) AS growth) FROM {PLAN}")
def _(t):
    return _plan(t)


@query("a31_slow_query_report", f"""
WITH m AS (SELECT query_text, date_trunc('month', event_date - CAST(query_id % 3 * 31 AS int))::date AS month,
    avg(duration) AS d, count(*) AS runs FROM slow_queries GROUP BY 1, 2),
c AS (SELECT *, CASE WHEN lag(month) OVER w = month - INTERVAL 1 MONTH THEN (d - lag(d) OVER w) / nullif(lag(d) OVER w, 0) * 100 END AS change_pct FROM m
  WINDOW w AS (PARTITION BY query_text ORDER BY month))
SELECT query_text, month, round(d, 4) AS mean_duration, runs, round(change_pct, 4) AS change_pct,
  array_to_string(list_sort(list_distinct(regexp_extract_all(query_text, '_([A-Za-z]+[0-9]*)', 1))), ',') AS tables,
  CASE WHEN change_pct > 10 THEN 'rising' WHEN change_pct < -10 THEN 'improving' ELSE 'stable' END AS label
FROM c WHERE month = DATE '2024-01-01'""")
def _(t):
    spread = F.date_sub("event_date", (F.col("query_id") % 3 * 31).cast("int"))
    report = E.slow_query_report(t.slow_queries.withColumn("event_date", spread), AS_OF)
    return report.withColumn("tables", F.array_join("tables", ","))


@query("a32_weekday_profile", """
WITH h AS (SELECT created_date, created_hour, count(*) AS n FROM support_tickets GROUP BY 1, 2),
d AS (SELECT CAST(isodow(created_date) AS int) AS weekday, avg(n) AS m FROM (SELECT created_date, sum(n) AS n FROM h GROUP BY 1) GROUP BY 1),
b AS (SELECT CAST(isodow(created_date) AS int) AS weekday, created_hour, sum(n) AS n FROM h GROUP BY 1, 2),
r AS (SELECT weekday, created_hour, sum(n) OVER (PARTITION BY weekday ORDER BY created_hour
        RANGE BETWEEN CURRENT ROW AND 1 FOLLOWING) AS band FROM b)
SELECT d.weekday, round(m, 4) AS mean_tickets, first(created_hour ORDER BY band DESC, created_hour) AS peak_from_hour,
  CAST(max(band) AS bigint) AS peak_tickets
FROM d JOIN r ON d.weekday = r.weekday GROUP BY d.weekday, m""")
def _(t):
    return E.weekday_profile(t.support_tickets)


# Response limits in minutes per ticket priority.
SLA_MINUTES = [("1-URGENT", 30), ("2-HIGH", 120), ("3-MEDIUM", 240), ("4-NOT SPECIFIED", 240), ("5-LOW", 1440)]


@query("a33_sla_status", f"""
SELECT priority, round(avg(first_response_time), 4) AS mean_response, limit_minutes,
  CASE WHEN avg(first_response_time) >= limit_minutes * 0.5 THEN 'attention' ELSE 'ok' END AS status
FROM support_tickets JOIN (VALUES {', '.join(f"('{p}', {m})" for p, m in SLA_MINUTES)}) s(priority, limit_minutes) USING (priority)
GROUP BY priority, limit_minutes""")
def _(t):
    sla = t.spark.createDataFrame(SLA_MINUTES, "priority string, limit_minutes int")
    return E.sla_status(t.support_tickets, sla)


def _dominant(column):
    return f"""(SELECT error_type, first(v ORDER BY m DESC, v DESC) AS v, max(m) AS m FROM (
      SELECT error_type, {column} AS v, count(*) AS m FROM {TYPED} GROUP BY 1, 2) GROUP BY 1)"""


@query("a34_error_shares", f"""
WITH e AS (SELECT error_type, count(*) AS n FROM {TYPED} GROUP BY 1)
SELECT e.error_type, n, round(n / (sum(n) OVER ())::double * 100, 4) AS share_pct, r.v AS top_role,
  round(r.m / n::double * 100, 4) AS top_role_pct, o.v AS top_operation, round(o.m / n::double * 100, 4) AS top_operation_pct
FROM e JOIN {_dominant('user_role')} r ON e.error_type = r.error_type
JOIN {_dominant('operation_name')} o ON e.error_type = o.error_type""")
def _(t):
    return E.error_shares(t.error_events)


ORDERS_DAY = f"DATE '{ORDERS_AS_OF[:10]}'"


@query("a35_operation_outlook", f"""
WITH y AS (SELECT *, date >= {ORDERS_DAY} - 30 AS recent FROM operation_log
  WHERE date >= {ORDERS_DAY} - 365 AND date <= {ORDERS_DAY}),
s AS (SELECT operation_name, avg(duration_minutes) AS m, avg(duration_minutes) FILTER (WHERE recent) AS f,
  avg(documents_count) AS d, avg(documents_count) FILTER (WHERE recent) AS dr,
  avg(lines_count) AS l, avg(lines_count) FILTER (WHERE recent) AS lr FROM y GROUP BY 1)
SELECT operation_name, round(m, 4) AS mean_12m, round(f, 4) AS forecast_minutes, round((f - m) / m * 100, 4) AS change_pct,
  f > 25 AS over_sla, round((dr - d) / d * 100, 4) AS documents_count_growth_pct, round((lr - l) / l * 100, 4) AS lines_count_growth_pct
FROM s""")
def _(t):
    log = t.operation_log
    forecast = within(log, "date", ORDERS_AS_OF, days=30).groupBy("operation_name").agg(
        F.avg("duration_minutes").alias("forecast_minutes")
    )
    return E.operation_outlook(log, forecast, ORDERS_AS_OF, 25.0)


# ---- growth and advice -----------------------------------------------------------


@query("m24_table_growth_forecast")
def _(t):
    return G.table_growth_forecast(t.table_stats)


@query("m24_table_growth_report")
def _(t):
    return G.table_growth_report(t.table_stats)


# The check removes month, then quarter, from the day number and regresses on what is left.
@query("m25_multi_growth", """
WITH f AS (SELECT table_name, size_gb AS y, CAST(date - min(date) OVER (PARTITION BY table_name) AS double) AS d,
    CAST(month(date) AS double) AS m, CAST(quarter(date) AS double) AS q FROM table_stats),
a AS (SELECT *, q - regr_slope(q, m) OVER w * m - regr_intercept(q, m) OVER w AS q1,
    d - regr_slope(d, m) OVER w * m - regr_intercept(d, m) OVER w AS d1 FROM f WINDOW w AS (PARTITION BY table_name)),
b AS (SELECT *, d1 - regr_slope(d1, q1) OVER (PARTITION BY table_name) * q1 AS d2 FROM a)
SELECT table_name, count(*) AS n, round(regr_r2(y, m) + regr_r2(y, q1) + regr_r2(y, d2), 4) AS r2,
  round(regr_slope(y, d2), 4) AS per_day
FROM b GROUP BY 1""")
def _(t):
    return G.multi_growth(t.table_stats).select("table_name", "n", "r2", F.get("coef", 1).alias("per_day"))


@query("m26_user_growth_fit")
def _(t):
    return G.user_growth_fit(t.license_stats)


@query("m26_user_growth_forecast")
def _(t):
    return G.user_growth_forecast(t.license_stats)


@query("m27_license_outlook")
def _(t):
    return G.license_plan(G.user_growth_forecast(t.license_stats))


@query("m28_seasonal_forecast")
def _(t):
    return G.seasonal_forecast(t.metric_samples, "instance", 48)


def _daily_tickets(t):
    return t.support_tickets.groupBy("priority", F.col("created_date").alias("date")).agg(F.count("*").alias("tickets"))


@query("m28_seasonal_tickets")
def _(t):
    return G.seasonal_forecast(
        _daily_tickets(t), "priority", 30, ts="date", value="tickets", step_hours=24,
        seasons={"weekly": 3, "yearly": 2}, holidays=["2000-01-01", "2001-01-01"],
    )


# Table sizes whose growth may change.
BENDING = {"ts": "date", "value": "size_gb", "seasons": {"weekly": 1, "yearly": 2}, "changes": 25}


@query("m28_bending_forecast")
def _(t):
    return G.seasonal_forecast(t.table_stats, "table_name", 90, step_hours=24, **BENDING)


@query("m28_trend_changes")
def _(t):
    return G.trend_changes(t.table_stats, "table_name", **BENDING)


@query("m29_ar_forecast")
def _(t):
    return G.ar_forecast(_daily_tickets(t), "priority", "tickets")


@query("m29_arma_forecast")
def _(t):
    return G.arma_forecast(_daily_tickets(t), "priority", "tickets")


NEXT = f"""(SELECT product, last_version, '8.3.' || (CAST(split_part(last_version, '.', 3) AS bigint) + 1) AS next_version,
  last_date + CAST(floor(round(avg_interval, 9)) AS int) AS next_date,
  last_date + CAST(floor(round(avg_interval - std_interval, 9)) AS int) AS confidence_low,
  last_date + CAST(floor(round(avg_interval + std_interval, 9)) AS int) AS confidence_high, round(trend, 4) + 0.0::double AS trend
  FROM {INTERVALS} WHERE avg_interval IS NOT NULL)"""


@query("m30_next_event", f"SELECT * FROM {NEXT}")
def _(t):
    return G.next_event(t.releases, "product")


@query("m30_upgrade_windows", f"""
SELECT product, next_version, CAST(next_date - {ORDERS_DAY} AS int) AS days_left, CAST(next_date - 30 AS date) AS deadline
FROM {NEXT} WHERE next_date - {ORDERS_DAY} < 60""")
def _(t):
    return G.upgrade_windows(G.next_event(t.releases, "product"), ORDERS_AS_OF, "product")


@query("m31_peaks", """
SELECT instance, ts, value, 6.0::double AS threshold, value - 6 AS excess FROM metric_samples WHERE value > 6""")
def _(t):
    return G.peaks(t.metric_samples, "value", 6).drop("metric")


@query("m31_risk_hours", """
SELECT date_trunc('hour', event_datetime) AS ts, round(avg(duration) / 4000, 7) AS cpu_usage, count(*) AS active_sessions
FROM session_events GROUP BY 1 HAVING avg(duration) / 4000 > 80 OR count(*) > 400""", digits=7)
def _(t):
    hour = F.timestamp_add("HOUR", F.col("event_hour"), F.col("event_date").cast("timestamp_ntz"))
    load = t.session_events.groupBy(hour.alias("ts")).agg(
        (F.avg("duration") / 4000).alias("cpu_usage"), F.count("*").alias("active_sessions")
    )
    return G.risk_hours(load)


USERS_ORDER = "documents_processed, user_name"
OUTLIERS = f"(SELECT *, CASE WHEN CAST(substr(user_name, 2) AS int) % 3 = 0 THEN -1 ELSE 1 END AS prediction FROM {USERS})"


def _outliers(t):
    marked = F.when(F.substring("user_name", 2, 20).cast("int") % 3 == 0, -1).otherwise(1)
    return E.user_stats(t.user_efficiency).withColumn("prediction", marked)


@query("m32_needs_training", f"""
SELECT user_name, role, round(documents_processed, 4) AS documents_processed FROM {OUTLIERS}
WHERE prediction = -1 AND documents_processed < (SELECT median(documents_processed) FROM {USERS})""")
def _(t):
    return V.needs_training(_outliers(t)).select("user_name", "role", "documents_processed")


@query("m33_recommendations", f"""
SELECT user_role AS subject, CASE error_type WHEN 'permission_error' THEN 'training' ELSE 'code_fix' END AS type,
  total_errors AS errors
FROM {ROLE_ERRORS} WHERE rank = 1 AND total_errors > 50 AND error_type IN ('permission_error', 'division_by_zero')
UNION ALL
SELECT * FROM (SELECT user_name, 'individual_training', total_errors FROM {USER_ERRORS} ORDER BY total_errors DESC, user_name LIMIT 5)""")
def _(t):
    return V.recommendations(E.errors_by_role(t.error_events), E.users_for_training(t.error_events))


@query("m33_training_messages", f"""
SELECT user_name, role, round(documents_processed, 4) AS documents_processed,
  (SELECT round(max(m), 4) FROM (SELECT department, avg(documents_processed) AS m FROM {USERS} GROUP BY 1)) AS best_cluster_mean
FROM {OUTLIERS} WHERE prediction = -1 AND documents_processed < (SELECT median(documents_processed) FROM {USERS})
ORDER BY {USERS_ORDER} LIMIT 5""")
def _(t):
    users = _outliers(t)
    profile = E.cluster_profile(users, ["documents_processed"], "department")
    best = profile.agg(F.max("avg_documents_processed")).scalar()
    return V.training_messages(V.needs_training(users), best)


SETTINGS = ["ras_processes", "rmng_processes", "rphost_processes"]


@query("m34_settings_report", f"""
WITH c AS ({' UNION ALL '.join(f"SELECT '{s}' AS parameter, avg({s}) AS current, CAST(arg_min({s}, (avg_response_time, test_id)) AS double) AS optimal FROM performance_tests" for s in SETTINGS)}),
r AS (SELECT *, (optimal - current) / current * 100 AS change_pct FROM c)
SELECT parameter, round(current, 4) AS current, optimal, round(change_pct, 4) AS change_pct, round(abs(change_pct) * 0.3, 4) AS impact,
  CASE WHEN abs(change_pct) > 50 THEN 'critical' WHEN abs(change_pct) > 20 THEN 'attention' ELSE 'normal' END AS status,
  round(sum(abs(change_pct) * 0.3) OVER (), 4) AS total_impact FROM r""")
def _(t):
    tests = t.performance_tests
    best = F.struct("avg_response_time", "test_id")
    wide = tests.agg(
        F.array(
            *[
                F.struct(
                    F.lit(s).alias("parameter"),
                    F.avg(s).alias("current"),
                    F.min_by(F.col(s).cast("double"), best).alias("optimal"),
                )
                for s in SETTINGS
            ]
        ).alias("settings")
    )
    return V.settings_report(wide.select(F.inline("settings")))
