"""Operator inputs derived from the driver's tables.

Each view is one SQL text shared by Spark and the checking engine; only the few
placeholders in ``DIALECTS`` differ between the two.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

AS_OF = "2024-01-31 00:00:00"
TODAY = "2024-01-31"
ORDERS_AS_OF = "2001-08-01 00:00:00"

DIALECTS = {
    "spark": {
        "k": "CAST(get_json_object(props, '$.k') AS int)",
        "fm": "date_format(ts, 'yyyyMMdd HH:mm:ss.SSS')",
        "hr": "timestampadd(HOUR, hour(ts), CAST(CAST(ts AS date) AS timestamp_ntz))",
        "mon": "trunc(CAST(o_orderdate AS date), 'MM')",
        "nullts": "CAST(NULL AS timestamp_ntz)",
    },
    "duckdb": {
        "k": "CAST(json_extract_string(props, '$.k') AS int)",
        "fm": "strftime(ts, '%Y%m%d %H:%M:%S.%g')",
        "hr": "date_trunc('hour', ts)",
        "mon": "CAST(date_trunc('month', o_orderdate) AS date)",
        "nullts": "CAST(NULL AS timestamp)",
    },
}

VIEWS = {
    "lock_events": """
        SELECT ts AS event_datetime, CAST(ts AS date) AS event_date, CAST(hour(ts) AS int) AS event_hour,
               CAST(minute(ts) AS int) AS event_minute,
               CASE event_type WHEN 'error' THEN 'DEADLOCK' WHEN 'purchase' THEN 'TTIMEOUT'
                    WHEN 'signup' THEN 'SDBL' ELSE 'LOCK' END AS event_type,
               user_id AS session_id, event_id % 1000 AS transaction_id,
               concat('u', CAST(user_id % 50 AS string)) AS user_name,
               concat('proc', CAST(user_id % 4 AS string)) AS process_name,
               CASE WHEN {k} % 10 = 0 THEN '' ELSE concat('_T', CAST({k} % 20 AS string)) END AS table_name,
               CAST(round(value*100) AS bigint)*100 AS lock_wait_time, event_id % 2000 AS lock_time
        FROM events""",
    "session_events": """
        SELECT ts AS event_datetime, CAST(ts AS date) AS event_date, CAST(hour(ts) AS int) AS event_hour,
               CAST(minute(ts) AS int) AS event_minute, user_id AS session_id,
               concat('u', CAST(user_id % 50 AS string)) AS user_name,
               concat('ws-', CAST(user_id % 40 AS string)) AS computer_name,
               CAST(round(value*100) AS bigint)*100 AS duration, event_id % 500 AS lock_wait_time,
               event_id % 2000 AS lock_time,
               CASE WHEN event_type='error' THEN 1 ELSE 0 END AS is_deadlock,
               CASE WHEN {k} % 7 = 0 THEN 1 ELSE 0 END AS is_exception,
               CASE WHEN event_type='purchase' THEN 1 ELSE 0 END AS is_timeout,
               CASE event_type WHEN 'error' THEN 'DEADLOCK' WHEN 'view' THEN 'EXCEPTION' ELSE 'CALL' END AS event_type
        FROM events""",
    "techlog": """
        SELECT ts AS event_datetime, CAST(ts AS date) AS event_date, CAST(hour(ts) AS int) AS hour,
               concat('ctx', CAST({k} AS string)) AS context, user_id AS session,
               concat('u', CAST(user_id % 50 AS string)) AS user_name,
               concat('ws-', CAST(user_id % 40 AS string)) AS computer,
               CAST(round(value*100) AS bigint)*100 AS duration, event_id % 500 AS wait_time,
               (event_id % 2000) * 1000 AS lock_time,
               CASE WHEN event_type='error' THEN concat('x Exception in mod: code ', CAST({k} % 9 AS string))
                    WHEN event_type='view' THEN 'DeadLock seen' ELSE 'ok' END AS raw_line
        FROM events""",
    "session_metrics": """
        SELECT ts AS event_time, CAST(user_id AS string) AS session_id,
               concat('u', CAST(user_id % 50 AS string)) AS user_name,
               CAST(round(value*100) AS bigint)*100 AS duration, event_id % 3 AS lock_time,
               CASE WHEN event_type='error' THEN 'failed' END AS error
        FROM events""",
    "disk_usage": """
        SELECT d AS date, vol AS volume,
               100 + CAST(sum(dv) OVER (PARTITION BY vol ORDER BY d ROWS UNBOUNDED PRECEDING) AS double)/100 AS used_gb
        FROM (SELECT CAST(ts AS date) d, user_id AS vol, sum(CAST(value AS decimal(18,2))) dv
              FROM events GROUP BY CAST(ts AS date), user_id)""",
    "metric_samples": """
        SELECT 'active_sessions' AS metric, event_type AS instance, {hr} AS ts, CAST(count(*) AS double) AS value
        FROM events GROUP BY event_type, {hr}""",
    "slow_queries": """
        SELECT event_id AS query_id, CAST(ts AS date) AS event_date,
               concat('select a from _Acc', CAST({k} AS string), ' join _Inf', CAST({k} % 7 AS string)) AS query_text,
               CAST(round(value*100) AS bigint)*1000 AS duration,
               CASE WHEN {k} % 3 = 0 THEN '' ELSE 'ix' END AS index_used, {k} % 15 AS stats_age_days
        FROM events""",
    "error_events": """
        SELECT doc_id, source AS user_role, concat('u', CAST(doc_id % 50 AS string)) AS user_name,
               text AS error_text, lang AS operation_name
        FROM documents""",
    "operation_log": """
        SELECT o_orderkey AS op_id, CAST(o_orderdate AS date) AS date, o_custkey % 1000 AS documents_count,
               o_orderkey % 5000 AS lines_count, CAST(o_custkey % 300 AS double) AS db_size_gb,
               o_orderpriority AS operation_name, o_totalprice/10000 AS duration_minutes
        FROM orders""",
    "table_stats": """
        SELECT d AS date, t AS table_name,
               CAST(sum(q) OVER (PARTITION BY t ORDER BY d ROWS UNBOUNDED PRECEDING) AS double)/1000 AS size_gb
        FROM (SELECT CAST(l_shipdate AS date) d, concat('_', l_returnflag, l_linestatus) AS t,
                     sum(CAST(l_quantity AS decimal(18,2))) q
              FROM lineitem GROUP BY CAST(l_shipdate AS date), concat('_', l_returnflag, l_linestatus))""",
    "license_stats": """
        SELECT {mon} AS month, count(DISTINCT o_custkey) AS total_users FROM orders GROUP BY {mon}""",
    "support_tickets": """
        SELECT o_orderkey AS ticket_id, CAST(o_orderdate AS date) AS created_date,
               CAST(o_custkey % 24 AS int) AS created_hour, o_orderpriority AS priority,
               o_custkey % 240 AS first_response_time, o_orderkey % 2880 AS resolution_time
        FROM orders""",
    "releases": """
        SELECT o_custkey AS product, CAST(o_orderdate AS date) AS date,
               concat('8.3.', CAST(o_orderkey AS string)) AS version
        FROM orders""",
    "user_efficiency": """
        SELECT concat('u', CAST(user_id AS string)) AS user_name, CAST(ts AS date) AS date,
               count(*) AS documents_processed,
               CAST(sum(CAST(value AS decimal(18,2))) AS double)/count(*) AS avg_time_per_document,
               count(DISTINCT hour(ts)) AS active_hours,
               count(CASE WHEN event_type='error' THEN 1 END) AS error_count,
               concat('dep', CAST(user_id % 4 AS string)) AS department,
               concat('role', CAST(user_id % 6 AS string)) AS role
        FROM events GROUP BY user_id, CAST(ts AS date)""",
    "alerts": """
        SELECT ts, event_type AS alertname, concat('host', CAST({k} % 5 AS string)) AS instance,
               CASE WHEN value > 150 THEN 'critical' WHEN value > 80 THEN 'warning' ELSE 'info' END AS severity, value
        FROM events""",
    "performance_tests": """
        SELECT l_orderkey*10 + l_linenumber AS test_id, CAST(l_quantity AS int) % 8 + 1 AS ras_processes,
               CAST(l_suppkey % 15 + 2 AS int) AS rmng_processes, CAST(l_partkey % 29 + 4 AS int) AS rphost_processes,
               l_extendedprice/100 AS avg_response_time
        FROM lineitem""",
    "log_lines": """
        SELECT event_id, concat({fm}, ',', upper(event_type), ',3,srv,processName=rmngr,userName="u',
               CAST(user_id % 50 AS string), '",computerName="ws-', CAST(user_id % 40 AS string), '",session=',
               CAST(user_id AS string), ',duration=', CAST(CAST(round(value*100) AS bigint)*100 AS string),
               ',lockWaitTime=0,lockTime=', CAST(event_id % 2000 AS string)) AS line
        FROM events""",
    "lock_lines": """
        SELECT event_id, concat({fm}, ' ', CASE event_type WHEN 'error' THEN 'DEADLOCK' WHEN 'purchase' THEN 'TTIMEOUT'
               WHEN 'signup' THEN 'SDBL' WHEN 'view' THEN 'LOCK' ELSE 'CALL' END,
               ',5,processName=rphost,session=', CAST(user_id AS string), ',transaction=', CAST(event_id % 1000 AS string),
               ',userName="u', CAST(user_id % 50 AS string), '",tableName=', CASE WHEN {k} % 2 = 0 THEN '"_T' ELSE '_T' END,
               CAST({k} % 20 AS string), CASE WHEN {k} % 2 = 0 THEN '"' ELSE '' END,
               ',lockType="Row",lockMode=X,lockWaitTime=', CAST(CAST(round(value*100) AS bigint)*100 AS string),
               CASE WHEN {k} % 3 = 0 THEN '' ELSE concat(',dbpid=', CAST({k} AS string)) END) AS line
        FROM events""",
    "legacy_lines": """
        SELECT event_id, concat(substr({fm}, 10, 12), ',duration=', CAST(event_id AS string), ',session=',
               CAST(user_id AS string), ',user="u', CAST(user_id % 50 AS string), '",waitTime=', CAST({k} AS string),
               ',session=', CAST(user_id + 1 AS string),
               CASE WHEN {k} % 4 = 0 THEN '' ELSE ',context="form"' END) AS line
        FROM events""",
}


@lru_cache(maxsize=None)
def view_sql(name: str, dialect: str) -> str:
    text = VIEWS[name]
    for key, value in DIALECTS[dialect].items():
        text = text.replace("{" + key + "}", value)
    return text


def with_views(sql: str) -> str:
    """Prefix the checking SQL with the views it mentions, as common table expressions."""
    words = set(re.findall(r"\w+", sql))
    ctes = [f"{name} AS ({view_sql(name, 'duckdb')})" for name in VIEWS if name in words]
    body = sql.strip()
    recursive = re.match(r"WITH\s+RECURSIVE\s", body, re.I)
    plain = re.match(r"WITH\s", body, re.I)
    if recursive:
        return f"WITH RECURSIVE {', '.join([*ctes, body[recursive.end():]])}"
    if plain:
        return f"WITH {', '.join([*ctes, body[plain.end():]])}"
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


class Inputs:
    """Lazily bound tables and views of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.sf_dir}/{table}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in VIEWS:
            return self.view(name)
        raise AttributeError(name)

    def view(self, name: str, **replacements: DataFrame) -> DataFrame:
        """A view over the tables, or over given replacements (such as a stream)."""
        text = view_sql(name, "spark")
        for table in ("events", "documents", "orders", "lineitem"):
            if re.search(rf"\bFROM {table}\b", text):
                df = replacements.get(table)
                source = getattr(self, table) if df is None else df
                marked = re.sub(rf"\bFROM {table}\b", f"FROM {{{table}}}", text)
                return self.spark.sql(marked, **{table: source})
        raise KeyError(name)
