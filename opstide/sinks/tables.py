"""Parquet result tables: append, upsert, insert-if-absent, outbox, retention."""

from __future__ import annotations

import uuid
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import AsOf, as_datetime, date_literal

# Stored widths of text columns.
SESSION_WIDTHS = {"user_name": 100, "computer_name": 100, "process_name": 50, "app_name": 50, "raw_line": 1000}
LOCK_WIDTHS = {
    "user_name": 100,
    "process_name": 50,
    "table_name": 200,
    "lock_type": 20,
    "lock_mode": 20,
    "lock_name": 200,
}
# Stored columns of the session and of the lock event table, in order.
SESSION_COLUMNS = [
    "event_date", "event_hour", "event_minute", "event_datetime", "session_id", "user_name", "computer_name",
    "process_name", "app_name", "duration", "lock_wait_time", "lock_time", "is_deadlock", "is_exception",
    "is_timeout", "raw_line",
]
LOCK_COLUMNS = [
    "event_date", "event_hour", "event_minute", "event_datetime", "event_type", "session_id", "transaction_id",
    "user_name", "process_name", "table_name", "lock_type", "lock_mode", "lock_name", "lock_wait_time", "lock_time",
    "dbpid", "raw_line",
]
NUMERIC = {"dbpid", "transaction_id", "session_id", "duration", "lock_wait_time", "lock_time"}

# Days (or months) each table is kept.
RETENTION_MONTHS = {"session_events": 3, "lock_events": 3, "techlog": 6}
RETENTION_DAYS = {"disk_usage": 90, "disk_forecast": 90, "disk_alerts": 180}

# Default thresholds.
THRESHOLDS = [
    ("deadlock_warning", 1.0, "any deadlock is a problem"),
    ("timeout_warning", 10.0, "more than 10 timeouts per hour"),
    ("wait_time_warning", 500000.0, "average wait above 500 ms"),
    ("wait_time_critical", 1000000.0, "average wait above 1 s"),
    ("trend_warning", 50.0, "growth of 50 % within a week"),
    ("trend_critical", 100.0, "growth of 100 % within a week"),
    ("lock_intensity_warning", 1000.0, "more than 1000 locks per minute"),
]


def event_month(day: str = "event_date") -> Column:
    return F.year(day) * 100 + F.month(day)


def _store_form(df: DataFrame, columns: list[str], widths: dict[str, int]) -> DataFrame:
    def one(c: str) -> Column:
        if c not in df.columns:
            return F.lit(0).cast("bigint").alias(c) if c in NUMERIC else F.lit("").alias(c)
        return F.substring(c, 1, widths[c]).alias(c) if c in widths else F.col(c)

    return df.select(*[one(c) for c in columns], event_month().alias("event_month"))


def append_events(df: DataFrame, path: str, order: list[str]) -> None:
    """Append by month; rows sorted inside each file so Parquet statistics prune.

    No repartition by month: one month can hold most of a load, and every task
    writing its own file per month keeps the write balanced.
    """
    df.sortWithinPartitions("event_month", *order).write.mode("append").partitionBy("event_month").option(
        "parquet.bloom.filter.enabled#user_name", "true"
    ).parquet(path)


def append_session_events(df: DataFrame, path: str) -> None:
    append_events(_store_form(df, SESSION_COLUMNS, SESSION_WIDTHS), path, ["event_date", "event_hour", "user_name"])


def append_lock_events(df: DataFrame, path: str) -> None:
    """Lock rows keep no raw line."""
    stored = _store_form(df.withColumn("raw_line", F.lit("")), LOCK_COLUMNS, LOCK_WIDTHS)
    append_events(stored, path, ["event_date", "event_hour", "table_name", "event_type"])


def latest_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Newest row per key, combined map-side so a hot key never lands in one task whole."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


#: Partitions an upsert may touch; a load that touches more reads the table through a join instead of literals.
TOUCHED = 1000


def touched_rows(stored: DataFrame, df: DataFrame, partition: str) -> DataFrame:
    """Stored rows of the partitions that ``df`` has rows in, pruned by literal values."""
    values = [r[0] for r in df.select(partition).distinct().limit(TOUCHED + 1).collect()]
    if len(values) > TOUCHED:
        return stored.join(df.select(partition).distinct(), partition, "left_semi")
    kept = stored.where(F.col(partition).isin([v for v in values if v is not None]))
    return kept.unionByName(stored.where(F.col(partition).isNull())) if None in values else kept


def upsert_latest(df: DataFrame, path: str, keys: list[str], order: str, partition: str = "month") -> None:
    """Merge rows into a table, newest ``order`` wins, a new row over an equally old stored one; only touched
    partitions are read and rewritten.

    ``partition`` must be a function of the key columns, so that all versions of a
    key live in the same partition.
    """
    spark = df.sparkSession
    if not exists(spark, path):
        latest_per_key(df, keys, order).write.partitionBy(partition).parquet(path)
        return
    stored = touched_rows(spark.read.parquet(path).select(*df.columns), df, partition).select(*df.columns)
    both = stored.withColumn("_new", F.lit(0)).unionByName(df.withColumn("_new", F.lit(1)))
    ranked = both.withColumn("_order", F.struct(order, "_new")).drop("_new")
    merged = latest_per_key(ranked, keys, "_order").drop("_order")
    staged = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex[:12]}"
    merged.write.parquet(staged)
    spark.read.parquet(staged).select(*df.columns).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(partition).parquet(path)
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(staged)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def insert_absent(df: DataFrame, path: str, keys: list[str], order: str | None = None, partition: str | None = None) -> None:
    """Append only rows whose key is not stored yet; of duplicate keys the one with the smallest ``order`` (all
    columns, if none is named). With ``partition`` only the stored keys of touched partitions are read."""
    spark = df.sparkSession
    rank = F.struct(*([order] if order else []), *df.columns)
    fresh = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), rank).alias("_row")).select("_row.*")
    if exists(spark, path):
        stored = spark.read.parquet(path)
        stored = touched_rows(stored, df, partition) if partition else stored
        fresh = fresh.join(stored.select(*keys), keys, "left_anti")
    fresh.select(*df.columns).write.mode("append").parquet(path)


def as_json_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text, the form histories are stored in."""

    def one(field: T.StructField) -> Column:
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        return F.to_json(field.name).alias(field.name) if nested else F.col(field.name)

    return df.select(*[one(f) for f in df.schema.fields])


def append_history(df: DataFrame, path: str) -> None:
    as_json_text(df).write.mode("append").parquet(path)


def write_outbox(df: DataFrame, path: str) -> None:
    """Alerts waiting for delivery, one row each, not yet acknowledged."""
    as_json_text(df).withColumn("acknowledged", F.lit(False)).write.mode("append").parquet(path)


def retention_start(as_of: AsOf, table: str) -> date:
    """First day that is still kept for a table."""
    today = as_datetime(as_of).date()
    if table in RETENTION_DAYS:
        return today - timedelta(days=RETENTION_DAYS[table])
    months = today.year * 12 + today.month - 1 - RETENTION_MONTHS[table]
    year, month = divmod(months, 12)
    last = (date(year + (month == 11), (month + 1) % 12 + 1, 1) - timedelta(days=1)).day
    return date(year, month + 1, min(today.day, last))


def keep_recent(df: DataFrame, as_of: AsOf, table: str, day: str = "event_date") -> DataFrame:
    return df.filter(F.col(day) >= date_literal(retention_start(as_of, table)))


def retain(spark: SparkSession, path: str, as_of: AsOf, table: str, day: str = "event_date", partition: str = "event_month") -> None:
    """Apply retention: expired partitions are dropped whole, only the boundary one is rewritten."""
    start = retention_start(as_of, table)
    boundary = start.year * 100 + start.month
    stored = spark.read.parquet(path)
    kept = stored.filter((F.col(partition) == boundary) & (F.col(day) >= date_literal(start)))
    staged = f"{path.rstrip('/')}__staged-{uuid.uuid4().hex[:12]}"
    kept.write.parquet(staged)
    remaining = spark.read.parquet(staged)
    boundary_empty = remaining.isEmpty()
    if not boundary_empty:
        remaining.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{partition}="):
            month = int(name.split("=")[1])
            if month < boundary or (month == boundary and boundary_empty):
                fs.delete(status.getPath(), True)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(staged), True)


def default_thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(THRESHOLDS, "threshold_name string, threshold_value double, threshold_description string")
