"""Stored tables: pruned event scans, usage history, training sets, external databases."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import AsOf, as_datetime, within

TRAINING_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType()), T.StructField("hour", T.IntegerType())]
    + [T.StructField(c, T.LongType()) for c in ("sessions", "users", "computers")]
    + [T.StructField(c, T.DoubleType()) for c in ("avg_duration", "p95_duration")]
    + [T.StructField(c, T.LongType()) for c in ("deadlocks", "exceptions", "timeouts")]
    + [T.StructField(c, T.IntegerType()) for c in ("is_weekend", "is_work_hour")]
)


def scan_events(
    spark: SparkSession, path: str, as_of: AsOf, *, days: int | None = None, hours: int | None = None
) -> DataFrame:
    """Events of a look-back window; months outside it are never listed or read."""
    end = as_datetime(as_of)
    start = end - timedelta(days=days or 0, hours=hours or 0)
    months = F.col("event_month").between(int(f"{start:%Y%m}"), int(f"{end:%Y%m}"))
    events = spark.read.parquet(path).filter(months)
    if hours:
        return within(events, "event_datetime", as_of, hours=hours)
    return within(events, "event_date", as_of, days=days)


def usage_history(df: DataFrame, as_of: AsOf, days: int = 60, volumes: list | None = None) -> DataFrame:
    """Daily usage of the last ``days`` days for all volumes, or the given ones."""
    rows = within(df, "date", as_of, days=days).select("date", "volume", "used_gb")
    return rows.filter(F.col("volume").isin(volumes)) if volumes else rows


def write_training(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.parquet(path)


def read_training(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    if fmt == "csv":
        return spark.read.schema(schema or TRAINING_SCHEMA).option("header", "true").csv(path)
    return spark.read.parquet(path)


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str,
    lower: str | int,
    upper: str | int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """External table read in parallel ranges of ``partition_column``."""
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=partition_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
        **(properties or {}),
    )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "append", connections: int = 8, properties=None) -> None:
    """Append to an external table with a bounded number of connections."""
    df.write.format("jdbc").options(
        url=url, dbtable=table, numPartitions=str(connections), **(properties or {})
    ).mode(mode).save()
