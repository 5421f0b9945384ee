"""Log files as DataFrames, in batch and as a stream."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeparts import col

LOG_PATTERN = "*.log"
REPLACEMENT = "�"
SPLIT_BYTES = 128 * 1024 * 1024
GZIP_RATIO = 8


def cleaned(value: str) -> Column:
    """Text without undecodable bytes."""
    return F.replace(F.make_valid_utf8(value), F.lit(REPLACEMENT), F.lit(""))


def _lines(frame: DataFrame) -> DataFrame:
    return frame.select(F.col("_metadata.file_name").alias("file"), cleaned("value").alias("line"))


def _below(spark: SparkSession, pattern: str):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)


def gzip_spread(spark: SparkSession, path: str, pattern: str) -> int:
    """Partitions that give unpacked gzip files the size of a normal split (reads file sizes only)."""
    size = _below(spark, pattern).format("binaryFile").load(path).agg(F.sum("length")).first()[0] or 0
    return max(1, math.ceil(size * GZIP_RATIO / SPLIT_BYTES))


def read_log_lines(
    spark: SparkSession, path: str, pattern: str = LOG_PATTERN, gzip_partitions: int | None = None
) -> DataFrame:
    """Lines of every log below ``path``, plain or gzip, undecodable bytes removed.

    Plain files split by themselves and are parsed where they are read.  A gzip
    file is one task whatever its size, so only those lines are spread out first,
    by row number: copies of one line do not end up together, and a lost task is
    recomputed to the same rows.
    """
    packed_pattern = f"{pattern}.gz"
    plain = _lines(_below(spark, pattern).text(path))
    packed = _lines(_below(spark, packed_pattern).text(path))
    n = gzip_partitions or gzip_spread(spark, path, packed_pattern)
    if n > 1:
        packed = packed.withColumn("_i", F.monotonically_increasing_id()).repartition(n, "_i").drop("_i")
    return plain.unionByName(packed)


def stream_log_lines(
    spark: SparkSession, path: str, pattern: str = "*.{log,log.gz}", max_files: int | None = None
) -> DataFrame:
    """Lines of log files as they appear; the query checkpoint remembers read files."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader.text(path))


def file_event_date(name: str | Column, first_year: int = 1990, last_year: int = 2100) -> Column:
    """Date in a file name: ``yyyyMMdd`` when that gives a plausible year, else ``yyMMddHH``."""
    digits = F.regexp_extract(col(name), r"(\d{8})", 1)

    def at(*pieces) -> Column:
        return F.concat(*pieces).try_cast("date")

    year = F.substring(digits, 1, 4).try_cast("int")
    long_form = at(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2), F.lit("-"), F.substring(digits, 7, 2))
    short_form = at(
        F.lit("20"), F.substring(digits, 1, 2), F.lit("-"), F.substring(digits, 3, 2), F.lit("-"), F.substring(digits, 5, 2)
    )
    return F.when(year.between(first_year, last_year) & long_form.isNotNull(), long_form).otherwise(short_form)


def file_event_hour(df: DataFrame, name: str = "file") -> DataFrame:
    """Add the date and, for hourly file names, the hour encoded in the file name."""
    digits = F.regexp_extract(F.col(name), r"(\d{8})", 1)
    year = F.substring(digits, 1, 4).try_cast("int")
    daily = year.between(1990, 2100) & F.substring(digits, 5, 2).try_cast("int").between(1, 12)
    return df.withColumns(
        {
            "file_date": file_event_date(name),
            "file_hour": F.when(~daily, F.substring(digits, 7, 2).try_cast("int")),
        }
    )
