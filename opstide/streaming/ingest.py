"""Continuous log ingestion, de-duplication and micro-batch upserts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.parsing import SPACE, header_time, parse_lock_lines, parse_session_lines
from ..session import materialise, remove_since, scratch_path, written
from ..sinks.tables import exists, upsert_latest
from ..sources.records import numbered, pieces_of, placed_lines, stitched
from .compaction import FANOUT, Store, compact
from .rollups import View


def session_event_stream(lines: DataFrame) -> DataFrame:
    """Session events of a stream of log lines; parsing is stateless."""
    return parse_session_lines(lines)


def lock_event_stream(lines: DataFrame) -> DataFrame:
    return parse_lock_lines(lines)


def observed_lines(lines: DataFrame, name: str = "parse_stats", line: str = "line") -> DataFrame:
    """Count lines, parsed and blank ones while they pass; the counts appear in the query's progress."""
    text = F.btrim(F.col(line), F.lit(SPACE))
    return lines.observe(
        name,
        F.count(F.lit(1)).alias("lines"),
        F.count(header_time(text)).alias("parsed"),
        F.count_if(text == "").alias("blank"),
    )


def run_deduplicated(
    lines: DataFrame, parse: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, file: str = "file", line: str = "line"
) -> StreamingQuery:
    """Parse every line of a file once, however late it comes again, and append the events below ``path``.

    A line is known by its file and its whole text (256-bit digest, before
    anything is cut). Digests are stored with the events and looked up in the
    touched months only. A replayed batch overwrites its own folder.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        named = batch.withColumn("line_digest", F.sha2(F.concat_ws("\x00", file, line), 256))
        events = parse(named).dropDuplicates(["line_digest"]).withColumn("month", F.date_format("event_date", "yyyy-MM"))
        if exists(spark, path):
            stored = spark.read.parquet(path)
            if "batch" in stored.columns:
                months = [r["month"] for r in events.select("month").distinct().collect()]
                known = stored.where(F.col("batch") != batch_id).where(F.col("month").isin(months))
                events = events.join(known.select("line_digest"), "line_digest", "left_anti")
        events.write.mode("overwrite").partitionBy("month").parquet(f"{path}/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


#: What was read of each file: the number of its lines.
FILE_LINES = View(["file"], highs=["n_lines"])


def stream_placed_lines(
    spark: SparkSession, path: str, pattern: str = "*.{log,log.gz}", max_files: int | None = None
) -> DataFrame:
    """(file, path, block, line) of log files as they appear."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    return placed_lines((reader.option("maxFilesPerTrigger", max_files) if max_files else reader).text(path))


def run_positioned(
    lines: DataFrame, parse: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, fanout: int = FANOUT
) -> StreamingQuery:
    """Parse every record of a file once and append the events below ``path``; a record is known by its file and its place.

    ``lines`` are placed lines. Log files only grow, so what was read of a file
    is one number, its lines: of a file that comes again, from whatever folder,
    only records after that place are new, and equal lines at two places are
    two. Of copies of a file in one batch the longest counts. Wrapped records
    are joined first; one that a file's end cuts off counts as it stands.

    The numbers are stored for each batch and compacted, so a batch reads one
    row per file ever seen and no event. A replayed batch reads the numbers of
    the others and overwrites its own folders.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, f"{path}/_files"
        mark = written()
        pieces = materialise(pieces_of(batch), "log-pieces")
        counts = pieces.groupBy("file", "path").agg(F.sum("lines").alias("n_lines"))
        longest = counts.groupBy("file").agg(F.min_by("path", F.struct(-F.col("n_lines"), "path")).alias("path"), F.max("n_lines").alias("n_lines"))
        longest = materialise(longest, "log-files")
        records = numbered(stitched(pieces), pieces).join(longest.select("file", "path"), ["file", "path"], "left_semi")
        store_of = Store(spark, seen)
        units = [u for u in store_of.units(store_of.current()[1]) if u.level or u.first != batch_id]
        if units:
            known = FILE_LINES.merged(store_of.read(units)).select("file", F.col("high_n_lines").alias("_known"))
            records = records.join(known, "file", "left").where("_known is null or line_no >= _known").drop("_known")
        events = parse(records.drop("path", "block", "first", "lines")).withColumn("month", F.date_format("event_date", "yyyy-MM"))
        events.write.mode("overwrite").partitionBy("month").parquet(f"{path}/batch={batch_id}")
        FILE_LINES.partial(longest).write.mode("overwrite").parquet(f"{seen}/batch={batch_id}")
        compact(spark, seen, FILE_LINES.merged, fanout)
        remove_since(spark, mark)

    return (
        lines.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything available into a Parquet table, restartable from its checkpoint."""
    return (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all available input and return what it wrote."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    run_to_table(stream, path, f"{path}__checkpoint", mode).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def run_upserts(stream: DataFrame, path: str, checkpoint: str, keys: list[str], order: str, partition: str) -> StreamingQuery:
    """Upsert every micro-batch; replaying a batch after a failure leaves the same table."""

    def merge(batch: DataFrame, _: int) -> None:
        upsert_latest(batch, path, keys, order, partition)

    return (
        stream.writeStream.foreachBatch(merge)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
