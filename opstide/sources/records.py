"""Log records that are wrapped over several lines, joined across file splits.

A record begins with a line that has a header time; the lines up to the next
header belong to it. Each task joins the records of the file split it reads
while the lines pass, without a shuffle. What crosses a split's border is one
row per split: the lines before its first header, which belong to the last
record of an earlier split. Only those rows meet the records they complete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .logs import LOG_PATTERN, _below, cleaned, gzip_spread

BLANKS = " \t\r\f\v"
#: First line of a record: date and time of a header, blanks before it.
HEADER = r"^[ \t\r\f\v]*\d{8} \d{2}:\d{2}:\d{2}\.\d{3}"
#: Kinds of pieces: a whole record, what stands before a split's first header, a split's last record, a split without header.
WHOLE, LEAD, LAST, BARE = range(4)
PIECES = "file string, path string, block long, first long, lines long, kind int, line string"


def placed_lines(frame: DataFrame) -> DataFrame:
    """(file, path, block, line) of a text source, batch or stream: ``block`` is where the file split of the line begins."""
    place = [F.col(f"_metadata.{m}").alias(n) for n, m in (("file", "file_name"), ("path", "file_path"), ("block", "file_block_start"))]
    return frame.select(*place, cleaned("value").alias("line"))


class _Joiner:
    """Joins the lines of one split after the other; a record may go on over any number of Arrow batches."""

    def __init__(self):
        self.key = None
        self.out: list[pa.RecordBatch] = []

    def _begin(self, key: tuple) -> None:
        self.key, self.text, self.first, self.seen, self.lead, self.comma = key, [], 0, 0, True, False

    def _emit(self, first, lines, kind: int, texts: pa.Array) -> None:
        n = len(texts)
        file, path, block = self.key
        columns = [pa.array([file] * n), pa.array([path] * n), pa.array([block] * n, pa.int64()), pa.array(first, pa.int64())]
        columns += [pa.array(lines, pa.int64()), pa.array([kind] * n, pa.int32()), texts]
        self.out.append(pa.RecordBatch.from_arrays(columns, ["file", "path", "block", "first", "lines", "kind", "line"]))

    def _close(self, kind: int, end: int) -> None:
        self._emit([self.first], [end - self.first], kind, pa.array(["".join(self.text)], pa.string()))

    def finish(self) -> None:
        """The split has no further line."""
        if self.key is not None:
            self._close(BARE if self.lead else LAST, self.seen)
            self.key = None

    def add(self, key: tuple, line: pa.Array) -> None:
        """Further lines of a split."""
        if key != self.key:
            self.finish()
            self._begin(key)
        n = len(line)
        line = pc.utf8_rtrim(line, characters=BLANKS)
        head = pc.match_substring_regex(line, HEADER).to_numpy(zero_copy_only=False)
        at = np.nonzero(head)[0]
        # a field list that was wrapped after a comma goes on as if it had not been, over blank lines as well;
        # other lines keep their line end
        comma = pc.ends_with(line, ",").to_numpy(zero_copy_only=False)
        filled = np.maximum.accumulate(np.where(pc.equal(line, "").to_numpy(zero_copy_only=False), -1, np.arange(n)))
        comma = np.where(filled >= 0, comma[filled], self.comma)
        after = pa.array(np.append(self.comma, comma[:-1]))
        further = pc.if_else(after, pc.utf8_ltrim(line, characters=BLANKS), pc.binary_join_element_wise("\n", line, ""))
        texts = pc.if_else(pa.array(head), line, further)
        before = int(at[0]) if len(at) else n
        if before:
            parts = texts[:before].to_pylist()
            if not self.seen:
                parts[0] = line[0].as_py()
            self.text += parts
        if len(at):
            self._close(LEAD if self.lead else WHOLE, self.seen + before)
            self.lead = False
            if len(at) > 1:
                records = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), texts)
                self._emit(self.seen + at[:-1], np.diff(at), WHOLE, pc.binary_join(records, ""))
            self.text, self.first = texts[int(at[-1]) :].to_pylist(), self.seen + int(at[-1])
        self.seen += n
        self.comma = bool(comma[-1])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    joiner = _Joiner()
    for batch in batches:
        if not batch.num_rows:
            continue
        path, block = batch.column("path").dictionary_encode().indices.to_numpy(), batch.column("block").to_numpy()
        cuts = np.nonzero((path[1:] != path[:-1]) | (block[1:] != block[:-1]))[0] + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            key = tuple(batch.column(c)[a].as_py() for c in ("file", "path", "block"))
            joiner.add(key, batch.column("line").slice(a, b - a))
        yield from joiner.out
        joiner.out = []
    joiner.finish()
    yield from joiner.out


def pieces_of(lines: DataFrame) -> DataFrame:
    """Pieces of records, joined where the lines are read; ``first`` counts the lines of the split before the piece."""
    return lines.mapInArrow(_pieces, PIECES)


def stitched(pieces: DataFrame) -> DataFrame:
    """Whole records of stored pieces: (file, path, block, first, lines, line).

    A split without any header goes to the last split before it that has one.
    Lines before a file's first header are records of their own, one for each
    split, which no parser accepts, so that they are counted. ``lines`` is what the record has
    in its own split and all later ones.
    """
    by_file = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    owner = F.last(F.when(F.col("kind") == LEAD, F.col("block")), ignorenulls=True).over(by_file)
    borders = pieces.where(F.col("kind").isin(LEAD, BARE))
    owners = borders.select("path", "block", "kind", "lines").withColumn("owner", owner).where("lines > 0").select("path", "block", "owner")
    leads = borders.where("lines > 0").join(owners, ["path", "block"])
    tails = leads.where("owner is not null").groupBy("path", F.col("owner").alias("block")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("block").alias("at"), "line", "lines"))).alias("tail")
    )
    tails = tails.select(F.col("path").alias("_path"), F.col("block").alias("_block"), "tail")

    def further(text: F.Column, tail: F.Column) -> F.Column:
        wrapped = F.concat(text, F.ltrim(tail["line"], F.lit(BLANKS + "\n")))
        return F.when(F.endswith(text, F.lit(",")), wrapped).otherwise(F.concat_ws("\n", text, tail["line"]))

    last = pieces.where(F.col("kind") == LAST)
    last = last.join(tails, (last["path"] == tails["_path"]) & (last["block"] == tails["_block"]), "left")
    none = F.array().cast("array<struct<at:bigint,line:string,lines:bigint>>")
    more = F.aggregate(F.coalesce("tail", none), F.lit(0).cast("long"), lambda a, t: a + t["lines"])
    columns = ["file", "path", "block", "first"]
    last = last.select(*columns, (F.col("lines") + more).alias("lines"), F.aggregate(F.coalesce("tail", none), F.col("line"), further).alias("line"))
    whole = pieces.where(F.col("kind") == WHOLE).select(*columns, "lines", "line")
    stray = leads.where("owner is null").select(*columns, "lines", "line")
    return whole.unionByName(last).unionByName(stray)


def numbered(records: DataFrame, pieces: DataFrame) -> DataFrame:
    """Add ``line_no``: the place of the record's first line in its file, from 0."""
    counts = pieces.groupBy("path", "block").agg(F.sum("lines").alias("n"))
    earlier = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("path", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return records.join(offsets, ["path", "block"]).withColumn("line_no", F.col("before") + F.col("first")).drop("before")


def records_of(lines: DataFrame) -> DataFrame:
    """Whole records (file, path, block, first, lines, line) of placed lines.

    The pieces are written once: a second reading might cut the files into
    other splits, and parsers that read records several times find them joined.
    """
    return stitched(materialise(pieces_of(lines), "log-pieces"))


def read_log_records(spark: SparkSession, path: str, pattern: str = LOG_PATTERN, gzip_partitions: int | None = None) -> DataFrame:
    """(file, line): the records of every log below ``path``, plain or gzip, each as one line.

    A gzip file is one split, so its records are whole where they are read;
    they are spread out afterwards, as lines are by ``read_log_lines``. A
    record must fit into a task.
    """
    plain = records_of(placed_lines(_below(spark, pattern).text(path))).select("file", "line")
    packed_pattern = f"{pattern}.gz"
    packed = pieces_of(placed_lines(_below(spark, packed_pattern).text(path))).where("lines > 0").select("file", "line")
    n = gzip_partitions or gzip_spread(spark, path, packed_pattern)
    if n > 1:
        packed = packed.withColumn("_i", F.monotonically_increasing_id()).repartition(n, "_i").drop("_i")
    return plain.unionByName(packed)
