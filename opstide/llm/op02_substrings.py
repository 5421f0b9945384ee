"""Substring dedup: repeated sentences and lines across documents, earliest occurrence kept."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import digest, documents_of, packed_rows, unused

#: UTF-8 bytes that a run of neighbouring repeated units has at least; shorter ones repeat by chance.
MIN_BYTES = 150
#: What ends a unit: a line end and the end of a sentence, a line end, or an empty line.
SENTENCES, LINES, PARAGRAPHS = r"[.!?]+[ \t\r]+|[。！？]+|\n", r"\n", r"\n[^\S\n]*\n\s*"
#: Most units whose first occurrences are broadcast.
HOT = 1000
#: Units held before a task passes them on.
UNITS = 50_000
BLANKS = " \t\r\n"
UNIT_COLUMNS = "doc_id long, digest long, place int, start int, end int, size int, high long, low long"


def normalise(unit: str) -> str:
    """Lower case, single spaces."""
    return " ".join(unit.lower().split())


def _units(separator: str):
    cut = re.compile(separator)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "digest", "place", "start", "end", "size", "high", "low"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(held, kinds)], names)

        held: list[list] = [[] for _ in names]
        for batch in batches:
            for doc_id, mark, text in zip(*(batch.column(c) for c in ("doc_id", "digest", "text"))):
                doc_id, mark, text = doc_id.as_py(), mark.as_py(), text.as_py()
                begin = place = 0
                for after in [*(m.end() for m in cut.finditer(text)), len(text)]:
                    unit = text[begin:after]
                    form = normalise(unit).encode()
                    if form:
                        value = xxhash.xxh3_128_intdigest(form)
                        end = begin + len(unit.rstrip(BLANKS))
                        row = (doc_id, mark, place, begin, end, len(form), (value >> 64) - (1 << 63), (value & (1 << 64) - 1) - (1 << 63))
                        for column, v in zip(held, row):
                            column.append(v)
                        place += 1
                    begin = after
                if len(held[0]) >= UNITS:
                    yield out()
                    held = [[] for _ in names]
        if held[0]:
            yield out()

    return job


def repeated_runs(docs: DataFrame, separator: str = SENTENCES, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Units to remove: (doc_id, digest, run, start, end, kept_doc_id, kept_start).

    ``run`` numbers the stretches of neighbouring repeated units of a document;
    of each at least ``min_bytes`` bytes (normalised UTF-8) repeat.
    """
    rows = documents_of(docs).select("doc_id", digest("text").alias("digest"), "text")
    units = rows.mapInArrow(_units(separator), UNIT_COLUMNS)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "start")
    first = units.groupBy("high", "low").agg(F.min(rank).alias("first"), F.max(rank).alias("rest"), F.count("*").alias("n"))
    first = materialise(first.where("first <> rest").select("high", "low", "first", "n"), "repeated-units")
    total = first.agg(F.sum("n")).first()[0] or 0
    # a unit that makes up a part of 1 / HOT of the repeated ones is hot, so there are at most HOT of them
    hot = first.where(F.col("n") * HOT >= total).select(F.col("high").alias("hot_high"), F.col("low").alias("hot_low"), F.col("first").alias("hot_first"))
    cold = first.where(F.col("n") * HOT < total).select(F.col("high").alias("key"), F.col("low").alias("cold_low"), "first")
    known = units.join(F.broadcast(hot), (units["high"] == hot["hot_high"]) & (units["low"] == hot["hot_low"]), "left")
    # rows of hot units need no partner any more and are dealt evenly
    known = known.withColumn("dealt", F.when(F.col("hot_first").isNotNull(), F.xxhash64("doc_id", "digest", "place")).otherwise(F.col("high")))
    joined = known.join(cold, (known["dealt"] == cold["key"]) & (known["low"] == cold["cold_low"]), "left")
    joined = joined.withColumn("first", F.coalesce("hot_first", "first"))
    again = joined.where(F.col("first").isNotNull() & (rank != F.col("first")))
    again = again.select("doc_id", "digest", "place", "start", "end", "size", "first")
    order = Window.partitionBy("doc_id", "digest").orderBy("place")
    step = F.col("place") - F.lag("place").over(order)  # none for the copy of a repeated row
    again = again.withColumns({"new": F.coalesce(step != 0, F.lit(True)), "begins": F.coalesce(step > 1, F.lit(True)).cast("int")})
    again = again.withColumn("run", F.sum("begins").over(order))
    run = Window.partitionBy("doc_id", "digest", "run")
    again = again.withColumn("bytes", F.sum(F.when(F.col("new"), F.col("size")).otherwise(0)).over(run))
    return again.where(F.col("bytes") >= min_bytes).select(
        "doc_id",
        "digest",
        "run",
        F.col("start").cast("long").alias("start"),
        F.col("end").cast("long").alias("end"),
        F.col("first.doc_id").alias("kept_doc_id"),
        F.col("first.start").cast("long").alias("kept_start"),
    )


def repeated_units(docs: DataFrame, separator: str = SENTENCES, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Units to remove: (doc_id, digest, start, end, kept_doc_id, kept_start).

    A unit is a sentence or a line, with its closing marks and without the
    blanks after it. Offsets are code points of the original text, end
    exclusive. Units are ranked by (doc_id, start), rows without doc_id last and
    among themselves by content; of equal normalised units the first stays,
    inside one document too. The others go where neighbouring ones have
    ``min_bytes`` bytes together, so that a passage is found whatever text
    stands around it, and a sentence that repeats by chance stays. Rows equal in
    doc_id and text are one document. Null and empty texts have no units.

    The rank is a minimum, so equal units meet only as one row per task. Units
    that make up a thousandth of the repeated ones or more, at most a thousand
    of them, are joined back by broadcast, the others by shuffle, so no task
    gets all places of a common line. Runs are formed from the repeated units
    of one document.
    """
    return repeated_runs(docs, separator, min_bytes).drop("run")


def without_repeats(docs: DataFrame, separator: str = SENTENCES, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with ``text`` cut by its repeated runs, and their original (start, end) in order as ``removed``.

    ``removed`` is empty where nothing goes; where the caller has a column of
    that name the new one gets an underscore before it. All other columns stay.
    """
    name = unused(docs, "removed")
    spans = repeated_runs(docs, separator, min_bytes).groupBy("doc_id", "digest", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    cut = spans.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    rows = packed_rows(docs)
    same = rows["doc_id"].eqNullSafe(cut["doc_id"]) & (rows["digest"] == cut["digest"])
    joined = rows.join(cut, same, "left").select("row", "spans")
    text = F.col("row")["text"]

    def between(begin, end) -> F.Column:
        return F.substring(text, begin.cast("int") + 1, (end - begin).cast("int"))

    kept = F.aggregate(
        "spans",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda a, r: F.struct(F.concat(a["out"], between(a["at"], r["start"])).alias("out"), r["end"].alias("at")),
        lambda a: F.concat(a["out"], F.substring(text, a["at"].cast("int") + 1, F.length(text))),
    )
    shorter = F.when(F.col("spans").isNull(), text).otherwise(kept).alias("text")
    columns = [shorter if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    return joined.select(*columns, F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias(name))
