"""Shared helpers of the document operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that a Python task works on at once.
SLICE_BYTES = 4 << 20
#: Bytes of rows that Spark hands to a Python task at once, where the session names no other number.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of the session by bytes: ten thousand long texts take much memory in the JVM and in Python.

    A number that the session already names stays.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def documents_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` (long) and ``text`` (null: empty); other columns, whatever their names, are left behind."""
    small_batches(docs.sparkSession)
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )


def digest(column: str | Column) -> Column:
    """64-bit content digest; together with ``doc_id`` it names a row, so rows equal in both count as one document."""
    return F.xxhash64(column)


def packed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, row): ``row`` holds all columns as they are, so that no helper column meets one of the caller's."""
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), digest(text).alias("digest"), F.struct("*").alias("row"))


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with so many underscores before it that no column of ``docs`` is called so."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = offsets_of(batch.column(column))[1:].astype(np.int64)
        begin, base = 0, int(offsets_of(batch.column(column))[0])
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin, base = end, int(ends[end - 1])
        pa.default_memory_pool().release_unused()  # worker processes are used again by later tasks


def rows_and_texts(batches: Iterator[pa.RecordBatch], names: list[str], limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of whole rows, each with its texts (null: empty); the text travels to the task once, in its own column."""
    at = [n.lower() for n in names].index("text")
    for batch in batches:
        texts = pc.fill_null(batch.column(at).cast(pa.string()), "")
        begin = 0
        for part in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), limit=limit):
            yield batch.slice(begin, part.num_rows), part.column("text")
            begin += part.num_rows


def offsets_of(array: pa.Array) -> np.ndarray:
    """Offsets of a string array into its data buffer."""
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    raw = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)
    return raw[array.offset : array.offset + len(array) + 1]


def bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array without nulls, and each row's offsets into them."""
    offsets = offsets_of(array).astype(np.int64)
    data = array.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary array over ``data`` cut at ``offsets``, without copying."""
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )
