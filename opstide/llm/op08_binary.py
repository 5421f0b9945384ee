"""Packed token matrices in binary form: best-fit decreasing with a segment tree over capacities."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents_of, slices
from .op09_packing import piece_bounds, with_end
from .tokens import END_ID, VOCABULARY, tokenizer

CAPACITY = 2048
#: Tokens that a task holds before it packs and writes them.
BUFFER_TOKENS = 2 << 20
SCHEMA = (
    "part int, sequence long, n_tokens int, ids binary, position_ids binary, "
    "cu_seqlens array<int>, doc_ids array<long>, starts array<long>"
)


class CapacityTree:
    """Which rooms open sequences have left, as a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, room: int, n: int = 1) -> None:
        at = room + self.size
        while at:
            self.count[at] += n
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least ``length`` that an open sequence has."""
        at = length + self.size
        if self.count[at]:
            return length
        while at > 1:
            if not at & 1 and self.count[at + 1]:  # the right neighbour holds larger rooms
                at += 1
                while at < self.size:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Item numbers of each sequence; items go, longest first, to the fullest sequence that takes them."""
    tree = CapacityTree(capacity)
    by_room: dict[int, list[int]] = {}
    found: list[list[int]] = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        room = tree.tightest(length)
        if room is None:
            found.append([])
            sequence, room = len(found) - 1, capacity
        else:
            sequence = by_room[room].pop()
            tree.add(room, -1)
        found[sequence].append(item)
        by_room.setdefault(room - length, []).append(sequence)
        tree.add(room - length)
    return found


def _rows(part: int, first: int, capacity: int, held: list) -> pa.RecordBatch:
    """One row per sequence of the held (doc_ids, ids, offsets) slices."""
    docs = np.concatenate([d for d, _, _ in held])
    missing = np.concatenate([m for _, m, _ in held])
    ids = np.concatenate([i for _, _, (i, _) in held])
    base = np.cumsum([0, *(len(i) for _, _, (i, _) in held)])
    offsets = np.concatenate([*(o[:-1] + b for (_, _, (_, o)), b in zip(held, base)), base[-1:]])
    row, _, start, length = piece_bounds(offsets, capacity)
    begin = offsets[row] + start
    out: dict[str, list] = {c.split()[0]: [] for c in SCHEMA.split(", ")}
    for n, items in enumerate(best_fit_decreasing(length, capacity)):
        ends = np.cumsum(length[items])
        out["part"].append(part)
        out["sequence"].append(first + n)
        out["n_tokens"].append(int(ends[-1]))
        out["ids"].append(np.concatenate([ids[begin[i] : begin[i] + length[i]] for i in items]).astype("<u4").tobytes())
        out["position_ids"].append(np.concatenate([np.arange(length[i], dtype="<u4") for i in items]).tobytes())
        out["cu_seqlens"].append([0, *ends.tolist()])
        out["doc_ids"].append([None if missing[row[i]] else int(docs[row[i]]) for i in items])
        out["starts"].append(start[items].tolist())
    types = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], list(out))


def _job(vocabulary: str, capacity: int, end_id: int, buffer: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first, held, size = TaskContext.get().partitionId(), 0, [], 0
        coder = tokenizer(vocabulary)
        for batch in slices(batches):
            ids, offsets = with_end(*coder.encode_batch(batch.column("text")), end_id)
            docs = batch.column("doc_id")
            held.append((docs.fill_null(0).to_numpy(), docs.is_null().to_numpy(zero_copy_only=False), (ids, offsets)))
            size += len(ids)
            if size >= buffer:
                yield (rows := _rows(part, first, capacity, held))
                first, held, size = first + rows.num_rows, [], 0
        if held:
            yield _rows(part, first, capacity, held)

    return job


def packed_matrices(
    docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID, buffer: int = BUFFER_TOKENS
) -> DataFrame:
    """One row per packed sequence of at most ``capacity`` tokens.

    ``ids`` and ``position_ids`` are little-endian unsigned 32-bit rows of the
    packed matrices; ``position_ids`` starts anew at 0 with each segment,
    ``cu_seqlens`` are the segments' cumulative lengths from 0, ``doc_ids`` and
    ``starts`` say which document a segment is of and how many of its ids come
    before. Longer documents are cut without loss; all ids, ``end_id`` after
    each document, come back by ordering the segments of a doc_id by start.
    Null and empty texts are a segment of one id; a null doc_id stays null;
    repeated rows are packed each.

    Each task packs buffers of about ``buffer`` tokens on its own, so nothing
    is shuffled and memory is bounded (by the longest text at least); what is
    lost is at most one partly filled sequence per buffer and the like.
    ``part`` and ``sequence`` name a sequence.
    """
    return documents_of(docs).mapInArrow(_job(vocabulary, capacity, end_id, buffer), SCHEMA)


def write_matrices(docs: DataFrame, path: str, **options) -> None:
    """Write the packed sequences as Parquet below ``path``, one file per task."""
    packed_matrices(docs, **options).write.mode("overwrite").parquet(path)
