"""Best-fit packing of token pieces after Martello-Toth dominance reduction."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .common import documents_of, slices
from .tokens import END_ID, VOCABULARY, tokenizer

CAPACITY = 1024
#: A group of equal sequences: lengths in order of place, and how many such sequences there are.
Group = tuple[tuple[int, ...], int]


# ------------------------------------------------------------------- planning
def dominant_set(lengths: np.ndarray, counts: np.ndarray, j: int, capacity: int) -> tuple[int, ...] | None:
    """Companions of the item of length ``lengths[j]`` in a set that dominates all its other sets, or None.

    ``lengths`` descends, ``counts`` are the items left (one of j's own is taken
    already). As in Martello and Toth's reduction, sets of at most three items
    are tried: a set dominates another if the other's items can be shared out
    among its items without exceeding any of them.
    """
    free = capacity - int(lengths[j])
    left = np.nonzero(counts > 0)[0]
    fits = left[lengths[left] <= free]
    if not len(fits):
        return ()
    best = int(lengths[fits[0]])
    if best == free:
        return (best,)
    small = np.repeat(lengths[left[::-1][:3]], np.minimum(counts[left[::-1][:3]], 3))[:3]
    if len(small) < 2 or small[:2].sum() > free:
        return (best,)  # one companion at most: the largest
    if len(small) == 3 and small.sum() <= free:
        return None  # sets of four are possible
    values = lengths[fits]
    total = values[:, None] + values[None, :]
    twice = (counts[fits] > 1)[:, None] | ~np.eye(len(values), dtype=bool)
    pairs = np.argwhere((total <= free) & twice & (values[:, None] >= values[None, :]))
    if total[pairs[:, 0], pairs[:, 1]].max() <= best:
        return (best,)
    with_best = pairs[pairs[:, 0] == 0]
    if not len(with_best):
        return None
    second = int(values[with_best[:, 1]].max())
    other = values[pairs]
    covered = (other[:, 1] <= second) | (other.sum(1) <= best)
    return (best, second) if covered.all() else None


def reduce_by_dominance(histogram: dict[int, int], capacity: int) -> tuple[list[Group], dict[int, int]]:
    """Sequences that are fixed for good, and the lengths left over.

    Works on classes of equal length, so its cost depends on the capacity and
    not on the number of items: a dominating set is taken as often as its
    classes allow before the next is sought.
    """
    lengths = np.array(sorted(histogram, reverse=True), np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], np.int64)
    place = {int(x): i for i, x in enumerate(lengths)}
    fixed: list[Group] = []
    changed = True
    while changed:
        changed = False
        for j in range(len(lengths)):
            while counts[j] > 0:
                counts[j] -= 1
                found = dominant_set(lengths, counts, j, capacity)
                counts[j] += 1
                if found is None:
                    break
                pattern = (int(lengths[j]), *found)
                need = defaultdict(int)
                for x in pattern:
                    need[place[x]] += 1
                # the set stays dominant while its classes last, but sets of more items may be ruled out by counts:
                # exact fits and lone items are taken in bulk, others one by one near a class's end
                times = min(int(counts[i]) // n for i, n in need.items())
                if sum(pattern) != capacity and len(found):
                    times = max(1, times - 2)
                for i, n in need.items():
                    counts[i] -= n * times
                fixed.append((pattern, times))
                changed = True
    return fixed, {int(x): int(n) for x, n in zip(lengths, counts) if n}


def best_fit(histogram: dict[int, int], capacity: int) -> list[Group]:
    """Best-fit decreasing over classes: each item goes to the fullest sequence that still takes it."""
    open_: dict[int, list[Group]] = defaultdict(list)  # by room left
    open_[capacity] = []
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            room = min((r for r, groups in open_.items() if r >= length and groups), default=None)
            if room is None:
                per = capacity // length
                pattern, times = (), n // per or 1
                room = capacity
            else:
                pattern, times = open_[room].pop()
                per = room // length
            # an item's sequence stays the fullest that takes the next one, so it is filled before others are begun
            whole = min(times, n // per)
            if whole:
                open_[room - per * length].append((pattern + (length,) * per, whole))
                n -= whole * per
            if whole < times:
                rest = min(n, per - 1)
                used = 0
                if rest and n < per:
                    open_[room - rest * length].append((pattern + (length,) * rest, 1))
                    n -= rest
                    used = 1
                if pattern and times - whole - used:
                    open_[room].append((pattern, times - whole - used))
    return [group for groups in open_.values() for group in groups]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """All sequences as groups: dominance reduction first, best fit for the rest."""
    fixed, rest = reduce_by_dominance(histogram, capacity)
    return fixed + best_fit(rest, capacity)


def slots(groups: list[Group]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first rank, first sequence and offset of its slots, by rank.

    The n-th piece of a length (from 0) belongs to the last slot whose first
    rank is at most n, in sequence ``first sequence + n - first rank``.
    """
    taken: dict[int, int] = defaultdict(int)
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, times in groups:
        offset = 0
        for length in pattern:
            found[length].append((taken[length], sequence, offset))
            taken[length] += times
            offset += length
        sequence += times
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in found.items()}


# -------------------------------------------------------------------- jobs
def piece_bounds(offsets: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document row, piece, start in the document, length): only the first piece may be shorter than ``capacity``."""
    total = np.diff(offsets)
    n = np.maximum(1, -(-total // capacity))
    row = np.repeat(np.arange(len(total)), n)
    piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = total - (n - 1) * capacity
    start = np.where(piece == 0, 0, first[row] + (piece - 1) * capacity)
    return row, piece, start, np.where(piece == 0, first[row], capacity)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end_id`` after each document."""
    out = np.insert(ids, offsets[1:], end_id)
    return out.astype("<u4"), offsets + np.arange(len(offsets))


def _pieces(vocabulary: str, capacity: int, end_id: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(vocabulary)
        for batch in slices(batches):
            ids, offsets = with_end(*coder.encode_batch(batch.column("text")), end_id)
            row, piece, start, length = piece_bounds(offsets, capacity)
            begin = offsets[row] + start
            sums = [zlib.crc32(ids[b : b + n]) for b, n in zip(begin.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array(sums, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return job


def _place(where: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for n in np.unique(length):
                own = length == n
                first, base, at = where[int(n)]
                slot = np.searchsorted(first, rank[own], "right") - 1
                sequence[own] = base[slot] + rank[own] - first[slot]
                offset[own] = at[slot]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return job


def pack(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with their places in packed sequences.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null
    and empty texts are one piece that holds the end id alone. Repeated rows
    are packed each. Nothing but the number of pieces per length (at most
    ``capacity`` rows) reaches the driver; the plan made from it is at most a
    few slots per length and travels with the task. The rank of a piece among
    those of its length is its rank within its part of the stored table plus
    the parts before, so a frequent length never meets in one task.
    """
    pieces = documents_of(docs).mapInArrow(
        _pieces(vocabulary, capacity, end_id), "doc_id long, piece int, start long, length long, ids_crc32 long"
    )
    pieces = materialise(pieces.withColumn("part", F.spark_partition_id()), "pieces")
    sizes = materialise(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-sizes")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    where = slots(plan(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    sizes = sizes.select("length", "part", before.alias("before"))
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.join(sizes, ["length", "part"]).withColumn("rank", F.col("before") + F.row_number().over(order) - 1)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        _place(where),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
