"""Benchmark decontamination: q-gram lemma over diagonal bands, banded alignment."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, digest, documents_of, rows_and_texts, slices, small_batches

#: Length of the shared character q-grams.
Q = 12
#: Edits allowed per normalised character of a benchmark item.
EDIT_RATE = 0.07
#: Benchmark characters that are held and sent to the tasks at once; larger benchmarks are searched in blocks.
BLOCK_CHARS = 2_000_000
#: Normalised characters of one document that are searched at once.
WINDOW = 1 << 18
#: Text bytes that a task searches at once; the arrays made of them are some fifty times as large.
SEARCH_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 20
ITEM_COLUMNS = "doc_id long, digest long, item_id long, start long, end long, edits int, budget int"


def _fold() -> np.ndarray:
    """Normal form of each code point of the basic plane: lower case letters and digits, everything else a space."""
    table = np.arange(0x10000, dtype=np.uint32)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        low = chr(c).lower()
        table[c] = (ord(low) if len(low) == 1 else c) if chr(c).isalnum() else 32
    return table


class Normaliser:
    """Normalised code points of texts and their places in the original."""

    def __init__(self):
        self.table = _fold()

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        folded = np.where(points < 0x10000, self.table[np.minimum(points, 0xFFFF)], points)
        space = folded == 32
        keep = ~space
        keep[1:] |= space[1:] & ~space[:-1]
        at = np.nonzero(keep)[0]
        return folded[at], at


def points_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def grams(points: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams, by doubling: a window's hash is its halves' combined."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    one = (points.astype(np.uint64) + np.uint64(1)) * BASE
    one ^= one >> np.uint64(29)
    out, width, power, factor = None, 0, one, int(BASE)
    size = 1
    while True:
        if q & size:
            n = len(points) - width - size + 1
            out = power[:n].copy() if out is None else out[:n] * np.uint64(factor) + power[width : width + n]
            width += size
        if 2 * size > q:
            return out * BASE
        n = len(power) - size
        power = power[:n] * np.uint64(factor) + power[size : size + n]
        size, factor = 2 * size, factor * factor & (1 << 64) - 1


@dataclass
class Benchmark:
    """Items of one block: normal forms, budgets and postings of their q-grams."""

    ids: np.ndarray
    items: list[np.ndarray]
    q: int
    rate: float

    def __post_init__(self):
        size = np.array([len(x) for x in self.items], np.int64)
        self.size = size
        # the lemma says something only while the bound is positive
        self.budget = np.minimum((self.rate * size).astype(np.int64), (size - self.q) // self.q)
        self.bound = size - self.q + 1 - self.budget * self.q
        found = [grams(x, self.q) for x in self.items]
        values = np.concatenate([*found, np.zeros(0, np.uint64)])
        item = np.repeat(np.arange(len(found)), [len(g) for g in found])
        at = np.concatenate([*(np.arange(len(g)) for g in found), np.zeros(0, np.int64)])
        order = np.argsort(values, kind="stable")
        self.values, self.item, self.at = values[order], item[order], at[order]
        self.present = np.zeros(1 << FILTER_BITS, bool)
        self.present[self.values >> np.uint64(64 - FILTER_BITS)] = True

    def candidates(self, points: np.ndarray, limits: np.ndarray) -> np.ndarray:
        """(text number, item, first diagonal) of the bands that meet the bound; a diagonal is a place in the text minus one in the item.

        Bands are two steps wide and begin every step, where a step is one
        more than the item's budget, so the diagonals of an occurrence within
        budget, which differ by the budget at most, lie in one band whole.
        Grams are counted for each text apart; those across ``limits`` are in none.
        """
        h = grams(points, self.q)
        hit = np.nonzero(self.present[h >> np.uint64(64 - FILTER_BITS)])[0]
        doc = np.searchsorted(limits, hit, "right") - 1
        inside = (doc >= 0) & (doc < len(limits) - 1)
        inside[inside] = hit[inside] + self.q <= limits[doc[inside] + 1]
        hit, doc = hit[inside], doc[inside]
        h = h[hit]
        low, high = np.searchsorted(self.values, h, "left"), np.searchsorted(self.values, h, "right")
        real = high > low
        hit, doc, low, n = hit[real], doc[real], low[real], (high - low)[real]
        if not len(hit):
            return np.zeros((0, 3), np.int64)
        post = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        item = self.item[post]
        longest = int(self.size.max())
        diagonal = np.repeat(hit, n) - self.at[post] + longest  # not negative
        step = diagonal // (self.budget[item] + 1) + 1
        span = len(points) + longest + 2
        key = (np.repeat(doc, n) * len(self.size) + item) * span + step
        key, count = np.unique(np.concatenate([key, key - 1]), return_counts=True)
        pair, step = key // span, key % span - 1
        doc, item = pair // len(self.size), pair % len(self.size)
        met = count >= self.bound[item]
        return np.column_stack([doc, item, step * (self.budget[item] + 1) - longest])[met]


def banded_alignment(item: np.ndarray, text: np.ndarray, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of ``item`` in ``text`` within ``budget`` edits, by semi-global alignment.

    ``text`` is the band's region already, a few budgets longer than the item.
    Of equal places the first end and the latest start win.
    """
    width = len(text) + 1
    place = np.arange(width)
    cost, origin = np.zeros(width, np.int64), place.copy()
    for i, c in enumerate(item, 1):
        step, step_from = cost + 1, origin.copy()
        swap = cost[:-1] + (text != c)
        better = swap <= step[1:]
        step[1:] = np.where(better, swap, step[1:])
        step_from[1:] = np.where(better, origin[:-1], step_from[1:])
        # gaps in the item run along the row: cost + distance from the cheapest cell to the left
        rank = (step - place) * (2 * width) + (width - step_from)
        best = np.minimum.accumulate(rank)
        cost = best // (2 * width) + place
        origin = width - best % (2 * width)
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    return int(cost[end]), int(origin[end]), end


def matches(bench: Benchmark, points: np.ndarray, limits: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(text number, item, start, end, edits) in normalised ``points``; ``limits`` are the texts' offsets in it."""
    found = []
    for doc, item, diagonal in bench.candidates(points, limits).tolist():
        size, budget = int(bench.size[item]), int(bench.budget[item])
        # too narrow for two places of the item that do not overlap: the lemma's budget is below its size by a factor of q
        lo, hi = diagonal - budget, diagonal + 2 * (budget + 1) + size + budget
        a, b = max(lo, int(limits[doc]), 0), min(hi, int(limits[doc + 1]))
        if b - a < size - budget:
            continue
        got = banded_alignment(bench.items[item], points[a:b], budget)
        if got and got[0] <= budget:
            found.append((doc, item, a + got[1], a + got[2], got[0]))
    return found


def separate(found: set[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Of overlapping places of an item in a text, as overlapping bands and windows see them, the one with fewest edits."""
    best: list[tuple[int, int, int, int, int]] = []
    taken: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for row in sorted(found, key=lambda r: (r[0], r[1], r[4], r[2], r[3])):
        places = taken.setdefault(row[:2], [])
        at = bisect(places, row[2:4])
        if (at == 0 or places[at - 1][1] <= row[2]) and (at == len(places) or row[3] <= places[at][0]):
            places.insert(at, row[2:4])
            best.append(row)
    return sorted(best)


def _search(bench: Benchmark):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normal = Normaliser()
        reach = int((bench.size + 2 * bench.budget).max(initial=0)) + 1
        for batch in slices(batches, limit=SEARCH_BYTES):
            raw, offsets = bytes_of(batch.column("text"))
            points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), "<u4")
            starts = np.append(0, np.cumsum((raw & 0xC0) != 0x80))[offsets]  # code points before each text
            points = np.insert(points, starts[1:], 32)
            starts = starts + np.arange(len(starts))
            folded, at = normal(points)
            limits = np.searchsorted(at, starts)
            rows = set()
            for begin in range(0, max(1, len(folded)), WINDOW):
                part = folded[begin : begin + WINDOW + reach]
                rows.update((d, i, a + begin, b + begin, e) for d, i, a, b, e in matches(bench, part, np.clip(limits - begin, 0, len(part))))
            if not rows:
                continue
            doc, item, a, b, edits = (np.array(c, np.int64) for c in zip(*separate(rows)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)),
                    batch.column("digest").take(pa.array(doc)),
                    pa.array(bench.ids[item]),
                    pa.array(at[a] - starts[doc]),
                    pa.array(at[b - 1] + 1 - starts[doc]),
                    pa.array(edits.astype(np.int32)),
                    pa.array(bench.budget[item].astype(np.int32)),
                ],
                ["doc_id", "digest", "item_id", "start", "end", "edits", "budget"],
            )

    return job


def _blocks(benchmark: DataFrame, q: int, rate: float, block_chars: int) -> Iterator[Benchmark]:
    """The stated query set, block by block: each of about ``block_chars`` characters, one item at least."""
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].cast("string").alias("text"))
    items = items.where("text is not null and item_id is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-2 * total // block_chars) or 1
    normal = Normaliser()
    for block in range(n if total else 0):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).distinct().orderBy("item_id", "text").collect()
        forms = [(r["item_id"], strip(normal(points_of(r["text"]))[0])) for r in rows]
        forms = [(i, f) for i, f in forms if len(f) >= q]
        if forms:
            yield Benchmark(np.array([i for i, _ in forms], np.int64), [f for _, f in forms], q, rate)


def strip(points: np.ndarray) -> np.ndarray:
    inside = np.nonzero(points != 32)[0]
    return points[inside[0] : inside[-1] + 1] if len(inside) else points[:0]


def contaminated_spans(
    docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Places where a benchmark item stands in a document: (doc_id, digest, item_id, start, end, edits, budget).

    Texts are compared as lower case letters and digits with single spaces
    between. An item of m such characters is found wherever it stands within
    ``budget`` edits: ``rate`` times m, or the largest number for which the
    q-gram lemma's bound m - q + 1 - budget * q is positive. Offsets are code
    points of the original text, end exclusive; of overlapping places of one
    item the one with fewest edits stays. Null and empty texts have no place;
    items that are null, lack an id or have fewer than ``q`` characters are not
    searched for. Repeated rows give repeated places.

    Documents never move: the items are the stated query set and travel to the
    tasks in blocks of bounded size.
    """
    rows = documents_of(docs).select("doc_id", digest("text").alias("digest"), "text")
    found = None
    for bench in _blocks(benchmark, q, rate, block_chars):
        part = rows.mapInArrow(_search(bench), ITEM_COLUMNS)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], ITEM_COLUMNS) if found is None else found


def _flag(benches: list[Benchmark], names: list[str]):
    """Rows of documents without any benchmark item, batch by batch."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in rows_and_texts(batches, names):
            view = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(batch.num_rows)), pa.nulls(batch.num_rows, pa.int64()), texts], ["doc_id", "digest", "text"]
            )
            clean = np.ones(batch.num_rows, bool)
            for bench in benches:
                for hit in _search(bench)(iter([view])):
                    clean[hit.column("doc_id").to_numpy()] = False
            kept = batch.filter(pa.array(clean))
            yield pa.RecordBatch.from_arrays([kept.column(c) for c in range(len(names))], names)

    return job


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, q: int = Q, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay as they are.

    Rows are judged where they are read, block of items after block, so
    nothing is shuffled. Null texts are clean.
    """
    small_batches(docs.sparkSession)
    fields = docs.schema
    for bench in _blocks(benchmark, q, rate, block_chars):
        docs = docs.mapInArrow(_flag([bench], fields.names), fields)
    return docs
