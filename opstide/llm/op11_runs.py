"""Periodic runs of words: dyadic square catchers, squares merged into runs, runs collapsed to one period."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, documents_of, slices

#: Words that a run has at least; it also has two periods at least.
MIN_WORDS = 12
#: Words appended to the catchers at once.
APPENDED = 1 << 16
#: Text bytes that a task works on at once.
RUN_BYTES = 2 << 20
FIRST = np.uint64(0x9E3779B97F4A7C15)
SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(32))) * FIRST
    x = (x ^ (x >> np.uint64(29))) * SECOND
    return x ^ (x >> np.uint64(32))


class Catchers:
    """Online detection of squares in one text to which words are appended.

    For each power of two b, every completed block of b words (at a multiple of
    b) has a catcher. It waits for its own content to come again: an appended
    word ends a suffix of b words, and that suffix is compared with the blocks
    that begin between 2b and 4b words earlier, which are two for each b. Equal
    content at distance q is part of a square of two halves of q words if the
    words around it agree as well. The first half of a square of 2b <= q < 4b
    holds a whole block of b words, so none is missed (b = 1 also waits at
    distance one).

    Catchers of one b that neighbouring blocks set off at the same distance
    merge to one stretch, which is still open as long as each further block
    agrees. When it closes it is extended by less than b words on each side;
    with q agreeing words or more it holds a square and is a run with period q.

    Suffixes are compared by hashes built by doubling. ``runs`` compares the
    found runs word by word; equal words have equal hashes, so a wrong hash can
    only add agreement, which this shows.
    """

    def __init__(self, words: int, reach: np.ndarray, salt: int = 0):
        """``words``: number of words to come. ``reach``: for each b = 1, 2, 4, ... the number of words that can hold its squares."""
        self.n, self.salt = 0, np.uint64(salt)
        self.reach = reach
        self.ids = np.empty(words, np.int64)
        self.hash = [np.empty(max(int(r) - (1 << level) + 1, 0), np.uint64) for level, r in enumerate(reach)]
        self.done = [0] * len(reach)  # hashes known so far
        self.block = [0] * len(reach)  # next block whose catcher is to be asked
        self.open = [np.full(max(2 << level, 3), -1, np.int64) for level in range(len(reach))]  # first block of the open stretch for each distance
        self.found: list[np.ndarray] = []

    def append(self, ids: np.ndarray) -> None:
        """Append words; all catchers are asked about the new suffixes."""
        self.ids[self.n : self.n + len(ids)] = ids
        self.n += len(ids)
        for level in range(len(self.reach)):
            self._hashes(level)
            self._ask(level)

    def _hashes(self, level: int) -> None:
        b, begin = 1 << level, self.done[level]
        end = min(self.n - b + 1, len(self.hash[level]))
        if end <= begin:
            return
        if not level:
            self.hash[0][begin:end] = _mix(self.ids[begin:end].astype(np.uint64) + self.salt)
        else:
            half, low = b // 2, self.hash[level - 1]
            self.hash[level][begin:end] = _mix(low[begin:end] * SECOND + low[begin + half : end + half] + np.uint64(level))
        self.done[level] = end

    def _ask(self, level: int) -> None:
        """Compare the new suffixes with the blocks whose catchers wait for them."""
        b, first = 1 << level, self.block[level]
        near, far = (1, 4) if not level else (2 * b, 4 * b)
        known = self.hash[level][: self.done[level]]
        blocks = (self.done[level] - far) // b + 1  # their farthest suffix has come
        if blocks > first:
            self._merge(level, first, self._hits(known, b, near, far, first, blocks))
            self.block[level] = blocks

    @staticmethod
    def _hits(known: np.ndarray, b: int, near: int, far: int, first: int, last: int) -> np.ndarray:
        """hits[k, d]: the block first + k comes again at distance near + d."""
        view = np.lib.stride_tricks.as_strided(
            known[first * b + near :], (last - first, far - near), (b * known.itemsize, known.itemsize), writeable=False
        )
        return view == known[first * b : (last - 1) * b + 1 : b, None]

    def _merge(self, level: int, first: int, hits: np.ndarray) -> None:
        """Close the stretches that do not go on in ``hits``, whose row 0 is block ``first``; open the new ones."""
        open_, near = self.open[level], 1 if not level else 2 << level
        if not hits.any() and (open_ < 0).all():
            return
        before = np.vstack([(open_ >= 0)[None], hits[:-1]])
        d, k = np.nonzero((hits & ~before).T)
        e, m = np.nonzero((before & ~hits).T)
        # beginnings and ends alternate for each distance, an open stretch supplies its first beginning
        keep = np.nonzero(open_ >= 0)[0]
        begins = np.lexsort((np.append(np.full(len(keep), -1), k), np.append(keep, d)))
        distance = np.append(keep, d)[begins]
        begin = np.append(open_[keep], k + first)[begins]
        still = np.append(distance[1:] != distance[:-1], True) & hits[-1][distance] if len(distance) else np.zeros(0, bool)
        open_[:] = -1
        open_[distance[still]] = begin[still]
        if (~still).any():
            self._close(level, begin[~still], m + first, distance[~still] + near)

    def _close(self, level: int, begin: np.ndarray, end: np.ndarray, q: np.ndarray) -> None:
        """Extend closed stretches (blocks begin to end, exclusive) at distance q, keep those that hold a square."""
        left, right = begin << level, end << level
        for low in range(level - 1, -1, -1):
            size, known = 1 << low, self.hash[low][: self.done[low]]
            at = np.maximum(left - size, 0)
            left = np.where((left >= size) & (known[at] == known[at + q]), left - size, left)
            at = np.minimum(right, len(known) - 1 - q)
            right = np.where((at == right) & (known[at] == known[at + q]), right + size, right)
        square = right - left >= np.maximum(q, MIN_WORDS - q)
        if square.any():
            self.found.append(np.stack([left, right + q, q], 1)[square])

    def finish(self) -> None:
        """No word comes any more: ask about the suffixes that exist, close all stretches."""
        for level in range(len(self.reach)):
            b, known = 1 << level, self.hash[level][: self.done[level]]
            near, far = (1, 4) if not level else (2 * b, 4 * b)
            first = self.block[level]
            last = (len(known) - near - 1) // b + 1  # some suffix at its distance has come
            if last > first:
                hits = np.zeros((last - first, far - near), bool)
                for k in range(first, last):
                    here = known[k * b + near : k * b + far]
                    hits[k - first, : len(here)] = here == known[k * b]
                self._merge(level, first, hits)
                first = last
            self._merge(level, first, np.zeros((1, far - near), bool))

    def runs(self) -> np.ndarray | None:
        """(start, end, period) of all runs, end exclusive; None if a hash has deceived."""
        if not self.found:
            return np.empty((0, 3), np.int64)
        found = np.concatenate(self.found)
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        # a stretch that several distances report has the smallest as period, the others are its multiples
        new = np.append(True, (found[1:, 0] != found[:-1, 0]) | (found[1:, 1] != found[:-1, 1]))
        found = found[new]
        for start, end, q in found.tolist():
            if not np.array_equal(self.ids[start : end - q], self.ids[start + q : end]):
                return None
        return found


def reach_of(lengths: np.ndarray) -> np.ndarray:
    """For texts of these lengths, longest first, one after another: the words that can hold squares of each b."""
    reach, b, total = [], 1, np.append(0, np.cumsum(lengths))
    while True:
        shortest = 2 if b == 1 else 4 * b  # two halves of the smallest distance
        count = int(np.searchsorted(-lengths, -shortest, "right"))
        if not count:
            return np.array(reach, np.int64)
        reach.append(int(total[count]))
        b *= 2


def runs_of(texts: list[np.ndarray]) -> list[np.ndarray]:
    """(start, length, period) of the runs of each text, by start, then period; a text is an array of word numbers.

    The texts are appended one after another, longest first, each closed by a
    word of its own, so that no square crosses two of them.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    order = [i for i in order if len(texts[i]) >= MIN_WORDS]
    out = [np.empty((0, 3), np.int64)] * len(texts)
    if not order:
        return out
    limit = max(int(texts[i].max()) for i in order) + 1
    words = np.concatenate([np.append(texts[i], limit + n) for n, i in enumerate(order)])
    lengths = np.array([len(texts[i]) + 1 for i in order], np.int64)
    at = np.append(0, np.cumsum(lengths))
    found, salt = None, 0
    while found is None:
        catchers = Catchers(len(words), reach_of(lengths), salt)
        for begin in range(0, len(words), APPENDED):
            catchers.append(words[begin : begin + APPENDED])
        catchers.finish()
        found, salt = catchers.runs(), salt + 0x51ED27
    text = np.searchsorted(at, found[:, 0], "right") - 1
    found = np.stack([found[:, 0] - at[text], found[:, 1] - found[:, 0], found[:, 2]], 1)
    rank = np.lexsort((found[:, 2], found[:, 0], text))
    text, found = text[rank], found[rank]
    cut = np.searchsorted(text, np.arange(len(order) + 1))
    for n, i in enumerate(order):
        out[i] = found[cut[n] : cut[n + 1]]
    return out


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space (x20, x09 to x0D)."""
    return text.encode().split()


def numbered(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Numbers of the words; equal words have equal numbers."""
    flat = pa.array([w for words in texts for w in words], pa.binary()).dictionary_encode()
    ids = flat.indices.to_numpy().astype(np.int64)
    at = np.append(0, np.cumsum([len(w) for w in texts])).astype(np.int64)
    return [ids[a:b] for a, b in zip(at, at[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by single spaces."""
    if not len(runs):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    kept = np.nonzero(np.cumsum(depth)[:-1] == 0)[0]
    return b" ".join([words[i] for i in kept.tolist()])


def _job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, limit=RUN_BYTES):
        texts = [words_of(t.as_py()) for t in batch.column("text")]
        found = runs_of(numbered(texts))
        ends = np.append(0, np.cumsum([len(f) for f in found])).astype(np.int32)
        flat = np.concatenate(found)
        fields = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], ["start", "length", "period"])
        short = [collapsed(words, f).decode() for words, f in zip(texts, found)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("digest"),
                pa.array([len(w) for w in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends), fields),
                pa.array(short, pa.string()),
            ],
            ["doc_id", "digest", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, n_words, runs, collapsed), a row per row of ``docs``.

    A run is a stretch of words with smallest period q, of at least
    ``MIN_WORDS`` words and two periods, that cannot be extended keeping it;
    ``runs`` has (start, length, period) by start, then period, in words from 0.
    ``collapsed`` is the text without what runs hold after their first period,
    its words joined by single spaces. Null and empty texts have no words, no
    runs and an empty collapsed text. Repeated rows stay, each with its result;
    an empty table gives an empty one.

    Documents are judged where they are read; nothing is shuffled. A task holds
    the words of one slice of texts (one text at least) and eight bytes for
    each word and power of two below the longest text.
    """
    rows = documents_of(docs).select("doc_id", digest("text").alias("digest"), "text")
    return rows.mapInArrow(_job, f"doc_id long, digest long, n_words long, runs {RUNS}, collapsed string")


def run_report(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: number of runs, the longest one, digests of the run list and of the collapsed text.

    Of equally long runs the one with the smallest start, then period; four
    nulls where there is none. Rows without text have no runs.
    """
    found = periodic_runs(docs)
    best = F.element_at(
        F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))), 1
    )
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.when(F.size("runs") > 0, best).alias("best"), listed.alias("listed"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        (-F.col("best.shorter")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.shorter") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
