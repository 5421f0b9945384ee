"""Spelling variants: words at one edit, found through one-edit neighbourhoods in a reduced alphabet."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import documents_of

#: Letters of a word and occurrences of it, at least.
MIN_LETTERS, MIN_COUNT = 6, 5
#: A form is so many times as frequent as its variant, at least.
FACTOR = 5
LETTERS = r"[A-Za-zÀ-ÿ]"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Numbers of symbols to choose from.
FEWEST, MOST = 4, 64
#: Multiplier of the keys of reduced words; equal keys of unlike words only add candidates.
BASE = 0x9E3779B97F4A7C15 | 1
#: Neighbours that a task makes at once, about.
NEIGHBOURS = 1 << 21


def letter_runs(docs: DataFrame, least: int = MIN_LETTERS) -> DataFrame:
    """(doc_id, run): the maximal runs of at least ``least`` letters of every text, A-Z in lower case, one row each."""
    text = F.translate("text", CAPITALS, SMALL)
    runs = F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))
    return documents_of(docs).select("doc_id", F.explode(runs).alias("run"))


def word_counts(words: DataFrame, least: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words that occur ``least`` times or more; counted in the tasks before any row moves."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def symbols_for(words: int) -> int:
    """Symbols of the reduced alphabet: so many that shortest words have more reduced forms than there are words."""
    return min(max(math.ceil(max(words, 1) ** (1 / MIN_LETTERS)), FEWEST), MOST)


def alphabet(counts: DataFrame, symbols: int) -> dict[int, int]:
    """Symbol (from 1) of each letter's code point: letters by frequency in the vocabulary, dealt in turn.

    One row a letter reaches the driver; there are 90 letters of this kind, at
    most 65 536 where other words are given.
    """
    letters = counts.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''").groupBy("letter").count()
    ranked = sorted(letters.collect(), key=lambda r: (-r["count"], r["letter"]))
    return {ord(r["letter"]): n % symbols + 1 for n, r in enumerate(ranked)}


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.append(np.uint64(1), np.full(n, BASE, np.uint64)))


def reduced(words: list[str], symbol: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all words one after another, offsets)."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    letters, place = np.unique(points, return_inverse=True)
    table = np.array([symbol[c] for c in letters.tolist()], np.uint64)
    return (table[place] if len(points) else np.zeros(0, np.uint64)), np.append(0, np.cumsum([len(w) for w in words]))


def keys_of(symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit key of each reduced word: a polynomial of its symbols, which are above zero, so its length counts too."""
    length = np.diff(at)
    place = np.arange(len(symbols)) - np.repeat(at[:-1], length)
    terms = np.append(np.uint64(0), np.cumsum(symbols * _powers(int(length.max(initial=0)))[place]))
    return terms[at[1:]] - terms[at[:-1]]


def neighbour_keys(rows: np.ndarray, symbols: int) -> np.ndarray:
    """Keys of the words (all of one length, a row of symbols each), and of all their one-edit neighbours.

    One row per word: itself, every letter deleted, every letter replaced by
    each other symbol, every symbol inserted at every place.
    """
    n, length = rows.shape
    power = _powers(length + 1)
    before = np.zeros((n, length + 1), np.uint64)  # value of the letters before each place
    np.cumsum(rows * power[:length], axis=1, out=before[:, 1:])
    key = before[:, -1:]
    after = key - before  # value of the letters from each place on
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    signs = np.arange(1, symbols + 1, dtype=np.uint64)
    deleted = before[:, :-1] + after[:, 1:] * inverse
    # the sign that stands there already stands for no change
    replaced = (key - rows * power[:length])[:, :, None] + signs * power[:length, None]
    inserted = (before + after * np.uint64(BASE))[:, :, None] + signs * power[: length + 1, None]
    return np.concatenate([key, deleted, replaced.reshape(n, -1), inserted.reshape(n, -1)], axis=1)


def _keys(symbol: dict[int, int]):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = keys_of(*reduced(batch.column("word").to_pylist(), symbol))
            yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), pa.array(keys.view(np.int64))], ["word", "n", "key"])

    return job


def _neighbours(symbol: dict[int, int], symbols: int):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, at = reduced(batch.column("word").to_pylist(), symbol)
            length = np.diff(at)
            for size in np.unique(length).tolist():
                mine = np.nonzero(length == size)[0]
                step = max(1, NEIGHBOURS // ((2 * size + 2) * (symbols + 1)))
                for begin in range(0, len(mine), step):
                    part = mine[begin : begin + step]
                    rows = flat[at[part][:, None] + np.arange(size)]
                    keys = np.sort(neighbour_keys(rows, symbols), axis=1)
                    new = np.ones(keys.shape, bool)
                    new[:, 1:] = keys[:, 1:] != keys[:, :-1]
                    source = np.repeat(keys_of(rows.ravel(), np.arange(len(part) + 1) * size), new.sum(1))
                    yield pa.RecordBatch.from_arrays([pa.array(source.view(np.int64)), pa.array(keys[new].view(np.int64))], ["source", "key"])

    return job


def near_words(counts: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, near, near_n): all pairs of words that differ by exactly one inserted, deleted or replaced code point, both ways.

    Letters are reduced to ``symbols`` signs (by default as many as
    ``symbols_for`` says for the size of the vocabulary). Words at one edit have
    reduced words at one edit or none, so each finds the other in the full
    neighbourhood of its reduced word. Neighbourhoods of distinct reduced words
    are joined with the reduced vocabulary by key first, then both ends get
    their words, which are verified. ``counts`` has distinct, non-null words.
    """
    symbols = symbols or symbols_for(counts.count())
    symbol = alphabet(counts, symbols)
    words = materialise(counts.mapInArrow(_keys(symbol), "word string, n long, key long"), "reduced-words")
    classes = words.groupBy("key").agg(F.min("word").alias("word"))
    around = classes.select("word").mapInArrow(_neighbours(symbol, symbols), "source long, key long")
    edges = around.join(words.select("key").distinct(), "key")
    left = words.withColumnRenamed("key", "source")
    right = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "key")
    pairs = edges.join(left, "source").join(right, "key")
    return pairs.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def spelling_variants(counts: DataFrame, factor: int = FACTOR, symbols: int | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``counts`` (word, n; distinct, non-null words).

    ``n_near``: number of words at exactly one edit. ``form``: of these the one
    with the largest count, ties to the smallest in code-point order, if it is
    at least ``factor`` times as frequent; else null, as is ``form_n``.
    ``root``: the last word that forms lead to, the word itself without a form.
    An empty vocabulary gives an empty table.
    """
    counts = materialise(counts.select("word", "n"), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("low"), "near"))
    near = near_words(counts, symbols).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    rows = counts.join(near, "word", "left")
    lead = F.col("best").isNotNull() & (-F.col("best.low") >= factor * F.col("n"))
    rows = rows.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(lead, F.col("best.near")).alias("form"),
        F.when(lead, -F.col("best.low")).alias("form_n"),
    )
    rows = materialise(rows, "forms")
    roots = roots_of(rows.where("form is not null").select("word", "form"), _steps(counts, factor))
    rows = rows.join(roots, "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _steps(counts: DataFrame, factor: int) -> int:
    """Forms that can follow one another: each is ``factor`` times as frequent as the one before."""
    most, least = counts.agg(F.max("n"), F.min("n")).first()
    return int(math.log((most or 1) / (least or 1), factor)) + 1 if factor > 1 else 64


def roots_of(forms: DataFrame, steps: int) -> DataFrame:
    """(word, root) for each word with a form: pointers are doubled until they span ``steps`` forms."""
    roots = forms.select("word", F.col("form").alias("root"))
    span = 1
    while span < steps:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialise(roots.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        span *= 2
    return roots
