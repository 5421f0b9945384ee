"""Toxicity: a learned lexicon's trie met with Levenshtein automata, and scores by context."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import binary_array, bytes_of, documents_of, rows_and_texts, slices, small_batches

#: Terms that are in the lexicon before anything is learned.
SEED_TERMS = ["clown", "disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "trash", "worthless"]
#: Most labelled rows that the lexicon and the weights are fitted on, the first by a hash of doc_id.
FIT_ROWS = 20_000
#: A word joins the lexicon if twice its log-likelihood ratio over distinct contexts reaches this ...
EVIDENCE = 30.0
#: ... and at least this share of its contexts is in toxic documents.
PURITY = 0.8
#: Score from which a document counts as toxic.
THRESHOLD = 0.3
#: Edits allowed for terms of at least so many characters.
EDITS = ((9, 2), (5, 1), (0, 0))
#: Characters before and after a hit that are searched for quotation marks and words that report speech.
CONTEXT = 60
QUOTES = '"“”«»„'
REPORTING = re.compile(r"\b(?:said|says|called|calls|wrote|quoted|term|word|named|titled|book|film)\b[^.!?\n]{0,20}$")
#: What a hit of (edits, quoted) is worth before labels have been seen, and how many documents that belief counts for.
PRIOR = {(0, 0): 0.9, (0, 1): 0.4, (1, 0): 0.6, (1, 1): 0.25, (2, 0): 0.45, (2, 1): 0.2}
PRIOR_ROWS = 2.0
#: How many documents a misspelling of one term must outweigh what misspellings say in general.
POOLED_ROWS = 10.0
#: Text bytes whose words a task holds as Python objects at once; they take some hundred bytes a word.
WORD_BYTES = 1 << 20


# ------------------------------------------------------- trie and automaton
def allowed(term: str | bytes) -> int:
    return next(k for size, k in EDITS if len(term) >= size)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words (of binary arrays: bytes) and each word's offsets into them."""
    data, at = bytes_of(words)
    if not (pa.types.is_string(words.type) or pa.types.is_large_string(words.type)):
        return data, at
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    return points, np.append(0, np.cumsum((data & 0xC0) != 0x80))[at]


class LexiconTrie:
    """Terms as a trie that is walked together with the Levenshtein automata of many words at once."""

    def __init__(self, terms: list[str]):
        self.by_letter = _Trie(terms)
        self.by_byte = _Trie([t.encode() for t in terms])

    def match(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each word the closest term within its edits and the distance; -1 where there is none.

        Edits are of characters; of bytes where the words are binary.
        """
        text = pa.types.is_string(words.type) or pa.types.is_large_string(words.type)
        return (self.by_letter if text else self.by_byte).match(*_letters(words))


class _Trie:
    def __init__(self, terms: list[str] | list[bytes]):
        self.terms = terms
        self.children: list[dict[int, int]] = [{}]
        self.term: list[int] = [-1]
        self.reach: list[int] = [0]  # most edits that a term below allows
        for n, t in enumerate(self.terms):
            at = 0
            for c in t if isinstance(t, bytes) else map(ord, t):
                self.reach[at] = max(self.reach[at], allowed(t))
                if c not in self.children[at]:
                    self.children[at][c] = len(self.term)
                    self.children.append({})
                    self.term.append(-1)
                    self.reach.append(0)
                at = self.children[at][c]
            self.reach[at] = max(self.reach[at], allowed(t))
            self.term[at] = n
        self.sizes = {len(t) + d for t in self.terms for d in range(-allowed(t), allowed(t) + 1)}

    def match(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state of a word's automaton after a trie path is its row of edit distances.

        A word leaves the walk when no entry is within reach. Words of about
        the same length walk together, so a long one does not widen all rows.
        """
        size = np.diff(at)
        term, edits = np.full(len(size), -1, np.int64), np.full(len(size), 99, np.int64)
        chosen = np.nonzero(np.isin(size, list(self.sizes)))[0]
        widths = [24]
        while len(chosen) and widths[-1] < size[chosen].max():
            widths.append(2 * widths[-1])
        for least, most in zip([-1, *widths], widths):
            own = chosen[(size[chosen] > least) & (size[chosen] <= most)]
            if len(own):
                self._walk(data, at, size, own, term, edits)
        return term, edits

    def _walk(self, data: np.ndarray, at: np.ndarray, size: np.ndarray, chosen: np.ndarray, term: np.ndarray, edits: np.ndarray) -> None:
        width = int(size[chosen].max())
        letters = np.zeros((len(chosen), width), data.dtype)
        inside = np.arange(width) < size[chosen][:, None]
        letters[inside] = data[(at[chosen][:, None] + np.arange(width))[inside]]
        # rows beyond a word's end are never read for it
        kind = np.int8 if width < 60 else np.int32
        first = np.broadcast_to(np.arange(width + 1, dtype=kind), (len(chosen), width + 1))
        stack = [(0, np.arange(len(chosen)), first)]
        while stack:
            node, who, row = stack.pop()
            n = self.term[node]
            if n >= 0:
                d = row[np.arange(len(who)), size[chosen[who]]].astype(np.int64)
                better = (d <= allowed(self.terms[n])) & (d < edits[chosen[who]])
                term[chosen[who[better]]] = n
                edits[chosen[who[better]]] = d[better]
            for c, child in self.children[node].items():
                new = np.empty_like(row)
                new[:, 0] = row[:, 0] + 1
                np.minimum(row[:, 1:] + 1, row[:, :-1] + (letters[who] != c), out=new[:, 1:])
                for j in range(1, width + 1):
                    np.minimum(new[:, j], new[:, j - 1] + 1, out=new[:, j])
                alive = new.min(1) <= self.reach[child]
                if alive.any():
                    stack.append((child, who[alive], new[alive]))


#: Code points of scripts that are written without blanks; a word changes where such a letter meets another.
UNSPACED = ((0x0E00, 0x0F00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x2E80, 0x2FE0), (0x3040, 0xA000), (0xF900, 0xFB00), (0xFF66, 0xFFA0))
#: Signs beyond the basic plane that are no letters.
PICTURES = (0x1F000, 0x1FB00)


@lru_cache(1)
def _letter_classes() -> np.ndarray:
    """Of each code point of the basic plane: 0 no letter, 1 letter, digit or mark on a letter, 2 letter of a script without blanks."""
    table = np.zeros(0x10000, np.int8)
    for c in range(0x10000):
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] in "LMN":
            table[c] = 2 if any(low <= c < high for low, high in UNSPACED) else 1
    return table


def _byte_classes(data: np.ndarray) -> np.ndarray:
    """Class of the character that each byte belongs to."""
    table = _letter_classes()
    found = table[np.minimum(data, 0x7F)]
    lead = np.nonzero(data >= 0xC2)[0]
    if len(lead):
        size = 2 + (data[lead] >= 0xE0) + (data[lead] >= 0xF0)
        point = data[lead].astype(np.int64) & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            point[more] = point[more] << 6 | (data[lead[more] + k] & 0x3F)
        kind = np.where(point < 0x10000, table[np.minimum(point, 0xFFFF)], np.where((point >= PICTURES[0]) & (point < PICTURES[1]), 0, 1))
        for k in range(4):
            found[lead[size > k] + k] = kind[size > k]
    return found


def _word_spans(data: np.ndarray, doc_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words: runs of letters, digits and marks of one class, none over two texts.

    Typographic quotes, dashes, dots and blanks beyond ASCII part words as the
    plain ones do, and so does a change to or from a script without blanks.
    """
    kind = np.concatenate([np.zeros(1, np.int8), _byte_classes(data), np.zeros(1, np.int8)])
    cut = kind[1:] != kind[:-1]
    cut[doc_at] = True
    edge = np.nonzero(cut)[0]
    begins, ends = edge[:-1], edge[1:]
    words = kind[begins + 1] > 0
    return begins[words], ends[words]


def quoted(data: np.ndarray, begin: int, end: int, low: int, high: int) -> bool:
    """Whether a hit stands in quotation marks, or just after a word that reports speech, within its document."""
    before = data[max(low, begin - CONTEXT) : begin].tobytes().decode(errors="ignore")
    after = data[end : min(high, end + CONTEXT)].tobytes().decode(errors="ignore")
    opened = sum(before.count(q) for q in QUOTES) % 2 == 1
    return (opened and any(q in after for q in QUOTES)) or bool(REPORTING.search(before))


def _hits(trie: LexiconTrie, texts: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, term, edits, quoted, count) of all hits, one entry per distinct (row, term, edits, quoted)."""
    data, doc_at = bytes_of(pc.utf8_lower(texts))
    begins, ends = _word_spans(data, doc_at)
    if not len(begins):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    every = binary_array(data, np.append(np.column_stack([begins, ends]).ravel(), len(data))).take(pa.array(np.arange(0, 2 * len(begins), 2)))
    coded = every.dictionary_encode()
    term, edits = trie.match(coded.dictionary.cast(pa.string()))
    code = coded.indices.to_numpy()
    hit = np.nonzero(term[code] >= 0)[0]
    row = np.searchsorted(doc_at, begins[hit], "right") - 1
    inq = np.array([quoted(data, int(begins[h]), int(ends[h]), int(doc_at[r]), int(doc_at[r + 1])) for h, r in zip(hit, row)], np.int64)
    cells = np.column_stack([row, term[code[hit]], edits[code[hit]], inq.reshape(-1)]).astype(np.int64)
    cells, count = np.unique(cells, axis=0, return_counts=True)
    return (*cells.T, count)


# ----------------------------------------------------------------------- model
@dataclass
class ToxicityModel:
    """Lexicon, and what each (term, edits, quoted) says about a document that has it."""

    terms: list[str]
    weights: dict[tuple[int, int, int], float] = field(default_factory=dict)
    pooled: dict[tuple[int, int], float] = field(default_factory=lambda: dict(PRIOR))
    base: float = 0.05

    def weight(self, term: int, edits: int, inq: int) -> float:
        return self.weights.get((term, edits, inq), self.pooled[(edits, inq)])

    def learn(self, counts: list[tuple[int, int, int, int, int]]) -> None:
        """From (term, edits, quoted, toxic documents, documents); term -1 counts documents without a finding.

        A cell leans on what all terms say with its edits and quotation, and
        that on the prior.
        """
        for cell in PRIOR:
            own = [(n1, n) for t, e, q, n1, n in counts if t >= 0 and (e, q) == cell]
            self.pooled[cell] = _leaning(sum(a for a, _ in own), sum(n for _, n in own), PRIOR[cell])
        for t, e, q, n1, n in counts:
            if t < 0:
                self.base = min((n1 + 1) / (n + 20), THRESHOLD / 2)
            else:
                self.weights[(t, e, q)] = _leaning(n1, n, self.pooled[(e, q)], POOLED_ROWS if e else PRIOR_ROWS)


def _leaning(n1: int, n: int, belief: float, rows: float = PRIOR_ROWS) -> float:
    return (n1 + rows * belief) / (n + rows)


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their neighbours' digest, once per text."""
    for batch in slices(batches, limit=WORD_BYTES):
        words, marks, toxic = [], [], []
        data, doc_at = bytes_of(pc.utf8_lower(batch.column("text")))
        begins, ends = _word_spans(data, doc_at)
        first, data = np.searchsorted(begins, doc_at), data.tobytes()
        for a, b, flag in zip(first, first[1:], batch.column("toxic").to_pylist()):
            own = [data[i:j].decode() for i, j in zip(begins[a:b].tolist(), ends[a:b].tolist())]
            seen = {(w, hash_of(a, b)) for a, w, b in zip(["", *own], own, [*own[1:], ""]) if len(w) >= 3}
            words += [w for w, _ in seen]
            marks += [m for _, m in seen]
            toxic += [flag] * len(seen)
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(marks, pa.int64()), pa.array(toxic, pa.int32())], ["word", "mark", "toxic"])


def hash_of(a: str, b: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{a}\x00{b}") >> 1


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never used: crc32 of doc_id as text leaves 2 modulo 4."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> ToxicityModel:
    """Lexicon and weights from at most ``fit_rows`` labelled rows that are not held out.

    A word's evidence is counted over its distinct contexts (the words beside
    it), so a passage that many copies repeat counts once. Rows without label,
    doc_id or text teach nothing; without any, the seed terms and priors stay.
    """
    use = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["toxic"].cast("int").alias("toxic"))
    use = use.where("doc_id is not null and toxic in (0, 1)").where(~held_out("doc_id"))
    use = use.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(fit_rows)
    rows = documents_of(docs).join(F.broadcast(use), "doc_id").select("text", "toxic")
    rows = materialise(rows, "toxicity-fit")
    context = rows.mapInArrow(_context_rows, "word string, mark long, toxic int").distinct()
    words = context.groupBy("word").agg(F.sum("toxic").alias("n1"), F.sum(1 - F.col("toxic")).alias("n0"))
    words = materialise(words.where("n1 > 0 or n0 > 0"), "toxicity-words")
    n1, n0 = (float(x or 0) for x in words.agg(F.sum("n1"), F.sum("n0")).first())
    terms = list(SEED_TERMS)
    if n1 and n0:
        share = n1 / (n1 + n0)
        a, b = F.col("n1"), F.col("n0")
        ratio = 2 * (a * F.log(a / (a + b) / share) + F.when(b > 0, b * F.log(b / (a + b) / (1 - share))).otherwise(0.0))
        found = words.where((a > 0) & (a / (a + b) >= PURITY) & (ratio >= EVIDENCE))
        # at 30 the evidence needs seven contexts or more, so the terms are at most a seventh of the fitted contexts
        terms += sorted(r["word"] for r in found.select("word").collect() if r["word"] not in SEED_TERMS)
    model = ToxicityModel(terms)
    cells = materialise(rows.mapInArrow(_cell_rows(model), "term int, edits int, quoted int, toxic int"), "toxicity-cells")
    counts = cells.groupBy("term", "edits", "quoted").agg(F.sum("toxic").alias("n1"), F.count("*").alias("n")).collect()
    model.learn([(r["term"], r["edits"], r["quoted"], r["n1"], r["n"]) for r in counts])
    return model


def _cell_rows(model: ToxicityModel):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = LexiconTrie(model.terms)
        for batch in slices(batches):
            row, term, edits, inq, _ = _hits(trie, batch.column("text"))
            toxic = batch.column("toxic").to_numpy()
            none = np.setdiff1d(np.arange(batch.num_rows), row)
            full = lambda x, v: np.append(x, np.full(len(none), v)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(full(term, -1)), pa.array(full(edits, 0)), pa.array(full(inq, 0)), pa.array(toxic[np.append(row, none).astype(np.int64)])],
                ["term", "edits", "quoted", "toxic"],
            )

    return job


def scores(model: ToxicityModel, trie: LexiconTrie, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(score, number of hits) of each text.

    Findings that speak for abuse (weight one half or more) add up as the
    chance that one of them is; weaker ones count as the strongest of them.
    """
    row, term, edits, inq, count = _hits(trie, texts)
    weight = np.array([model.weight(*x) for x in zip(term.tolist(), edits.tolist(), inq.tolist())], float)
    strong = weight >= 0.5
    clean = np.zeros(len(texts))
    np.add.at(clean, row[strong], np.log1p(-np.minimum(weight[strong], 0.999999)))
    score = np.maximum(-np.expm1(clean), model.base)
    np.maximum.at(score, row, weight)
    hits = np.zeros(len(texts), np.int64)
    np.add.at(hits, row, count)
    return score, hits


def _score_rows(model: ToxicityModel):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = LexiconTrie(model.terms)
        for batch in slices(batches):
            score, hits = scores(model, trie, batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array(hits)], ["doc_id", "score", "hits"])

    return job


def toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits), a row per row of ``docs``.

    ``score`` is between 0 and 1, from the text alone; null and empty texts
    get the score of a text without findings. Rows without doc_id are not held out.
    """
    rows = documents_of(docs).mapInArrow(_score_rows(model), "doc_id long, score double, hits long")
    flag = F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", flag.alias("predicted"), "hits")


def _keep(model: ToxicityModel, threshold: float, names: list[str]):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = LexiconTrie(model.terms)
        for batch, texts in rows_and_texts(batches, names):
            score, _ = scores(model, trie, texts)
            kept = batch.filter(pa.array(score < threshold))
            yield pa.RecordBatch.from_arrays([kept.column(c) for c in range(len(names))], names)

    return job


def drop_toxic(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay as they are.

    Null and empty texts score as texts without findings and stay, repeated
    rows are judged alike, an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    return docs.mapInArrow(_keep(model, threshold, docs.columns), docs.schema)
