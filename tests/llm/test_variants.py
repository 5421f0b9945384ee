"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_data import *  # noqa: F403

from opstide.llm import op13_variants as V
from opstide.llm import queries as Q


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(counts):
    rows, form = {}, {}
    for w, n in counts.items():
        near = [(m, v) for v, m in counts.items() if one_edit(w, v)]
        best = min(near, key=lambda x: (-x[0], x[1]), default=None)
        form[w] = best[1] if best and best[0] >= 5 * n else None
        rows[w] = (n, len(near), best[0] if form[w] else None)

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), *rows[w][:2], rows[w][2] or 0) for w in counts)


def plain_counts(rows):
    low = {c: c + 32 for c in range(65, 91)}
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                count[run] += 1
    return {w: n for w, n in count.items() if n >= 5}


def found(frame):
    return sorted((r["word"], r["form"] or "", r["root"], r["n"], r["n_near"], r["form_n"] or 0) for r in frame.collect())


def vocabulary(seed, size, letters="abcdeéøz"):
    """Words in families of small edits, with counts that fall along chains."""
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 9)))
        n = rng.choice([5, 50, 4000, 100_000])
        for _ in range(rng.randint(1, 8)):
            words.setdefault(w, n)
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            w = w[:i] + ("" if kind == 0 and len(w) > 6 else rng.choice(letters) + (w[i] if kind == 1 else "")) + w[i + 1 :]
            n = max(n // rng.choice([1, 4, 5, 6]), 5)
    return words


@pytest.mark.parametrize("symbols", [None, 1, 2, 5])
def test_variants_against_all_pairs(spark, symbols):
    counts = vocabulary(symbols or 9, 250 if symbols == 1 else 600)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = V.spelling_variants(frame, symbols=symbols)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found(got) == plain_variants(counts)


def test_neighbourhoods_are_whole():
    """Keys of a word's neighbourhood are exactly those of all words at one edit and its own."""
    rng = random.Random(4)
    for size in (1, 2, 6, 7, 20, 40):
        rows = np.array([[rng.randint(1, 3) for _ in range(size)] for _ in range(5)], np.uint64)
        for row, keys in zip(rows, V.neighbour_keys(rows, 3)):
            w = row.tolist()
            near = {tuple(w)} | {tuple(w[:i] + w[i + 1 :]) for i in range(size)}
            near |= {tuple(w[:i] + [s] + w[i + 1 :]) for i in range(size) for s in (1, 2, 3)}
            near |= {tuple(w[:i] + [s] + w[i:]) for i in range(size + 1) for s in (1, 2, 3)}
            flat = np.array([x for v in near for x in v], np.uint64)
            own = V.keys_of(flat, np.append(0, np.cumsum([len(v) for v in near])))
            assert set(keys.tolist()) == set(own.tolist()) and len(set(own.tolist())) == len(near)


def test_long_chains(spark):
    """Fifteen forms in a row."""
    counts = {"a" * (6 + i): 5 ** (i + 1) for i in range(16)}
    got = V.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert found(got) == plain_variants(counts)
    assert {r["root"] for r in got.collect()} == {"a" * 21}


def test_query_words(spark, docs, odd_docs, no_docs):
    for table in (docs, odd_docs):
        counts = V.word_counts(Q.with_slips(V.letter_runs(table)).where("length(word) >= 6"))
        assert {r["word"]: r["n"] for r in counts.collect()} == plain_counts([tuple(r) for r in table.select("doc_id", "text").collect()])
    assert V.spelling_variants(V.word_counts(Q.with_slips(V.letter_runs(no_docs)))).count() == 0


def test_query(spark, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found(Q.op13_spelling_variant_grouping(spark, DATA)) == plain_variants(plain_counts(rows))  # noqa: F405


def test_letter_runs(spark):
    rows = spark.createDataFrame([(1, "Straße ÀÉÎÕÜÞ naïveté×x÷y x1abcdefg Ābcdefgh abcde"), (2, None), (3, "")], "doc_id long, text string")
    assert sorted(r["run"] for r in V.letter_runs(rows).collect()) == sorted(["straße", "ÀÉÎÕÜÞ", "naïveté×x÷y", "abcdefg", "bcdefgh"])
