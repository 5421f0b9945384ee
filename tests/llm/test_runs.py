"""Periodic runs against a plain search of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_data import *  # noqa: F403

from opstide.llm import op11_runs as R
from opstide.llm import queries as Q


def plain_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= 12:
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, length, q) for (start, length), q in found.items())


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def plain_report(doc_id, text):
    words = plain_words(text)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    last = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *last, sha(listed), sha(" ".join(kept)))


def numbers(words):
    return np.unique(np.array(words, object).astype(str), return_inverse=True)[1].astype(np.int64) if len(words) else np.zeros(0, np.int64)


@pytest.mark.parametrize("appended", [1, 7, 64, 1 << 16])
def test_runs_of_random_words(monkeypatch, appended):
    """Few letters, planted periods, periods with errors, single repeated words; any number of words appended at once."""
    monkeypatch.setattr(R, "APPENDED", appended)
    rng = random.Random(appended)
    for _ in range(60):
        texts = []
        for _ in range(rng.randint(1, 6)):
            k, n = rng.choice([1, 2, 2, 3, 5, 50]), rng.choice([0, 3, 11, 12, 13, 30, 64, 65, 100, 200])
            x = [rng.randrange(k) for _ in range(n)]
            if n > 20 and rng.random() < 0.5:
                a, p = rng.randrange(n - 10), rng.randint(1, 12)
                for i in range(a + p, n):
                    x[i] = x[i - p] if rng.random() < 0.99 else rng.randrange(k)
            texts.append(np.array(x, np.int64))
        for x, found in zip(texts, R.runs_of(texts)):
            assert [tuple(r) for r in found.tolist()] == plain_runs(x.tolist())


def test_runs_of_special_words():
    fib, thue = [0], [0, 1]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    while len(thue) < 512:
        thue += [1 - x for x in thue]
    fib = b[:400]
    long = [i % 700 for i in range(3000)]
    texts = [np.array(x, np.int64) for x in (fib, thue, [5] * 3000, long, [*range(40)] * 2, [*range(40), *range(39)])]
    for x, found in zip(texts, R.runs_of(texts)):
        assert [tuple(r) for r in found.tolist()] == plain_runs(x.tolist())


def test_a_hash_that_deceives_is_noticed(monkeypatch):
    """Under a weak hash wrong stretches appear; they are noticed, never returned."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, 300)
    monkeypatch.setattr(R, "_mix", lambda v: v & np.uint64(3))
    catchers = R.Catchers(len(x), R.reach_of(np.array([len(x)])))
    catchers.append(x)
    catchers.finish()
    assert catchers.runs() is None


def test_run_report(spark, docs, odd_docs, no_docs):
    """Documents with planted periods, odd tables; words apart by every kind of ASCII white space and by no other."""
    extra = spark.createDataFrame(
        [(i, " \t".join(f"w{j % (i + 1)}" for j in range(5 * i)) + " x\x1cy\x0bz\x0c") for i in range(1, 40)] + [(None, "a " * 50), (None, None)],
        "doc_id long, text string",
    )
    for table in (docs.where("length(text) < 6000"), odd_docs.where("doc_id is null or doc_id <> 8"), extra):
        rows = table.select("doc_id", "text").collect()
        got = [tuple(r) for r in R.run_report(Q.with_periods(table)).collect()]
        assert sorted(got, key=repr) == sorted((plain_report(*r) for r in rows), key=repr)
    assert any(r[1] for r in got)
    assert R.run_report(no_docs).count() == 0
    assert R.run_report(odd_docs).count() == odd_docs.count()


def test_collapsed_text(spark):
    text = "so " + "buy now and win " * 5 + "the end of it"
    row = R.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 20, 4)] and row["n_words"] == 25
    assert row["collapsed"] == "so buy now and win the end of it"
