"""Toxicity: the automaton against plain edit distance, context, and held-out accuracy."""

import random
import zlib

import pyarrow as pa
import pytest
import regex
from llm_data import *  # noqa: F403

from opstide.llm import op05_toxicity as tox


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_trie_matches_plain_distance():
    rng = random.Random(2)
    terms = ["scum", "idiot", "idiots", "worthless", "disgusting", "trash", "vequté"]
    words = set()
    for t in terms:
        for _ in range(120):
            w = list(t.encode())
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(w))
                w[at : at + 1] = rng.choice([[], [rng.choice(b"abciost")], [w[at], rng.choice(b"abciost")]])
                if not w:
                    w = [97]
            words.add(bytes(w))
    words = sorted(words)
    term, edits = tox.LexiconTrie(terms).match(pa.array(words, pa.binary()))
    for w, n, d in zip(words, term, edits):
        fits = [distance(t.encode(), w) for t in terms if distance(t.encode(), w) <= tox.allowed(t.encode())]
        assert (n >= 0) == bool(fits)
        if fits:
            assert d == min(fits) == distance(terms[n].encode(), w)


def score(model, text):
    return tox.scores(model, tox.LexiconTrie(model.terms), pa.array([text]))[0][0]


def test_context_separates_quotation():
    model = tox.ToxicityModel(list(tox.SEED_TERMS))
    assert score(model, "you are an idiot and a fool") >= tox.THRESHOLD
    assert score(model, "you are an idoit, an idi0t and a moronn") >= tox.THRESHOLD
    quoted = score(model, 'the critic used the term "trash" in the review')
    assert quoted < score(model, "this is trash and nothing else") and quoted > score(model, "this is a calm text")
    assert score(model, "") == score(model, "a calm text") < tox.THRESHOLD


def test_rows_of_odd_tables(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(10, 1, 1), (3, 0, 0), (None, 1, 1), (9, None, None), (999, 0, 1)], "doc_id long, quality int, toxic int")
    model = tox.fit(odd_docs, labels)
    got = tox.toxicity(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert r["predicted"] == int(r["score"] >= 0.3)
    assert [r["doc_id"] for r in got if r["predicted"]] == [10]
    kept = tox.drop_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns and sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r["doc_id"] for r in got if not r["predicted"]), key=repr)
    assert tox.toxicity(no_docs, tox.fit(no_docs, labels.where("1 = 0"))).count() == 0


def test_words_do_not_span_texts():
    row, term, edits, inq, count = tox._hits(tox.LexiconTrie(["idiot"]), pa.array(["idi", "ot", "", "idiot", "Idiot idiot"]))
    assert list(row) == [3, 4] and list(count) == [1, 2]


@pytest.mark.parametrize("size", ["sf0.1"])
def test_held_out_accuracy(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{size}/labels.parquet")
    judged = tox.toxicity(docs, tox.fit(docs, labels)).where("held_out").join(labels, "doc_id").collect()
    hit = sum(r["predicted"] and r["toxic"] for r in judged)
    # the small table's other languages have insults that differ from common words by one syllable
    assert hit / sum(r["predicted"] for r in judged) >= 0.75 and hit / sum(r["toxic"] for r in judged) >= 0.85
    english = {r["doc_id"] for r in docs.where("lang = 'en'").select("doc_id").collect()}
    own = [r for r in judged if r["doc_id"] in english]
    hit = sum(r["predicted"] and r["toxic"] for r in own)
    assert hit / sum(r["predicted"] for r in own) >= 0.95 and hit / sum(r["toxic"] for r in own) >= 0.85


def test_long_words_and_letters_beyond_ascii(spark):
    cyrillic, greek, chinese = "бесстыдникамиии", "ανεπαρκής", "愚蠢的人都在这里说话了"
    german = "nichtsnutzigkeitsvertreterin"
    terms = [cyrillic, greek, chinese, german, "дурак"]
    words = [cyrillic, "ж" + cyrillic[1:], cyrillic + "ж", cyrillic[2:], "ж" * 3 + cyrillic[3:], greek[1:], chinese, chinese[1:], german + "s", "дурик", "дуриж", "x" * 5000]
    term, edits = tox.LexiconTrie(terms).match(pa.array(words))
    for w, n, d in zip(words, term, edits):
        fits = [distance(t, w) for t in terms if distance(t, w) <= tox.allowed(t)]
        assert (n >= 0) == bool(fits) and (not fits or d == min(fits))
    model = tox.ToxicityModel(terms)
    assert score(model, f"и вот {cyrillic} снова") >= tox.THRESHOLD and score(model, f"и вот ж{cyrillic[1:]} снова") >= tox.THRESHOLD
    assert score(model, "und die " + german.capitalize() + " kam") >= tox.THRESHOLD


def test_long_words_are_learned(spark):
    word = "бесстыдникамиии" * 2
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"так a{i} {word if i % 2 else 'хорошо'} b{i} конец") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i in ids], "doc_id long, quality int, toxic int")
    assert word in tox.fit(docs, labels).terms


ABUSE = [
    "“idiot”, they said", "«moron» und mehr", "you idiot—go away", "你是idiot吗", "an idiot and more", "idiot…", "İdiot ſcum", "x\U0001f600moron\U0001f600y",
    "ไทยidiotไทย", "naïve idioté", "stupid²", "a’idiot‘b", "idiot" + "́", "word " * 30 + "„trash“ " + "word " * 30,
]


def test_typographic_signs_part_words():
    model = tox.ToxicityModel(list(tox.SEED_TERMS))
    base = score(model, "a calm text")
    for text in ABUSE[:6] + ABUSE[7:9]:
        assert score(model, text) > base
    for text in ("you idiot—go away", "你是idiot吗", "an idiot and more", "idiot…"):
        assert score(model, text) == score(model, "you are an idiot") >= tox.THRESHOLD
    assert score(model, "“idiot”, the word") < score(model, "you are an idiot")
    words = ["ünï", "2", "中文", "x", "क्षि"]
    data, at = tox.bytes_of(pa.array(["ünï–2…中文x “क्षि”\U0001f600", ""]))
    begins, ends = tox._word_spans(data, at)
    assert [data[i:j].tobytes().decode() for i, j in zip(begins, ends)] == words


def plain_score(model, text, near):
    """Score from all words and all terms, one at a time."""
    text = (text or "").replace("İ", "i").lower()  # one letter for one letter
    unspaced = "".join(f"{chr(a)}-{chr(b - 1)}" for a, b in tox.UNSPACED)
    pictures = f"{chr(tox.PICTURES[0])}-{chr(tox.PICTURES[1] - 1)}"
    strong, best = 1.0, model.base
    for m in regex.finditer(rf"(?V1)[[\p{{L}}\p{{M}}\p{{N}}]&&[{unspaced}]]+|[[\p{{L}}\p{{M}}\p{{N}}]--[{unspaced}{pictures}]]+", text):
        if m[0] not in near:
            found = [distance(t, m[0]) for t in model.terms if abs(len(t) - len(m[0])) <= 2 and distance(t, m[0]) <= tox.allowed(t)]
            near[m[0]] = min(found, default=None)
        if near[m[0]] is None:
            continue
        raw = text.encode()
        begin, end = len(text[: m.start()].encode()), len(text[: m.end()].encode())
        before, after = raw[max(0, begin - 60) : begin].decode(errors="ignore"), raw[end : end + 60].decode(errors="ignore")
        quotes = sum(c in tox.QUOTES for c in before) % 2 == 1 and any(c in tox.QUOTES for c in after)
        weight = model.pooled[near[m[0]], int(quotes or bool(tox.REPORTING.search(before)))]
        best = max(best, weight)
        strong *= 1 - min(weight, 0.999999) if weight >= 0.5 and (m[0], weight) else 1
    return best, strong


def test_scores_against_all_terms(docs, odd_docs):
    """One hit after the other; hits of equal term, edits and quotation count once, so only their kinds are compared."""
    model, near = tox.ToxicityModel(list(tox.SEED_TERMS)), {}
    rows = [r["text"] for r in docs.select("text").collect()] + [r["text"] for r in odd_docs.where("doc_id <> 8").collect()] + ABUSE
    got, _ = tox.scores(model, tox.LexiconTrie(model.terms), pa.array([t or "" for t in rows]))
    for text, value in zip(rows, got):
        best, strong = plain_score(model, text, near)
        assert value >= best - 1e-9
        # one strong finding alone scores its weight; more add up to at most what all of them would
        assert value <= max(best, 1 - strong) + 1e-9
        if 1 - strong <= best + 1e-9:
            assert abs(value - best) < 1e-9
