"""SimHash groups, chunk fingerprints, components and decontamination against plain Python."""

import hashlib
import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from llm_data import *  # noqa: F403

from opstide.llm import components as comp
from opstide.llm import op06_simhash as sim
from opstide.llm import op07_chunks as chunks
from opstide.llm import op10_decontaminate as decon


def plain_simhash(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows):
    prints = [(d, plain_simhash(t)) for d, t in rows]
    parent = {p: p for _, p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(parent, 2):
        if (a ^ b).bit_count() <= 4:
            parent[root(a)] = root(b)
    low = {}
    for d, p in prints:
        if d is not None:
            low[root(p)] = min(d, low.get(root(p), d))
    return sorted([(d, f"{p:016x}", low.get(root(p))) for d, p in prints], key=repr)


@pytest.mark.parametrize("run", [sim.RUN, 3])
def test_simhash_groups(docs, odd_docs, no_docs, run):
    for table in (docs, odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        got = sim.simhash_groups(table, run)
        assert sorted(map(tuple, got.collect()), key=repr) == plain_groups(rows)
    assert sim.simhash_groups(no_docs, run).count() == 0


def test_every_near_pair_shares_a_key():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 4)):
            b ^= 1 << bit
        both = np.array([a, b], np.uint64).view(np.int64)
        rows, keys = sim.keys_of(both)
        assert set(keys[rows == 0]) & set(keys[rows == 1])


def test_links_of_crowded_fingerprints(spark):
    """Many fingerprints near each other, with small runs so that most go through the ball keys."""
    rng = random.Random(5)
    prints = {0}
    for _ in range(60):
        p = rng.choice(sorted(prints))
        for bit in rng.sample(range(64), rng.randint(1, 6)):
            p ^= 1 << bit
        prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    got = {r["node"]: r["component"] for r in comp.components(sim.near_links(frame, 2)).collect()}
    label = {p: got.get(p, p) for p in signed}
    parent = {p: p for p in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
            parent[root(a)] = root(b)
    for a, b in combinations(signed, 2):
        assert (root(a) == root(b)) == (label[a] == label[b])


def test_drop_near_duplicates(docs, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    kept = sim.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({low for _, _, low in plain_groups(rows)})
    # one row without any id: no group of its own loses it
    assert sorted((r["doc_id"] for r in sim.drop_near_duplicates(odd_docs).collect()), key=repr) == sorted([3, None, 5, 8, 9, 9, 10, 11, 12], key=repr)
    assert sim.drop_near_duplicates(no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (7, 7), (None, 3), (100, 200)]
    got = {r["node"]: r["component"] for r in comp.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}
    assert comp.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------------- chunks
def plain_chunks(data):
    """Byte by byte: the gear hash, the boundary rule, and the chunks."""
    out, start, h = [], 0, 0
    hashes = []
    for b in data:
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        hashes.append(h)
    while start < len(data):
        end = min(start + chunks.GREATEST, len(data))
        for at in range(start + chunks.LEAST - 1, end):
            bits = chunks.STRICT_BITS if at + 1 <= start + chunks.NORMAL else chunks.LOOSE_BITS
            if hashes[at] >> (32 - bits) == 0:
                end = at + 1
                break
        out.append(data[start:end])
        start = end
    return out


def test_chunks_match_plain_python(docs):
    texts = [(r["text"] or "").encode() for r in docs.limit(60).collect()] + [b"", b"x", b"a" * 1000]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    text, begin, end = chunks.chunk_ends(data, offsets)
    for n, t in enumerate(texts):
        got = [bytes(data[a:b]) for a, b in zip(begin[text == n], end[text == n])]
        assert got == plain_chunks(t)
        assert sorted(chunks.chunk_sets([t])[0]["size"].tolist()) == sorted(len(c) for c in set(got))


@pytest.mark.parametrize("buckets", [None, 1, 37])
def test_chunk_fingerprints(docs, odd_docs, no_docs, buckets):
    for table in (docs, odd_docs):
        rows = [(r["doc_id"], r["text"] or "", r["d"]) for r in table.selectExpr("doc_id", "text", "xxhash64(coalesce(text, '')) d").collect()]
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
        want = []
        for (doc_id, text, _), (_, after, _) in zip(rows, rows[1:] + rows[:1]):
            n = len(text) // 4
            changed = text[: len(text) - n] + after[:n]
            sets = [{c: len(c) for c in plain_chunks(t.encode())} for t in (text, changed, after)]
            near = [sum(v for c, v in sets[0].items() if c in s) / sum(sets[0].values()) if sets[0] else float(not s) for s in sets[1:]]
            want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), *near))
        got = chunks.chunk_fingerprints(table, buckets).collect()
        short = [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got]
        assert sorted(short, key=repr) == sorted(want, key=repr)
    assert chunks.chunk_fingerprints(no_docs, buckets).count() == 0


def test_equal_texts_have_equal_fingerprints(docs):
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    by = {}
    for r in chunks.chunk_fingerprints(docs).collect():
        assert by.setdefault(text[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
        assert chunks.fingerprint(chunks.entries_of(r["fingerprint"])) == r["fingerprint"]


# ------------------------------------------------------------- decontamination
def plain_form(text):
    out = []
    for c in text or "":
        low = c.lower() if len(c.lower()) == 1 else c
        out.append(low if c.isalnum() else " ")
    return " ".join("".join(out).split(" ")).strip(), " ".join("".join(out).split())


def plain_edits(item, text):
    """Least edits of ``item`` against any part of ``text``."""
    row = [0] * (len(text) + 1)
    for c in item:
        new = [row[0] + 1]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_decontamination_finds_what_the_budget_allows(spark, odd_docs, no_docs):
    rng = random.Random(9)
    letters = "abcdefghij éß"
    items = ["".join(rng.choice(letters) for _ in range(n)).strip() for n in (40, 60, 120, 200, 13, 11, 30)]
    rows = []
    for n, item in enumerate(items):
        for k in range(12):
            broken = list(item)
            for _ in range(k):
                at = rng.randrange(len(broken))
                broken[at : at + 1] = rng.choice([[], ["z"], [broken[at], "y"]])
            text = "".join(rng.choice(letters) for _ in range(150)) + ". " + "".join(broken).upper() + ", " + "".join(rng.choice(letters) for _ in range(80))
            rows.append((n * 100 + k, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([*enumerate(items), (50, None), (None, items[0]), (51, "")], "item_id long, text string")
    for block in (decon.BLOCK_CHARS, 150):
        got = decon.contaminated_spans(docs, bench, block_chars=block).collect()
        found = {(r["doc_id"], r["item_id"]): r for r in got}
        assert len(found) == len(got)
        for doc_id, text in rows:
            for n, item in enumerate(items):
                form = plain_form(item)[1]
                if len(form) < decon.Q:
                    continue
                budget = min(int(decon.EDIT_RATE * len(form)), (len(form) - decon.Q) // decon.Q)
                edits = plain_edits(form, plain_form(text)[1])
                assert ((doc_id, n) in found) == (edits <= budget)
                if edits <= budget:
                    r = found[doc_id, n]
                    assert r["edits"] == edits and r["budget"] == budget
                    assert plain_edits(form, plain_form(text[r["start"] : r["end"]])[1]) <= budget
    kept = decon.drop_contaminated(docs, bench)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in rows if not any(k[0] == d for k in found))
    assert decon.drop_contaminated(odd_docs, bench).count() == odd_docs.count()
    assert decon.contaminated_spans(no_docs, bench).count() == 0
    assert decon.contaminated_spans(docs, bench.where("1 = 0")).count() == 0 and decon.drop_contaminated(docs, bench.where("1 = 0")).count() == len(rows)


def test_windows_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(decon, "WINDOW", 500)
    item = "the quick brown fox jumps over the lazy dog and runs away from it all day long"
    text = " ".join(f"filler{i}" for i in range(300)) + " " + item + " " + " ".join(f"more{i}" for i in range(300))
    bench = decon.Benchmark(np.array([7]), [decon.points_of(item)], decon.Q, decon.EDIT_RATE)
    import pyarrow as pa

    for shift in range(0, 500, 61):
        body = "x" * shift + " " + text
        batch = pa.RecordBatch.from_pydict({"doc_id": [1], "digest": [2], "text": [body]})
        (found,) = decon._search(bench)(iter([batch]))
        assert found.num_rows == 1 and body[found["start"][0].as_py() : found["end"][0].as_py()] == item


def test_short_items_beside_a_long_one(spark):
    rng = random.Random(12)
    letters = "abcdefghijklm"
    prose = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [prose(4000), prose(81), prose(60)]
    rows = []
    for n in range(200):
        item = items[1 + n % 2] if n % 3 else ""
        rows.append((n, f"{prose(rng.randrange(10, 50))} {item} {prose(rng.randrange(10, 50))}"))
    rows.append((200, f"{items[1]} {prose(40)} {items[1]} {prose(300)} {items[1]} {items[2]} {items[1]}"))
    rows.append((201, f"{items[0]} {prose(50)} {items[0]}"))
    want = sorted((d, i, a) for d, t in rows for i, x in enumerate(items) for a in range(len(t)) if t.startswith(x, a))
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decon.contaminated_spans(docs, bench).collect()
    assert sorted((r["doc_id"], r["item_id"], r["start"]) for r in got) == want
    kept = {r["doc_id"] for r in decon.drop_contaminated(docs, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _, _ in want}
