"""Token ids, packing and binary output: exact round trips and bounds."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_data import *  # noqa: F403
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from opstide.llm import op08_binary as binary
from opstide.llm import op09_packing as packing
from opstide.llm import tokens

REFERENCE = Tokenizer.from_file(tokens.vocabulary_path(tokens.VOCABULARY))
CODER = tokens.BatchTokenizer()


def plain_ids(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from(" \n\t\r\x0b\u00a0\u2003\x85\x1c.,'s1ab\u00e9\u4e2d\U0001f600"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=6))
def test_ids_equal_the_vocabularys_own_library(texts):
    texts = [*texts, "x <|endoftext|>y", "", " "]
    ids, offsets = CODER.encode_batch(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [plain_ids(t) for t in texts]


def test_little_memory_changes_nothing():
    small = tokens.BatchTokenizer(remembered=5)
    for _ in range(3):
        texts = [" ".join(random.choices(["alpha", "beta", "gamma", "delta", "Omega!"], k=20)) for _ in range(10)]
        ids, offsets = small.encode_batch(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [plain_ids(t) for t in texts]


histograms = st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=25)


@settings(max_examples=200, deadline=None)
@given(histograms)
def test_plan_places_every_item(histogram):
    groups = packing.plan(histogram, 60)
    used = Counter()
    for pattern, times in groups:
        assert sum(pattern) <= 60 and times > 0
        for x in pattern:
            used[x] += times
    assert dict(used) == histogram
    total = sum(k * n for k, n in histogram.items())
    big = sum(n for k, n in histogram.items() if k > 30)
    assert -(-total // 60) <= sum(t for _, t in groups) <= max(big, total * 2 // 60 + 1)


def least_bins(items, capacity):
    """Exact by search over small instances."""
    items = sorted(items, reverse=True)
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in set(bins):
            if room >= items[i]:
                rest = list(bins)
                rest.remove(room)
                place(i + 1, [*rest, room - items[i]])
        place(i + 1, [*bins, capacity - items[i]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_reduction_keeps_an_optimal_packing(items):
    fixed, rest = packing.reduce_by_dominance(dict(Counter(items)), 20)
    left = [x for x, n in rest.items() for _ in range(n)]
    assert sum(t for _, t in fixed) + (least_bins(left, 20) if left else 0) == least_bins(items, 20)


def check_pieces(rows, got, capacity):
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    want = Counter()
    for doc_id, text in rows:
        ids = [*plain_ids(text), tokens.END_ID]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) >= first else [0]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            want[doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert want == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [1024, 37])
def test_pack(docs, odd_docs, no_docs, capacity):
    for table in (docs, odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        got = packing.pack(table, capacity).collect()
        n = check_pieces(rows, got, capacity)
        bound = -(-sum(r["length"] for r in got) // capacity)
        assert n <= bound * 1.02 + 1
    assert packing.pack(no_docs, capacity).count() == 0


def test_binary_round_trip(docs, odd_docs, no_docs):
    for table in (docs, odd_docs):
        rows = [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()]
        got = binary.packed_matrices(table, capacity=256, buffer=20_000).collect()
        parts = defaultdict(list)
        assert len({(r["part"], r["sequence"]) for r in got}) == len(got)
        for r in got:
            ids, places, cuts = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["position_ids"], "<u4"), r["cu_seqlens"]
            assert len(ids) == len(places) == r["n_tokens"] == cuts[-1] <= 256 and cuts[0] == 0
            for a, b, doc_id, start in zip(cuts[:-1], cuts[1:], r["doc_ids"], r["starts"]):
                assert places[a:b].tolist() == list(range(b - a))
                parts[doc_id].append((start, ids[a:b].tolist()))
        whole = defaultdict(list)
        for doc_id, text in rows:
            whole[doc_id].append([*plain_ids(text), tokens.END_ID])
        for doc_id, texts in whole.items():
            if len(texts) == 1:
                assert [x for _, p in sorted(parts[doc_id]) for x in p] == texts[0]
            assert Counter(x for _, p in parts[doc_id] for x in p) == Counter(x for t in texts for x in t)
    assert binary.packed_matrices(no_docs).count() == 0


def test_segment_tree_finds_the_tightest_room():
    rng = random.Random(1)
    tree, open_ = binary.CapacityTree(50), Counter()
    for _ in range(3000):
        if open_ and rng.random() < 0.45:
            room = rng.choice(list(open_.elements()))
            open_[room] -= 1
            open_ += Counter()
            tree.add(room, -1)
        else:
            room = rng.randint(0, 50)
            open_[room] += 1
            tree.add(room)
        want = rng.randint(1, 50)
        assert tree.tightest(want) == min((r for r in open_ if r >= want), default=None)
