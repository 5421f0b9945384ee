"""SimHash near-duplicates: Golay-decoded segment keys, verification, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import digest, documents_of, packed_rows
from .components import components

SHINGLE = 4
SEED = 42
#: Links have at most this many differing bits; the keys below are built for it.
MAX_BITS = 4
#: Segments of the fingerprint as (first bit, width); each is zero-padded to the code's 23 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Generator polynomial of the binary Golay code (23, 12), x^11+x^10+x^6+x^5+x^4+x^2+1. Fixed value.
GOLAY = 0b110001110101
#: Fingerprints under one key that are compared pair by pair; larger keys go through ``ball_links``.
RUN = 2000


# ---------------------------------------------------------------- fingerprints
def simhash(text: str) -> int:
    """Fingerprint of one text: majority of the bits of its 4-word shingles' XXH64, repeats included."""
    words = text.encode().lower().split()  # bytes: A-Z only, and x20, x09-x0D only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    digest_of = xxhash.xxh64_intdigest
    tail = ends[SHINGLE - 1 :] or ends[-1:]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(tail), 1 << 16):
        part = tail[at : at + (1 << 16)]
        hashes = np.array([digest_of(joined[s : e - 1], SEED) for s, e in zip(starts[at : at + len(part)], part)], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(tail), bitorder="little").tobytes(), "little")


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([simhash(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(found)], ["doc_id", "digest", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, print): the 64-bit fingerprint as a signed long for every row."""
    rows = documents_of(docs).select("doc_id", digest("text").alias("digest"), "text")
    return rows.mapInArrow(_prints, "doc_id long, digest long, print long")


# ------------------------------------------------------------------ Golay keys
@lru_cache(1)
def _decoder() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of each 12-bit high part, and up to six error patterns of weight 4 or less for each syndrome.

    The code is perfect: every syndrome has one pattern of weight 3 or less
    (the nearest codeword). Syndromes whose pattern has weight 3 have five
    more of weight 4.
    """

    def syndrome(x: int) -> int:
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        return x

    single = [syndrome(1 << b) for b in range(23)]
    high = np.zeros(4096, np.int64)
    for b in range(12):
        high[(np.arange(4096) >> b & 1) == 1] ^= single[b + 11]
    patterns = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        for bits in combinations(range(23), weight):
            s = 0
            for b in bits:
                s ^= single[b]
            patterns[s, filled[s]] = sum(1 << b for b in bits)
            filled[s] += 1
    return high, patterns


def codewords(segment: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of nearby codewords, one row of up to six per segment, -1 where there is none.

    Words of even parity name their nearest codeword, words of odd parity all
    codewords within four bits. Two words that differ in at most one bit share
    a codeword: equal words name the same ones; otherwise one of them is even,
    its nearest codeword is at most three bits away, and at most four from the
    odd one.
    """
    high, patterns = _decoder()
    errors = patterns[(segment & 2047) ^ high[segment >> 11]]
    odd = np.zeros(len(segment), bool)
    for b in range(23):
        odd ^= (segment >> b & 1).astype(bool)
    found = (segment[:, None] ^ errors) >> 11
    found[errors < 0] = -1
    found[~odd, 1:] = -1
    return found


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): fingerprints within four bits of each other share a key.

    Four errors over three segments leave either a segment without error (key:
    that segment) or two segments with one error each (key: both segments'
    codewords).
    """
    bits = prints.view(np.uint64)
    parts = [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    rows, keys = [np.arange(len(prints))] * 3, [p | (i << 56) for i, p in enumerate(parts)]
    near = [codewords(p) for p in parts]
    for kind, (i, j) in enumerate(combinations(range(3), 2), 3):
        pair = (near[i][:, :, None] << 12) | near[j][:, None, :]
        ok = (near[i] >= 0)[:, :, None] & (near[j] >= 0)[:, None, :]
        at = np.nonzero(ok.reshape(len(prints), -1))
        rows.append(at[0])
        keys.append(pair.reshape(len(prints), -1)[at] | (kind << 56))
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False)
        rows, keys = keys_of(prints)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(prints[rows])], ["key", "print"])


# ----------------------------------------------------------------------- links
def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _run_links(keys: np.ndarray, prints: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs inside runs of equal keys, compared by offset in the run."""
    left, right = [], []
    for step in range(1, run):
        same = np.nonzero(keys[step:] == keys[:-step])[0]
        if not len(same):
            break
        near = same[_differing(prints[same], prints[same + step]) <= MAX_BITS]
        left.append(prints[near])
        right.append(prints[near + step])
    none = [np.empty(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _links(run: int):
    """Over rows sorted by key, at most ``run`` of a key: verified pairs."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x) for x in _run_links(keys, prints, run)], ["a", "b"])

        keys = prints = np.empty(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            prints = np.concatenate([prints, batch.column("print").to_numpy()])
            # the last run may go on in the next batch
            last = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
            yield out(keys[:last], prints[:last])
            keys, prints = keys[last:], prints[last:]
        yield out(keys, prints)

    return job


def _ball(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    one = [1 << b for b in range(64)]
    masks = np.array([0, *one, *(x | y for x, y in combinations(one, 2))], np.uint64)
    for batch in batches:
        prints = batch.column("print").to_numpy(zero_copy_only=False)
        for at in range(0, len(prints), 200):
            part = prints[at : at + 200]
            centres = (part.view(np.uint64)[:, None] ^ masks).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(centres), pa.array(np.repeat(part, len(masks)))], ["centre", "print"])


def ball_links(prints: DataFrame) -> DataFrame:
    """Links among crowded fingerprints in linear work, as stars.

    Every fingerprint names all 2081 points within two bits. Two of them name
    a common point exactly when they differ in four bits or fewer, so the
    members of a point need no check and one star links them.
    """
    named = prints.mapInArrow(_ball, "centre long, print long")
    low = named.groupBy("centre").agg(F.min("print").alias("b"), F.max("print").alias("top")).where("top > b")
    return named.join(low, "centre").where("print > b").select(F.col("print").alias("a"), "b").distinct()


def near_links(prints: DataFrame, run: int = RUN) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all pairs within four bits.

    ``prints`` has distinct ``print`` values. Keys with up to ``run`` members
    give every verified pair. Members of larger keys never meet in a task:
    keys are counted first, and the members of crowded ones are linked by
    ``ball_links``, which is exact.
    """
    keyed = prints.mapInArrow(_keys, "key long, print long")
    crowded = materialise(keyed.groupBy("key").count().where(F.col("count") > run).select("key"), "crowded-keys")
    crowd = keyed.join(crowded, "key", "left_semi").select("print").distinct()
    rest = keyed.join(crowded, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    pairs = rest.mapInArrow(_links(run), "a long, b long").distinct()
    return pairs.unionByName(ball_links(crowd))


def near_groups(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, digest, print, component): one row per input row.

    ``component`` is a fingerprint that names the group. Equal fingerprints
    are one node, so copies cost nothing; empty texts have fingerprint zero
    and link like any other.
    """
    rows = materialise(fingerprints(docs), "prints")
    nodes = rows.select("print").distinct()
    member = components(near_links(nodes, run)).withColumnRenamed("node", "print")
    return rows.join(member, "print", "left").withColumn("component", F.coalesce("component", "print"))


def simhash_groups(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``fingerprint`` has 16 lowercase hex digits; ``component_id`` is the
    smallest doc_id of the rows linked at four or fewer differing bits, null
    where none of them has one. Null texts count as empty. Repeated rows stay.
    """
    rows = materialise(fingerprints(docs), "prints")
    nodes = materialise(rows.groupBy("print").agg(F.min("doc_id").alias("low")), "nodes")
    member = components(near_links(nodes.select("print"), run)).withColumnRenamed("node", "print")
    member = nodes.join(member, "print", "left").withColumn("component", F.coalesce("component", "print"))
    first = member.groupBy("component").agg(F.min("low").alias("component_id"))
    member = member.select("print", "component").join(first, "component").select("print", "component_id")
    named = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return rows.join(member, "print").select("doc_id", named, "component_id")


def drop_near_duplicates(docs: DataFrame, run: int = RUN) -> DataFrame:
    """Rows of ``docs`` with one document per group: the smallest (doc_id, content), rows without doc_id last.

    All columns stay as they are. Rows equal in doc_id and text are one
    document, of which any one row stays.
    """
    return keep_first(docs, near_groups(docs, run))


def keep_first(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``docs`` that come first in their ``component``; ``groups`` names it for each (doc_id, digest)."""
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")
    keep = groups.groupBy("component").agg(F.min(order).alias("k")).select("k.doc_id", "k.digest")
    rows = packed_rows(docs)
    same = rows["doc_id"].eqNullSafe(keep["doc_id"]) & (rows["digest"] == keep["digest"])
    return rows.join(keep, same, "left_semi").dropDuplicates(["doc_id", "digest"]).select("row.*")
