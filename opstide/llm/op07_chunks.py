"""Document fingerprints: content-defined chunks by a normalised gear hash, and containment."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import digest, documents_of, slices

#: Least, normal and greatest bytes of a chunk.
LEAST, NORMAL, GREATEST = 16, 48, 255
#: Hash bits that must be zero at a boundary before and after the normal size.
STRICT_BITS, LOOSE_BITS = 6, 4
REACH = 32
ENTRY = np.dtype([("digest", ">u4"), ("size", "u1")])
SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _random(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=np.uint64)


GEAR = (_random(256, 7) >> np.uint64(32)).astype(np.uint32)
LETTER = _random(256, 11)
STEP = np.uint64(0x9E3779B97F4A7C15)
STEP_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, begin, end) of all chunks of the texts that lie one after another in ``data``, text by text.

    The gear hash at a byte depends on the 32 bytes up to it, within its text.
    A chunk ends at the first strict boundary between the least and the normal
    size, else at the first loose one up to the greatest, else there.
    """
    sizes = np.diff(offsets)
    texts = np.nonzero(sizes)[0]
    if not len(texts):
        none = np.zeros(0, np.int64)
        return none, none, none
    # silent places before each text keep its hashes apart from the text before
    place = np.arange(len(data)) + REACH * np.repeat(np.arange(len(sizes)), sizes)
    rolled = np.zeros(len(data) + REACH * len(sizes), np.uint32)
    rolled[place] = GEAR[data]
    width = 1
    while width < REACH:
        later = rolled.copy()
        later[width:] += rolled[:-width] << np.uint32(width)
        rolled, width = later, 2 * width
    top = rolled[place]
    strict = np.nonzero(top >> np.uint32(32 - STRICT_BITS) == 0)[0]
    loose = np.nonzero(top >> np.uint32(32 - LOOSE_BITS) == 0)[0]
    far = np.append(strict, len(data) + GREATEST), np.append(loose, len(data) + GREATEST)
    found = []
    at, limit = offsets[texts], offsets[texts + 1]
    while len(texts):
        end = np.minimum(at + GREATEST, limit)
        late = far[1][np.searchsorted(far[1], at + NORMAL)] + 1
        end = np.minimum(end, late)
        early = far[0][np.searchsorted(far[0], at + LEAST - 1)] + 1
        end = np.where(early <= np.minimum(at + NORMAL, limit), early, end)
        found.append((texts, at, end))
        more = end < limit
        texts, at, limit = texts[more], end[more], limit[more]
    text, begin, end = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((begin, text))
    return text[order], begin[order], end[order]


def chunk_sets(texts: list[bytes]) -> list[np.ndarray]:
    """Sorted distinct (digest, size) entries of each text's chunks."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0, *map(len, texts)])
    text, begin, end = chunk_ends(data, offsets)
    # digest of a chunk from running sums of letter values times powers, brought back to the chunk's begin
    power = np.full(len(data) + 1, STEP)
    power[0] = 1
    back = np.full(len(data) + 1, STEP_BACK)
    back[0] = 1
    power, back = np.cumprod(power), np.cumprod(back)
    total = np.append(np.uint64(0), np.cumsum(LETTER[data] * power[:-1]))
    value = (total[end] - total[begin]) * back[begin]
    value ^= value >> np.uint64(31)
    value *= STEP
    entries = np.zeros(len(text), ENTRY)
    entries["digest"], entries["size"] = (value >> np.uint64(32)).astype(np.uint32), end - begin
    order = np.lexsort((entries["size"], entries["digest"], text))
    text, entries = text[order], entries[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (entries[1:] != entries[:-1])
    text, entries = text[fresh], entries[fresh]
    limits = np.searchsorted(text, np.arange(len(texts) + 1))
    return [entries[a:b] for a, b in zip(limits[:-1], limits[1:])]


def containment(part: np.ndarray, whole: np.ndarray) -> float:
    """Share of ``part``'s distinct chunk bytes that ``whole`` has too; two empty fingerprints are alike, 1."""
    weight = int(part["size"].sum(dtype=np.int64))
    if not weight:
        return 1.0 if not len(whole) else 0.0
    key = lambda x: x["digest"].astype(np.int64) << 8 | x["size"]
    shared = np.isin(key(part), key(whole), assume_unique=True)
    return int(part["size"][shared].sum(dtype=np.int64)) / weight


def fingerprint(entries: np.ndarray) -> str:
    """Ten hex digits per distinct chunk in order of digest: eight of the digest, two of the size."""
    return entries.tobytes().hex()


def entries_of(printed: str) -> np.ndarray:
    """Back from the string to the entries."""
    return np.frombuffer(bytes.fromhex(printed), ENTRY)


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as much of the following document's beginning."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _results(rows: list[tuple[int, int | None, str]], following: list[str]) -> pa.RecordBatch:
    own = [t.encode() for _, _, t in rows]
    changed = [edited(t, f).encode() for (_, _, t), f in zip(rows, following)]
    sets = chunk_sets([*own, *changed, following[-1].encode()])
    n = len(rows)
    mine, edits, after = sets[:n], sets[n : 2 * n], [*sets[1:n], sets[-1]]
    # where a bucket ends the next row is not the following document
    after = [a if f == t else s for a, f, t, s in zip(after, following, [*(t for _, _, t in rows[1:]), following[-1]], _apart(rows, following))]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([d for _, d, _ in rows], pa.int64()),
            pa.array([len(t) for _, _, t in rows], pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
            pa.array([fingerprint(x) for x in mine]),
            pa.array([fingerprint(x) for x in edits]),
            pa.array([containment(a, b) for a, b in zip(mine, edits)]),
            pa.array([containment(a, b) for a, b in zip(mine, after)]),
        ],
        [c.split()[0] for c in SCHEMA.split(", ")],
    )


def _apart(rows: list[tuple[int, int | None, str]], following: list[str]) -> list[np.ndarray | None]:
    """Chunk sets of following documents that are not the next row of the slice."""
    other = [i for i in range(len(rows) - 1) if following[i] != rows[i + 1][2]]
    sets = dict(zip(other, chunk_sets([following[i].encode() for i in other]))) if other else {}
    return [sets.get(i) for i in range(len(rows))]


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, guests last: every row but guests is paired with the row after it in its bucket."""
    held = None  # last own row of the current bucket, its following document not seen yet
    for batch in slices(batches, limit=1 << 20):
        rows, following = [], []
        columns = (batch.column(c).to_pylist() for c in ("bucket", "guest", "doc_id", "text"))
        for bucket, guest, doc_id, text in zip(*columns):
            if held is not None and held[0] == bucket:
                rows.append(held)
                following.append(text)
            held = None if guest else (bucket, doc_id, text)
        if rows:
            yield _results(rows, following)


def _buckets(edges: np.ndarray, doc_id: pa.Array) -> np.ndarray:
    """Number of edges at or below each doc_id; rows without one have a last bucket of their own."""
    own = np.searchsorted(edges, doc_id.fill_null(0).to_numpy(), "right").astype(np.int32)
    own[doc_id.is_null().to_numpy(zero_copy_only=False)] = len(edges) + 1
    return own


def _number(edges: np.ndarray):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _buckets(edges, batch.column("doc_id"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], [*batch.schema.names, "bucket"])

    return job


def _deal(edges: np.ndarray, firsts: dict[tuple, int]):
    """Bucket of each row; a bucket's first row is also dealt to the bucket before, as a guest."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column("doc_id")
            own = _buckets(edges, doc_id)
            names = [*batch.schema.names, "bucket", "guest"]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(np.zeros(len(own), bool))], names)
            keys = zip(doc_id.to_pylist(), batch.column("digest").to_pylist())
            guests = [(i, firsts[k]) for i, k in enumerate(keys) if k in firsts]
            if guests:
                copied = batch.take(pa.array([i for i, _ in guests]))
                to = pa.array([b for _, b in guests], pa.int32())
                yield pa.RecordBatch.from_arrays([*copied.columns, to, pa.array(np.ones(len(guests), bool))], names)

    return job


def chunk_fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; a row per row of ``docs``.

    Columns: doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The edited text has its last
    quarter replaced by the beginning of the next document in ascending doc_id
    (after the last: the first). Rows without doc_id come last; rows that share
    a doc_id are ordered by content digest. Likeness is the share of a text's
    distinct chunk bytes that the other has too; two empty texts are alike.
    Null texts count as empty.

    Texts are shuffled once, into buckets of neighbouring ids that tasks read
    as sorted streams. Only bucket edges and first rows' ids reach the driver.
    """
    spark = docs.sparkSession
    rows = documents_of(docs).select("doc_id", digest("text").alias("digest"), "text")
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / buckets for i in range(1, buckets)]
    edges = sorted({int(x) for x in rows.select("doc_id").approxQuantile("doc_id", shares, 0.25 / buckets)}) if shares else []
    edges = np.array(edges, np.int64)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    numbered = rows.select("doc_id", "digest").mapInArrow(_number(edges), "doc_id long, digest long, bucket int")
    low = numbered.select("bucket", order.alias("k")).groupBy("bucket").agg(F.min("k").alias("k")).orderBy("bucket").collect()
    named = [((r["k"]["doc_id"], r["k"]["digest"]), r["bucket"]) for r in low]
    firsts = {key: named[i - 1][1] for i, (key, _) in enumerate(named)}
    dealt = rows.mapInArrow(_deal(edges, firsts), "doc_id long, digest long, text string, bucket int, guest boolean")
    ordered = dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", F.col("doc_id").asc_nulls_last(), "digest")
    return ordered.select("bucket", "guest", "doc_id", "text").mapInArrow(_stream, SCHEMA)
