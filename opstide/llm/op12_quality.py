"""Quality by compression: zstandard dictionaries of good and of bad text, the difference of sizes as calibrated score."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import bytes_of, documents_of, rows_and_texts, slices, small_batches

#: Labelled rows that are learned from, at most.
FIT_ROWS = 20_000
#: Bytes of a piece of text; pieces are compressed each for itself, so that the dictionary counts as much at a text's end as at its beginning.
PIECE = 1024
#: Bytes of a dictionary.
DICTIONARY = 65_536
#: Pieces of a class, about, that a dictionary is made of.
DICTIONARY_PIECES = 24_000
LEVEL = 3
#: Parts of the labelled rows. Each part's calibration scores come from dictionaries of the other parts.
FOLDS = 3
THRESHOLD = 0.5


def held_out(doc_id) -> F.Column:
    """Rows whose labels are never used: crc32 of doc_id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def pieces(data: bytes, size: int = PIECE) -> list[bytes]:
    """The whole of ``data`` in pieces of ``size`` bytes, the last one shorter; one empty piece for empty data."""
    return [data[at : at + size] for at in range(0, len(data), size)] or [b""]


def dictionary_of(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """Dictionary trained on the samples; where they are too few for training, as much of their text as fits."""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[:size]


@dataclass
class QualityModel:
    """For each fold the dictionaries of bad and of good text, and the weights of the calibration."""

    pairs: list[tuple[bytes, bytes]] = field(default_factory=list)
    slope: float = 0.0
    base: float = 0.0

    def compressors(self) -> list[tuple]:
        def one(dictionary: bytes):
            # the compressor keeps what it derives from the dictionary, so each piece costs only itself
            found = zstandard.ZstdCompressionDict(dictionary)
            found.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(level=LEVEL, dict_data=found, write_content_size=False, write_checksum=False, write_dict_id=False)

        return [(one(bad), one(good)) for bad, good in self.pairs]

    def probability(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * difference + self.base, -30, 30)))


def difference(pair: tuple, parts: list[bytes]) -> float:
    """Normalised difference of compressed sizes: above zero where the good dictionary compresses better."""
    bad = sum(len(pair[0].compress(p)) for p in parts)
    good = sum(len(pair[1].compress(p)) for p in parts)
    return (bad - good) / (bad + good)


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, base) of the logistic curve through the differences; Newton steps with a weak pull to zero."""
    if not len(x) or y.min() == y.max():
        n1 = float(y.sum()) if len(y) else 0.0
        return 0.0, math.log((n1 + 1) / (len(y) - n1 + 1))
    scale = float(np.std(x)) or 1.0
    design = np.stack([x / scale, np.ones(len(x))], 1)
    weight = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weight, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), design.T @ (y - p) - 1e-3 * weight)
        weight += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(weight[0] / scale), float(weight[1])


def _piece_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, at = bytes_of(batch.column("text"))
        data = data.tobytes()
        parts = [pieces(data[a:b]) for a, b in zip(at, at[1:])]
        row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        flat = [p for part in parts for p in part]
        mark = np.array([xxhash.xxh64_intdigest(p) >> 1 for p in flat], np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("fold").take(pa.array(row)), batch.column("quality").take(pa.array(row)), pa.array(mark), pa.array(flat, pa.binary())],
            ["fold", "quality", "mark", "piece"],
        )


def _train(size: int):
    def job(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["mark"], kind="stable")
        found = dictionary_of([p for p in group["piece"] if p], size)
        return pd.DataFrame({"without": [group["without"].iloc[0]], "quality": [group["quality"].iloc[0]], "dictionary": [found]})

    return job


def _differences(model: QualityModel):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model.compressors()
        for batch in slices(batches):
            data, at = bytes_of(batch.column("text"))
            data = data.tobytes()
            fold = batch.column("fold").to_pylist()
            found = [difference(pairs[f], pieces(data[a:b])) for f, a, b in zip(fold, at, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column("quality")], ["difference", "quality"])

    return job


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, size: int = DICTIONARY) -> QualityModel:
    """Dictionaries and calibration from at most ``fit_rows`` labelled rows that are not held out.

    The rows are dealt to ``FOLDS`` parts by their text, so copies share a part.
    The dictionary pair of a part is made of the other parts' pieces: equal
    pieces once, and of a class with more than ``DICTIONARY_PIECES`` an even
    choice by their hash. Each pair then compresses its own part, whose
    differences and labels give the calibration. Training runs in one task for
    each dictionary; the dictionaries and one number a row reach the driver.

    Rows without label, doc_id or text teach nothing. Without both classes
    there is no dictionary and all scores are the share of good labels.
    """
    use = labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
    use = use.where("doc_id is not null and quality in (0, 1)").where(~held_out("doc_id"))
    use = use.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(fit_rows)
    rows = documents_of(docs).where("text <> ''").join(F.broadcast(use), "doc_id")
    rows = rows.select("text", "quality", F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold"))
    rows = materialise(rows, "quality-fit")
    parts = materialise(rows.mapInArrow(_piece_rows, "fold int, quality int, mark long, piece binary"), "quality-pieces")
    count = {r["quality"]: r["count"] for r in parts.groupBy("quality").count().collect()}
    if len(count) < 2:
        return QualityModel([], *calibrate(np.zeros(0), np.array([q for q, n in count.items() for _ in range(rows.count())], float)))
    share = F.create_map(*[F.lit(x) for q, n in count.items() for x in (q, min(1.0, DICTIONARY_PIECES / n))])
    chosen = parts.dropDuplicates(["fold", "quality", "mark"]).where(F.col("mark") % 1_000_000 < share[F.col("quality")] * 1_000_000)
    others = F.array(*[F.struct(F.lit(f).alias("without")) for f in range(FOLDS)])
    dealt = chosen.select("*", F.inline(others)).where("without <> fold").select("without", "quality", "mark", "piece")
    made = dealt.groupBy("without", "quality").applyInPandas(_train(size), "without int, quality int, dictionary binary").collect()
    table = {(r["without"], r["quality"]): bytes(r["dictionary"]) for r in made}
    # a part that alone has a class leaves an empty dictionary to its pair
    model = QualityModel([(table.get((f, 0), b""), table.get((f, 1), b"")) for f in range(FOLDS)])
    seen = rows.mapInArrow(_differences(model), "difference double, quality int").toPandas()
    model.slope, model.base = calibrate(seen["difference"].to_numpy(float), seen["quality"].to_numpy(float))
    return model


def scores(model: QualityModel, pairs: list[tuple], texts: pa.Array) -> np.ndarray:
    """Score of each text: the mean difference over all pairs, calibrated."""
    data, at = bytes_of(texts)
    data = data.tobytes()
    found = np.zeros(len(texts))
    if pairs:
        for n, (a, b) in enumerate(zip(at, at[1:])):
            parts = pieces(data[a:b])
            found[n] = sum(difference(pair, parts) for pair in pairs) / len(pairs)
    return model.probability(found)


def _score_rows(model: QualityModel):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model.compressors()
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores(model, pairs, batch.column("text")))], ["doc_id", "score"])

    return job


def quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted), a row per row of ``docs``.

    ``score`` is between 0 and 1, from the whole text alone, higher where a good
    label is likelier; null and empty texts have no difference and score what
    the calibration gives for none. Rows without doc_id are not held out.
    Repeated rows stay; an empty table gives an empty one.
    """
    rows = documents_of(docs).mapInArrow(_score_rows(model), "doc_id long, score double")
    flag = F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int")
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", flag.alias("predicted"))


def _keep(model: QualityModel, threshold: float, names: list[str]):
    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = model.compressors()
        for batch, texts in rows_and_texts(batches, names):
            kept = batch.filter(pa.array(scores(model, pairs, texts) >= threshold))
            yield pa.RecordBatch.from_arrays([kept.column(c) for c in range(len(names))], names)

    return job


def drop_low_quality(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score below ``threshold``; all columns stay as they are.

    Null and empty texts are judged by their score as in ``quality``, repeated rows alike.
    """
    small_batches(docs.sparkSession)
    return docs.mapInArrow(_keep(model, threshold, docs.columns), docs.schema)
