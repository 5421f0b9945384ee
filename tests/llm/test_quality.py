"""Compression classifier: held-out accuracy, bounds, odd tables."""

import zlib

import numpy as np
import pytest
import zstandard
from llm_data import *  # noqa: F403

from opstide.llm import op12_quality as K


@pytest.fixture(scope="module")
def tables(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return K.fit(*tables)


def ranked_above(scores, good):
    """Chance that a good document scores above a bad one."""
    return np.mean([(scores[good == 1][:, None] > scores[good == 0][None]) + 0.5 * (scores[good == 1][:, None] == scores[good == 0][None])])


def test_held_out_accuracy(tables, model):
    docs, labels = tables
    rows = K.quality(docs, model).join(labels, "doc_id").toPandas()
    assert set(rows["held_out"]) == {False, True} and rows["score"].between(0, 1).all()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"]]).all()
    assert (rows["predicted"] == (rows["score"] >= 0.5)).all()
    held = rows[rows["held_out"]]
    score, good = held["score"].to_numpy(), held["quality"].to_numpy()
    assert ranked_above(score, good) > 0.9
    assert np.mean(held["predicted"] == good) > max(good.mean(), 0.9)
    # calibrated: the mean score is near the share of good documents
    assert abs(score.mean() - good.mean()) < 0.1


def test_held_out_labels_are_never_used(spark, tables, model):
    docs, labels = tables
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1 THEN 1 - quality ELSE quality END AS quality", "toxic")
    again = K.fit(docs, turned)
    assert (again.pairs, again.slope, again.base) == (model.pairs, model.slope, model.base)


def test_scores_against_plain_compression(tables, model):
    """Scores derived anew with one compressor per piece."""
    docs, _ = tables
    for r in K.quality(docs.where("doc_id < 20"), model).join(docs, "doc_id").collect():
        data, found = (r["text"] or "").encode(), []
        for pair in model.pairs:
            sizes = []
            for d in pair:
                size = 0
                for at in range(0, max(len(data), 1), K.PIECE):
                    z = zstandard.ZstdCompressor(
                        level=K.LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False
                    )
                    size += len(z.compress(data[at : at + K.PIECE]))
                sizes.append(size)
            found.append((sizes[0] - sizes[1]) / sum(sizes))
        assert abs(r["score"] - 1 / (1 + np.exp(-(model.slope * np.mean(found) + model.base)))) < 0.02


def test_odd_tables(spark, odd_docs, no_docs, model, tables):
    got = K.quality(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in got)
    empty = {r["score"] for r in got if r["doc_id"] in (5, 6)}
    assert len(empty) == 1 and [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]
    assert K.quality(no_docs, model).count() == 0
    kept = K.drop_low_quality(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted((r["doc_id"] for r in got if r["predicted"]), key=repr)
    assert K.drop_low_quality(no_docs, model).count() == 0


def test_too_little_to_learn_from(spark, odd_docs, no_docs):
    def labels(*rows):
        return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")

    use = [i for i in range(3, 13) if zlib.crc32(str(i).encode()) % 3 != 1]
    none = K.fit(odd_docs, labels())
    assert none.pairs == [] and {r["score"] for r in K.quality(odd_docs, none).collect()} == {0.5}
    one = K.fit(odd_docs, labels(*[(i, 1, 0) for i in use], (None, 0, 0)))
    assert one.pairs == [] and all(r["score"] > 0.5 for r in K.quality(odd_docs, one).collect())
    assert K.fit(no_docs, labels((3, 1, 0))).pairs == []
    both = K.fit(odd_docs, labels(*[(i, i % 2, 0) for i in use], (3, None, None)))
    assert all(0 <= r["score"] <= 1 for r in K.quality(odd_docs, both).collect())
