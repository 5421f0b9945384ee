"""Corpus pipeline: five document operators one after another, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from opstide.llm import op01_secrets, op05_toxicity, op06_simhash, op09_packing, op10_decontaminate
from opstide.session import materialise, remove_since, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject; fitted on the labelled rows among ``docs``.

    Null and empty texts score as texts without findings and stay, repeated
    rows are judged alike and stay, an empty table stays empty.
    """
    model = op05_toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return op05_toxicity.drop_toxic(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, the smallest doc_id.

    Null and empty texts have fingerprint zero and form one group with what is
    near it; rows without doc_id come last in a group; rows equal in doc_id and
    text are one document; an empty table stays empty.
    """
    return op06_simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts are clean and stay, repeated rows are judged alike, an
    empty table stays empty, with an empty benchmark all rows stay.
    """
    return op10_decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark. Null texts stay null, empty ones empty, repeated rows repeated."""
    return op01_secrets.redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in packed sequences.

    Null and empty texts are one end token, repeated rows are packed as often
    as they stand, an empty table has no sequence.
    """
    return op09_packing.pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]
#: Learned scores, fingerprints, alignments and token ids are beyond SQL; the stages are tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again.

    What a stage and its predecessor wrote besides is removed as soon as its result is.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    mark = written()
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{n + 1}")
            remove_since(spark, mark, docs)
    return docs
