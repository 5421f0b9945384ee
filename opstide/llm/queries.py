"""One registered query per operator, over its whole table, and the checking SQL that there is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    op01_secrets,
    op02_substrings,
    op03_urls,
    op04_licenses,
    op05_toxicity,
    op06_simhash,
    op07_chunks,
    op08_binary,
    op09_packing,
    op10_decontaminate,
    op11_runs,
    op12_quality,
    op13_variants,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_secrets.secret_report(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op02_substrings.repeated_units(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", "kept_doc_id", "kept_start")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_urls.judge_urls(table(spark, sf_dir, "pages"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_licenses.license_report(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op05_toxicity.toxicity(docs, op05_toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_chunks.chunk_fingerprints(table(spark, sf_dir, "documents"))


def op8_binary_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_binary.packed_matrices(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_packing.pack(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op10_decontaminate.contaminated_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("digest")


def with_periods(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) with a period planted into every document whose crc32(doc_id) = h is divisible by ten.

    With g = h / 10 and n words, the words from a = g % n on repeat p = 1 + (n - a) / (3 + g % 8) of them.
    Rows without doc_id, without text or without words stay as they are.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text", F.crc32(docs["doc_id"].cast("long").cast("string").cast("binary")).alias("h"))
    words = r"filter(split(text, r'[\x20\x09-\x0D]+'), w -> w <> '')"
    # one-element arrays hold what is computed once
    planted = f"""
        transform(transform(transform(array({words}),
            w -> struct(w, size(w) AS n, cast((h div 10) % size(w) AS int) AS a)),
            s -> struct(s.w, s.n, s.a, cast(1 + (s.n - s.a) div (3 + (h div 10) % 8) AS int) AS p)),
            s -> array_join(concat(slice(s.w, 1, s.a + s.p),
                                   slice(flatten(array_repeat(slice(s.w, s.a + 1, s.p), cast((s.n - s.a) div s.p + 1 AS int))),
                                         s.p + 1, s.n - s.a - s.p)), ' '))[0]"""
    due = r"h % 10 = 0 AND text RLIKE r'[^\x20\x09-\x0D]'"
    return rows.select("doc_id", F.expr(f"CASE WHEN {due} THEN {planted} ELSE text END").alias("text"))


def op11_periodic_run_detection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_runs.run_report(with_periods(table(spark, sf_dir, "documents")))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op12_quality.quality(docs, op12_quality.fit(docs, table(spark, sf_dir, "labels")))


def with_slips(runs: DataFrame) -> DataFrame:
    """(word) of each (doc_id, run): where 199 divides crc32('doc_id:run') = h, the run loses its letter number h % length."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    rows = runs.select("run", h.alias("h"))
    cut = "concat(left(run, cast(h % length(run) AS int)), substr(run, cast(h % length(run) AS int) + 2))"
    return rows.select(F.expr(f"CASE WHEN h % 199 = 0 THEN {cut} ELSE run END").alias("word"))


def op13_spelling_variant_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = with_slips(op13_variants.letter_runs(table(spark, sf_dir, "documents")))
    counts = op13_variants.word_counts(words.where(F.length("word") >= op13_variants.MIN_LETTERS))
    return op13_variants.spelling_variants(counts)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scans,
        op2_substring_dedup,
        op3_url_filters,
        op4_license_scans,
        op5_toxicity,
        op6_simhash_near_dedup,
        op7_document_fingerprints,
        op8_binary_output,
        op9_best_fit_packing,
        op10_benchmark_decontamination,
        op11_periodic_run_detection,
        op12_quality_classifier,
        op13_spelling_variant_grouping,
    )
}

ORACLES: dict[str, str] = {
    "op2_substring_dedup": """
        WITH cut AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '.*?(?:[.!?]+[ \\t\\r]+|[。！？]+|\\n|$)') AS parts FROM documents
        ), units AS (
            SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS n FROM cut
        ), placed AS (
            SELECT doc_id, n, trim(regexp_replace(lower(part), '\\s+', ' ', 'g')) AS unit,
                   length(rtrim(part, ' ' || chr(9) || chr(13) || chr(10))) AS chars,
                   coalesce(sum(length(part)) OVER (PARTITION BY doc_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM units
        ), ranked AS (
            SELECT *, strlen(unit) AS size, first_value(doc_id) OVER w AS kept_doc_id, first_value(start) OVER w AS kept_start,
                   row_number() OVER w > 1 AS again, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS place
            FROM placed WHERE unit <> ''
            WINDOW w AS (PARTITION BY unit ORDER BY doc_id, start)
        ), runs AS (
            SELECT *, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM ranked WHERE again
        )
        SELECT doc_id, start::BIGINT AS start, (start + chars)::BIGINT AS "end", kept_doc_id, kept_start::BIGINT AS kept_start
        FROM runs QUALIFY sum(size) OVER (PARTITION BY doc_id, run) >= 150
    """,
}
