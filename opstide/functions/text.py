"""Text column expressions: flags, labels, extraction, normalisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .timeparts import col

# Labels in order of precedence; a rule holds when any of its
# groups has all of its words in the lower-cased text.
ERROR_RULES = [
    ("permission_error", [["прав"], ["доступ"]]),
    ("division_by_zero", [["деление", "ноль"]]),
    ("lock_timeout", [["блокировк"], ["deadlock"]]),
    ("network_error", [["сет"], ["connection"]]),
    ("conversion_error", [["конверт"], ["convert"]]),
    ("db_error", [["баз"], ["db"]]),
]
ERROR_DEFAULT = "interface_error"


def contains_ci(text: str | Column, needle: str) -> Column:
    return F.contains(F.lower(col(text)), F.lit(needle.lower()))


def error_text(text: str | Column) -> Column:
    """Message after ``Exception in <where>: ``, up to the end of the line."""
    return F.regexp_extract(col(text), r"Exception in .*?: ([^\n]*)", 1)


def label_errors(text: str | Column, rules=None, default: str = ERROR_DEFAULT) -> Column:
    lowered = F.lower(col(text))
    labelled = None
    for label, groups in rules or ERROR_RULES:
        hits = [reduce(lambda a, b: a & b, [F.contains(lowered, F.lit(w)) for w in g]) for g in groups]
        hit = reduce(lambda a, b: a | b, hits)
        labelled = F.when(hit, label) if labelled is None else labelled.when(hit, label)
    return labelled.otherwise(default)


def normalise_text(error: str | Column, operation: str | Column) -> Column:
    """Lower-cased error text and operation name joined for vectorising."""
    return F.concat(F.coalesce(F.lower(col(error)), F.lit("")), F.lit(" "), F.coalesce(col(operation), F.lit("")))


def extract_tables(query: str | Column) -> Column:
    """Distinct table names (``_Name12``) mentioned in a query text."""
    return F.array_distinct(F.regexp_extract_all(col(query), F.lit("_([A-Za-z]+[0-9]*)"), F.lit(1)))


def next_version(version: str | Column) -> Column:
    """Raise the third part of a dotted version by one."""
    parts = F.split(col(version), r"\.")
    build = F.try_element_at(parts, F.lit(3)).try_cast("bigint")
    bumped = F.concat_ws(".", F.get(parts, 0), F.get(parts, 1), (build + 1).cast("string"))
    return F.when(build.isNotNull(), bumped).otherwise("?.?.?")


def with_error_type(df: DataFrame, text: str = "error_text", rules=None) -> DataFrame:
    return df.withColumn("error_type", label_errors(text, rules))
