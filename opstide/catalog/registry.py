"""Query registry: each entry pairs a Spark query with its checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bindings import Inputs, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Round every double column, the last step before results are compared."""
    return df.select(
        *[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


def query(key: str, sql: str | None = None, digits: int = 4):
    """Register ``fn(inputs) -> DataFrame`` under ``key``, with optional checking SQL."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise KeyError(f"duplicate query {key}")
        QUERIES[key] = lambda spark, sf_dir: rounded(fn(Inputs(spark, sf_dir)), digits)
        if sql is not None:
            ORACLES[key] = with_views(sql)
        return fn

    return register
