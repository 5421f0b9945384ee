"""Labelled metric samples: (metric, labels..., ts, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timeparts import AsOf, ts_literal, within


def instant(df: DataFrame, metric: str, as_of: AsOf, labels: list[str], hours: int | None = None) -> DataFrame:
    """Newest sample per label set at ``as_of``.

    With ``hours`` only that span is read, and a series without a sample in it is stale and left out.
    """
    rows = df.filter(F.col("ts") <= ts_literal(as_of)) if hours is None else within(df, "ts", as_of, hours=hours)
    return (
        rows.filter(F.col("metric") == metric)
        .groupBy(*labels)
        .agg(F.max("ts").alias("ts"), F.max_by("value", "ts").alias("value"))
    )


def tagged(df: DataFrame, labels: list[str]) -> DataFrame:
    """Fold label columns into one ``tags`` map, the generic metric-table form."""
    pairs = [x for c in labels for x in (F.lit(c), F.col(c).cast("string"))]
    return df.select("metric", F.create_map(*pairs).alias("tags"), "ts", "value")
