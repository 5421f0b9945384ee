"""Alert expressions: priorities, due dates, message templates, record flattening."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .timeparts import AsOf, col, date_literal

# Severity to ticket priority.
PRIORITIES = {"critical": "Highest", "warning": "High", "info": "Medium"}
DEFAULT_PRIORITY = "Medium"

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
        T.StructField("annotations", T.MapType(T.StringType(), T.StringType())),
    ]
)


def priority(severity: str | Column) -> Column:
    pairs = [F.lit(x) for kv in PRIORITIES.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col(severity)], F.lit(DEFAULT_PRIORITY))


def due_date(days_to_limit: str | Column, as_of: AsOf) -> Column:
    """Ticket due date from the (whole) days left until the limit."""
    d = col(days_to_limit).cast("int")
    slack = (
        F.when(d <= 7, F.greatest(F.lit(1), d - 1))
        .when(d <= 14, F.greatest(F.lit(2), d - 2))
        .otherwise(F.greatest(F.lit(3), d - 3))
    )
    return F.date_add(date_literal(as_of), slack)


def disk_due_date(level: str | Column, days_to_limit: str | Column, as_of: AsOf) -> Column:
    """Due date of a disk ticket; only critical and warning levels get one."""
    d = F.floor(col(days_to_limit)).cast("int")
    slack = F.when(col(level) == "critical", F.greatest(F.lit(1), d - 1)).when(
        col(level) == "warning", F.greatest(F.lit(2), d - 2)
    )
    return F.date_add(date_literal(as_of), slack)


def worst_level(levels: str | Column) -> Column:
    """Highest of an array of levels, NULL for an empty array."""
    levels = col(levels)
    return (
        F.when(F.array_contains(levels, "critical"), "critical")
        .when(F.array_contains(levels, "warning"), "warning")
        .when(F.size(levels) > 0, "info")
    )


def flatten_alerts(df: DataFrame, payload: str = "payload") -> DataFrame:
    """One row per alert record with label defaults and the extra labels as a map."""
    alert = F.from_json(col(payload), ALERT_SCHEMA)
    known = F.array(*[F.lit(x) for x in ("alertname", "severity", "instance", "job")])
    parsed = df.withColumn("_alert", alert)
    labels, notes = F.col("_alert.labels"), F.col("_alert.annotations")

    def label(name: str, default: str) -> Column:
        return F.coalesce(labels[name], F.lit(default))

    return parsed.withColumns(
        {
            "status": F.coalesce(F.col("_alert.status"), F.lit("firing")),
            "alertname": label("alertname", "Unknown"),
            "instance": label("instance", "unknown"),
            "job": label("job", "unknown"),
            "severity": label("severity", "warning"),
            "value": F.coalesce(notes["value"], F.lit("N/A")),
            "summary": F.coalesce(notes["summary"], labels["alertname"], F.lit("Unknown Alert")),
            "extra_labels": F.map_filter(labels, lambda k, v: ~F.array_contains(known, k)),
        }
    ).drop("_alert")


def exploded_labels(flat: DataFrame, keys: list[str]) -> DataFrame:
    """The extra labels of flattened alerts as (keys..., label, label_value) rows."""
    return flat.select(*keys, F.explode("extra_labels").alias("label", "label_value"))
