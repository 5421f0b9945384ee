"""Ranked and grouped reports over errors, users, tickets, queries and costs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct_change
from ..functions.text import extract_tables, with_error_type
from ..functions.timeparts import AsOf, as_datetime, date_literal, within
from .quantiles import exact_quantiles


def ranked(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """Position of each (already aggregated) row within its group."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def errors_by_role(errors: DataFrame, top: int = 3, rules=None) -> DataFrame:
    """Most frequent error types per role with the role's total."""
    counts = with_error_type(errors, rules=rules).groupBy("user_role", "error_type").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy("user_role"))
    rows = ranked(counts.withColumn("total_errors", total), ["user_role"], F.desc("n"), F.col("error_type"))
    return rows.filter(F.col("rank") <= top)


def role_matrix(errors: DataFrame, error_types: list[str], rules=None) -> DataFrame:
    """Role by error-type counts, one column per listed type."""
    typed = with_error_type(errors, rules=rules)
    return typed.groupBy("user_role").pivot("error_type", error_types).count().fillna(0)


def users_for_training(errors: DataFrame, threshold: int = 10, rules=None) -> DataFrame:
    """Users with at least ``threshold`` errors and their counts by type (a small map)."""
    counts = with_error_type(errors, rules=rules).groupBy("user_name", "error_type").agg(F.count("*").alias("n"))
    return (
        counts.groupBy("user_name")
        .agg(
            F.sum("n").alias("total_errors"),
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("error_type", "n")))).alias("error_types"),
        )
        .filter(F.col("total_errors") >= threshold)
    )


def error_shares(errors: DataFrame, rules=None) -> DataFrame:
    """Share of each error type with its dominant role and operation and their shares."""
    typed = with_error_type(errors, rules=rules)
    counts = typed.groupBy("error_type", "user_role", "operation_name").agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    totals = counts.groupBy("error_type").agg(F.sum("n").alias("n"))
    result = totals.withColumn("share_pct", F.col("n") / F.sum("n").over(everything) * 100)
    for column, name in (("user_role", "role"), ("operation_name", "operation")):
        part = counts.groupBy("error_type", column).agg(F.sum("n").alias("m"))
        best = part.groupBy("error_type").agg(F.max(F.struct("m", column)).alias("b"))
        result = result.join(
            best.select("error_type", F.col(f"b.{column}").alias(f"top_{name}"), F.col("b.m").alias("_m")), "error_type"
        ).withColumn(f"top_{name}_pct", F.col("_m") / F.col("n") * 100).drop("_m")
    return result


EFFICIENCY = ["documents_processed", "avg_time_per_document", "active_hours", "error_count"]


def user_stats(df: DataFrame) -> DataFrame:
    """Mean daily figures per user, with department and role of the first day."""
    return df.groupBy("user_name").agg(
        *[F.avg(c).alias(c) for c in EFFICIENCY],
        F.min_by("department", "date").alias("department"),
        F.min_by("role", "date").alias("role"),
    )


def cluster_profile(df: DataFrame, measures: list[str], cluster: str = "cluster") -> DataFrame:
    """Count, mean and maximum of each measure per cluster."""
    aggregates = [F.count("*").alias("count")]
    for m in measures:
        aggregates += [F.avg(m).alias(f"avg_{m}"), F.max(m).alias(f"max_{m}")]
    return df.groupBy(cluster).agg(*aggregates)


def leading_cluster(profile: DataFrame, by: str, cluster: str = "cluster") -> DataFrame:
    """The cluster with the largest value of ``by`` (lowest label on ties)."""
    return profile.agg(F.max_by(cluster, F.struct(by, -F.col(cluster))).alias(cluster), F.max(by).alias(by))


def describe_measure(df: DataFrame, measure: str, keys: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per group."""
    stats = df.groupBy(*keys).agg(
        F.count(measure).alias("count"),
        F.avg(measure).alias("mean"),
        F.stddev_samp(measure).alias("std"),
        F.min(measure).alias("min"),
        F.max(measure).alias("max"),
    )
    quartiles = exact_quantiles(df, keys, measure, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return stats.join(quartiles, keys, "left")


def value_counts(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys, column).agg(F.count("*").alias("n"))


def tickets_daily(df: DataFrame) -> DataFrame:
    return df.groupBy(F.to_date("created_date").alias("date")).agg(
        F.count("*").alias("tickets_count"),
        F.avg("first_response_time").alias("first_response_time"),
        F.avg("resolution_time").alias("resolution_time"),
    )


def weekday_profile(df: DataFrame) -> DataFrame:
    """Mean tickets per weekday (1 = Monday) and the busiest two neighbouring hours."""
    hourly = df.groupBy("created_date", "created_hour").agg(F.count("*").alias("n"))
    weekday = (F.weekday("created_date") + 1).alias("weekday")
    per_day = hourly.groupBy("created_date").agg(F.sum("n").alias("n"))
    means = per_day.groupBy(weekday).agg(F.avg("n").alias("mean_tickets"))
    hours = hourly.groupBy(weekday, "created_hour").agg(F.sum("n").alias("n"))
    two_hours = Window.partitionBy("weekday").orderBy("created_hour").rangeBetween(0, 1)
    bands = hours.withColumn("band", F.sum("n").over(two_hours))
    busiest = bands.groupBy("weekday").agg(F.max(F.struct("band", (-F.col("created_hour")).alias("neg_hour"))).alias("b"))
    peak = busiest.select("weekday", (-F.col("b.neg_hour")).alias("peak_from_hour"), F.col("b.band").alias("peak_tickets"))
    return means.join(peak, "weekday")


def sla_status(df: DataFrame, sla: DataFrame, attention_share: float = 0.5) -> DataFrame:
    """Mean response time per priority against its limit (same unit)."""
    means = df.groupBy("priority").agg(F.avg("first_response_time").alias("mean_response"))
    joined = means.join(sla, "priority")
    status = F.when(F.col("mean_response") >= F.col("limit_minutes") * attention_share, "attention").otherwise("ok")
    return joined.withColumn("status", status)


def recent_anomalies(df: DataFrame, as_of: AsOf, days: int = 7) -> DataFrame:
    columns = ["detected_at", "metric_name", "actual_value", "expected_value", "deviation_sigma"]
    return within(df, "detected_at", as_of, days=days).select(*columns).orderBy(F.desc("detected_at"))


def budget_check(df: DataFrame, budget: float) -> DataFrame:
    total = F.col("total_cost")
    over = total > budget
    return df.agg(F.sum("cost").alias("total_cost")).select(
        F.when(over, "critical").otherwise("ok").alias("status"),
        "total_cost",
        F.lit(float(budget)).alias("budget"),
        F.when(over, total - budget).alias("deficit"),
        F.when(~over, budget - total).alias("surplus"),
    )


def slow_query_report(df: DataFrame, as_of: AsOf, margin_pct: float = 10.0) -> DataFrame:
    """This month per query: mean time, change to the calendar month before (null without runs in it), tables and a label.

    Only the two months are read, in one aggregation.
    """
    current = as_datetime(as_of).date().replace(day=1)
    earlier = (current - timedelta(days=1)).replace(day=1)
    day, change = F.col("event_date"), F.col("change_pct")
    now = day >= date_literal(current)
    rows = df.filter((day >= date_literal(earlier)) & (day <= date_literal(as_of)))
    means = rows.groupBy("query_text").agg(
        F.avg(F.when(now, F.col("duration"))).alias("mean_duration"),
        F.avg(F.when(~now, F.col("duration"))).alias("_before"),
        F.count_if(now).alias("runs"),
    )
    return (
        means.filter("runs > 0")
        .select("query_text", date_literal(current).alias("month"), "mean_duration", "runs", pct_change("_before", "mean_duration").alias("change_pct"))
        .withColumns(
            {
                "tables": F.array_sort(extract_tables("query_text")),
                "label": F.when(change > margin_pct, "rising").when(change < -margin_pct, "improving").otherwise("stable"),
            }
        )
    )


def operation_outlook(df: DataFrame, forecast: DataFrame, as_of: AsOf, sla_minutes: float) -> DataFrame:
    """12-month mean per operation against its forecast, and growth of the load factors."""
    year = within(df, "date", as_of, days=365)
    last = F.col("date") >= date_literal(as_of) - F.expr("INTERVAL 30 DAYS")
    factors = ["documents_count", "lines_count"]
    stats = year.groupBy("operation_name").agg(
        F.avg("duration_minutes").alias("mean_12m"),
        *[F.avg(c).alias(f"_year_{c}") for c in factors],
        *[F.avg(F.when(last, F.col(c))).alias(f"_last_{c}") for c in factors],
    )
    joined = stats.join(forecast, "operation_name")
    return joined.select(
        "operation_name",
        "mean_12m",
        "forecast_minutes",
        pct_change("mean_12m", "forecast_minutes").alias("change_pct"),
        (F.col("forecast_minutes") > sla_minutes).alias("over_sla"),
        *[pct_change(f"_year_{c}", f"_last_{c}").alias(f"{c}_growth_pct") for c in factors],
    )
