"""Recommendations built from reports and models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantile


def role_recommendations(role_errors: DataFrame, min_errors: int = 50) -> DataFrame:
    """Advice for roles with many errors, by their most frequent error type (rank 1)."""
    kind = (
        F.when(F.col("error_type") == "permission_error", "training")
        .when(F.col("error_type") == "division_by_zero", "code_fix")
    )
    return (
        role_errors.filter((F.col("rank") == 1) & (F.col("total_errors") > min_errors))
        .withColumn("type", kind)
        .filter(F.col("type").isNotNull())
        .select(F.col("user_role").alias("subject"), "type", F.col("total_errors").alias("errors"))
    )


def user_recommendations(problem_users: DataFrame, top: int = 5) -> DataFrame:
    """Individual training for the users with most errors."""
    leaders = problem_users.orderBy(F.desc("total_errors"), "user_name").limit(top)
    return leaders.select(
        F.col("user_name").alias("subject"), F.lit("individual_training").alias("type"), F.col("total_errors").alias("errors")
    )


def recommendations(role_errors: DataFrame, problem_users: DataFrame) -> DataFrame:
    return role_recommendations(role_errors).unionByName(user_recommendations(problem_users))


def needs_training(users: DataFrame, measure: str = "documents_processed") -> DataFrame:
    """Outlier users (prediction -1) whose output is below the median of all users."""
    median = exact_quantile(users, [], measure, 0.5, "median")
    return users.filter((F.col("prediction") == -1) & (F.col(measure) < median.scalar()))


def training_messages(low: DataFrame, best_mean: Column, top: int = 5) -> DataFrame:
    """Advice rows for the weakest users against the mean of the best cluster."""
    weakest = low.orderBy("documents_processed", "user_name").limit(top)
    return weakest.select("user_name", "role", "documents_processed", best_mean.alias("best_cluster_mean"))


def settings_report(settings: DataFrame, impact_share: float = 0.3) -> DataFrame:
    """Change, estimated impact and status of (parameter, current, optimal) rows, with the total impact."""
    change = F.try_divide(F.col("optimal") - F.col("current"), F.col("current")) * 100
    size = F.abs(F.col("change_pct"))
    rows = settings.withColumn("change_pct", change).filter(F.col("change_pct").isNotNull())
    scored = rows.withColumns(
        {
            "impact": size * impact_share,
            "status": F.when(size > 50, "critical").when(size > 20, "attention").otherwise("normal"),
        }
    )
    # One row per parameter, so the global window is tiny.
    return scored.withColumn("total_impact", F.sum("impact").over(Window.partitionBy()))
