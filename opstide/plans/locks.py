"""Lock and deadlock risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import AsOf
from ..operators.rollups import last_hour_locks, top_tables
from ..operators.windows import weekly_trend

# Score bounds of the hourly and of the trend risk levels.
HOURLY_LEVELS = [(70, "critical"), (40, "high"), (20, "warning")]
TREND_LEVELS = [(50, "critical"), (25, "high"), (10, "warning")]


def risk_level(score: Column, bounds) -> Column:
    first_bound, first_level = bounds[0]
    level = F.when(score >= first_bound, first_level)
    for bound, name in bounds[1:]:
        level = level.when(score >= bound, name)
    return level.otherwise("normal")


def _finding(points: int, level: str, code: str, value: Column) -> Column:
    return F.struct(
        F.lit(points).alias("points"),
        F.lit(level).alias("level"),
        F.lit(code).alias("code"),
        value.cast("double").alias("value"),
    )


def scored(df: DataFrame, findings: list[Column], bounds) -> DataFrame:
    """Add the raised findings, their summed points and the resulting level."""
    raised = df.withColumn("warnings", F.filter(F.array(*findings), lambda w: w.isNotNull()))
    points = F.aggregate(F.col("warnings")["points"], F.lit(0), lambda total, p: total + p)
    return raised.withColumn("risk_score", points).withColumn("risk_level", risk_level(F.col("risk_score"), bounds))


def _hourly_findings(variant: str) -> list[Column]:
    deadlocks, timeouts = F.col("deadlocks"), F.col("timeouts")
    mean_wait, max_wait, trend = F.col("avg_wait_ms"), F.col("max_wait_ms"), F.col("trend_pct")
    critical_wait = mean_wait if variant == "doc" else max_wait
    findings = [
        F.when(deadlocks >= 1, _finding(50, "critical", "deadlocks", deadlocks)),
        F.when(critical_wait > 1000, _finding(30, "critical", "wait", critical_wait)).when(
            mean_wait > 500, _finding(15, "warning", "wait", mean_wait)
        ),
        F.when(trend > 100, _finding(40, "critical", "trend", trend)).when(
            trend > 50, _finding(20, "warning", "trend", trend)
        ),
    ]
    if variant == "doc":
        findings.append(F.when(timeouts > 10, _finding(10, "warning", "timeouts", timeouts)))
    return findings


def score_hourly(stats: DataFrame, variant: str = "default") -> DataFrame:
    """Risk of rows holding deadlocks, timeouts, avg_wait_ms, max_wait_ms and trend_pct."""
    return scored(stats, _hourly_findings(variant), HOURLY_LEVELS)


def lock_risk(df: DataFrame, as_of: AsOf, variant: str = "default", n_tables: int = 10, exact: bool = True) -> DataFrame:
    """Risk of the last hour as one row with nested warnings and leading tables.

    The week's trend and the table list are scalar subqueries: each is a small
    aggregate of its own pruned scan.
    """
    stats = last_hour_locks(df, as_of, exact)
    trend = weekly_trend(df, as_of, mode="ends" if variant == "doc" else "halves").select("trend_pct")
    tables = top_tables(df, as_of, n_tables, hours=1, exact=exact)
    listed = tables.agg(
        F.sort_array(
            F.collect_list(
                F.struct("lock_count", "table_name", "deadlocks", (F.col("avg_wait") / 1000).alias("avg_wait_ms"))
            ),
            asc=False,
        ).alias("tables")
    )
    row = stats.withColumns({"trend_pct": trend.scalar(), "tables": listed.scalar()})
    return score_hourly(row, variant)


def risk_message(risk: DataFrame) -> DataFrame:
    """Rendered alert text of a risk row."""
    message = F.format_string(
        "Lock risk %s (score %d): %d locks, %d deadlocks, %d timeouts, wait avg %.1f ms, max %.1f ms",
        F.upper("risk_level"),
        F.col("risk_score"),
        F.col("total_locks"),
        F.col("deadlocks"),
        F.col("timeouts"),
        F.col("avg_wait_ms"),
        F.col("max_wait_ms"),
    )
    return risk.withColumn("message", message)


def lock_trend_risk(trends: DataFrame) -> DataFrame:
    """Risk of a month's lock trends (first against last week)."""
    deadlocks, wait = F.col("current_avg_deadlocks"), F.col("current_avg_wait")
    d_trend, w_trend, l_trend = (F.col(f"{c}_trend_pct") for c in ("deadlocks", "wait_time", "locks"))
    findings = [
        F.when(deadlocks > 0, _finding(30, "high", "deadlocks", deadlocks)).when(
            d_trend > 50, _finding(20, "warning", "deadlock_trend", d_trend)
        ),
        F.when(wait > 1_000_000, _finding(25, "high", "wait", wait))
        .when(w_trend > 100, _finding(20, "high", "wait_trend", w_trend))
        .when(w_trend > 50, _finding(10, "warning", "wait_trend", w_trend)),
        F.when(l_trend > 100, _finding(15, "high", "lock_trend", l_trend)).when(
            l_trend > 50, _finding(10, "warning", "lock_trend", l_trend)
        ),
    ]
    return scored(trends, findings, TREND_LEVELS)


def lock_forecast(daily: DataFrame, days_ahead: int = 7, min_rows: int = 14, by: str = "row") -> DataFrame:
    """Straight-line forecast of daily lock counts and waits with a deadlock estimate.

    ``by="row"`` regresses on the position of the day among the days with data,
    ``by="date"`` on the calendar day, which keeps gaps apart.
    """
    everything = Window.partitionBy()
    if by == "date":
        x = F.datediff("event_date", F.min("event_date").over(everything))
    else:
        x = F.row_number().over(everything.orderBy("event_date")) - 1
    fitted = (
        daily.withColumn("_x", x.cast("double"))
        .agg(
            F.regr_slope("total_locks", "_x").alias("trend_locks"),
            F.regr_intercept("total_locks", "_x").alias("_a_locks"),
            F.regr_slope("avg_wait", "_x").alias("trend_wait"),
            F.regr_intercept("avg_wait", "_x").alias("_a_wait"),
            F.max("_x").alias("_last"),
            F.count("*").alias("_n"),
        )
        .filter(F.col("_n") >= min_rows)
    )
    at = F.col("_last") + F.col("day")
    steps = fitted.withColumn("day", F.explode(F.sequence(F.lit(1), F.lit(days_ahead)))).withColumns(
        {
            "forecast_locks": F.col("_a_locks") + F.col("trend_locks") * at,
            "forecast_wait": F.col("_a_wait") + F.col("trend_wait") * at,
        }
    )
    probability = F.least(F.lit(100.0), F.col("forecast_wait") / 1_000_000 * 10)
    risky = F.min(F.when(F.col("deadlock_probability") > 70, F.col("day"))).over(everything)
    return (
        steps.withColumn("deadlock_probability", probability)
        .withColumn("days_to_deadlock", risky)
        .select(
            "day", "forecast_locks", "forecast_wait", "deadlock_probability", "days_to_deadlock", "trend_locks", "trend_wait"
        )
    )

