"""Incremental rollups that lose no row: partials per micro-batch, merged when read.

Every micro-batch is reduced to partial aggregates and stored in a folder of its
own, which a replay overwrites. Reading merges the partials of all batches, so
rows may arrive in any order and however late, and the current hour or day shows
at once. There is no watermark and no state to grow.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import pct_change
from ..functions.timeparts import calendar_flags, epoch_micros, from_epoch_micros, second_start
from ..operators.joins import pair_counts
from ..operators.rollups import DEADLOCKS, HOUR_KEYS, TIMEOUTS, non_empty
from ..operators.windows import trend_of_days
from ..plans.locks import score_hourly

QUARTER = 15 * 60 * 1_000_000
DAY_QUARTERS = 96
Shape = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class View:
    """Keys and mergeable measures of a rollup; ``sums`` are SQL expressions by name."""

    keys: list[str]
    sums: dict[str, str] = field(default_factory=dict)
    highs: list[str] = field(default_factory=list)
    lows: list[str] = field(default_factory=list)
    distinct: list[str] = field(default_factory=list)
    quantiles: list[str] = field(default_factory=list)

    def partial(self, rows: DataFrame) -> DataFrame:
        """One row per key; distinct counts and quantiles as sketches. ``seen_x`` counts the values of ``x`` that a mean is over."""
        measured = rows.withColumns({f"_{n}": F.expr(c) for n, c in self.sums.items()})
        return measured.groupBy(*self.keys).agg(
            F.count("*").alias("n"),
            *[F.sum(f"_{n}").alias(n) for n in self.sums],
            *[F.count(f"_{n}").alias(f"seen_{n}") for n in self.sums],
            *[F.max(c).alias(f"high_{c}") for c in self.highs],
            *[F.min(c).alias(f"low_{c}") for c in self.lows],
            *[F.hll_sketch_agg(F.col(c).cast("string")).alias(f"hll_{c}") for c in self.distinct],
            *[F.kll_sketch_agg_bigint(F.col(c).cast("long")).alias(f"kll_{c}") for c in self.quantiles],
        )

    def merged(self, partials: DataFrame, keys: list[str] | None = None) -> DataFrame:
        """Partials of any number of batches added up, by fewer keys if wanted."""
        sums = ["n", *self.sums, *[f"seen_{n}" for n in self.sums]]
        return partials.groupBy(*(self.keys if keys is None else keys)).agg(
            *[F.sum(c).alias(c) for c in sums],
            *[F.max(f"high_{c}").alias(f"high_{c}") for c in self.highs],
            *[F.min(f"low_{c}").alias(f"low_{c}") for c in self.lows],
            *[F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}") for c in self.distinct],
            *[F.kll_merge_agg_bigint(f"kll_{c}").alias(f"kll_{c}") for c in self.quantiles],
        )


def mean(name: str) -> Column:
    return F.try_divide(F.col(name), F.col(f"seen_{name}"))


def estimate(name: str) -> Column:
    return F.hll_sketch_estimate(f"hll_{name}")


def p95(name: str) -> Column:
    return F.kll_sketch_get_quantile_bigint(f"kll_{name}", F.lit(0.95))


KINDS = {name: f"cast(event_type = '{kind}' as bigint)" for name, kind in (DEADLOCKS, TIMEOUTS)}
WAITS = {"wait": "lock_wait_time", "held": "lock_time"}

SESSION_HOUR = View(
    HOUR_KEYS,
    {"duration_sum": "duration", "wait": "lock_wait_time", "deadlocks": "is_deadlock", "exceptions": "is_exception", "timeouts": "is_timeout"},
    highs=["duration"],
    distinct=["user_name", "computer_name"],
    quantiles=["duration"],
)
#: Kept per table, because the hour's table count and leading table need it.
LOCK_HOUR = View(
    [*HOUR_KEYS, "table_name"],
    KINDS | WAITS,
    highs=["lock_wait_time", "lock_time"],
    lows=["lock_wait_time"],
    distinct=["session_id", "transaction_id", "user_name"],
    quantiles=["lock_wait_time"],
)
LOCK_TABLE_DAY = View(
    ["event_date", "table_name"],
    KINDS | WAITS,
    highs=["lock_wait_time", "lock_time"],
    distinct=["session_id", "transaction_id", "user_name"],
    quantiles=["lock_wait_time"],
)
LOCK_USER_DAY = View(
    ["event_date", "user_name"], KINDS | WAITS, highs=["lock_wait_time"], distinct=["table_name", "session_id"]
)
TECHLOG_HOUR = View(
    ["event_date", "hour"],
    {
        "duration_sum": "duration",
        "waited": "wait_time",
        "locked": "lock_time",
        "locks": "cast(lock_time > 0 as bigint)",
        "errors": "cast(contains(raw_line, 'Exception') as bigint)",
    },
    highs=["duration"],
    distinct=["session", "user_name", "computer"],
    quantiles=["duration"],
)
LOCK_QUARTER = View(["quarter"], KINDS | WAITS, highs=["lock_wait_time"], distinct=["session_id", "table_name"])
SESSION_QUARTER = View(
    ["quarter"],
    {"duration_sum": "duration", "deadlocks": "is_deadlock", "exceptions": "is_exception", "timeouts": "is_timeout"},
    distinct=["user_name"],
)
SECOND = View(["second", "session_id", "table_name"])


# -------------------------------------------------------------------- storing
def run_partials(stream: DataFrame, shape: Shape, path: str, checkpoint: str) -> StreamingQuery:
    """Store ``shape`` of every micro-batch below ``path``; a replayed batch overwrites its own folder."""

    def store(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def session_hour_partials(events: DataFrame) -> DataFrame:
    return SESSION_HOUR.partial(events)


def lock_hour_partials(events: DataFrame) -> DataFrame:
    return LOCK_HOUR.partial(events)


def lock_table_day_partials(events: DataFrame) -> DataFrame:
    return LOCK_TABLE_DAY.partial(non_empty(events, "table_name"))


def lock_user_day_partials(events: DataFrame) -> DataFrame:
    return LOCK_USER_DAY.partial(non_empty(events, "user_name"))


def techlog_hour_partials(events: DataFrame) -> DataFrame:
    return TECHLOG_HOUR.partial(events)


def _quartered(events: DataFrame) -> DataFrame:
    return events.withColumn("quarter", F.floor(epoch_micros("event_datetime") / QUARTER).cast("long"))


def lock_quarter_partials(events: DataFrame) -> DataFrame:
    return LOCK_QUARTER.partial(_quartered(events))


def session_quarter_partials(events: DataFrame) -> DataFrame:
    return SESSION_QUARTER.partial(_quartered(events))


def second_partials(event_type: str) -> Shape:
    """Events per (second, session, table)."""

    def shape(events: DataFrame) -> DataFrame:
        rows = events.filter(F.col("event_type") == event_type)
        return SECOND.partial(rows.withColumn("second", second_start("event_datetime")))

    return shape


# -------------------------------------------------------------------- reading
def session_hourly(partials: DataFrame) -> DataFrame:
    rows = SESSION_HOUR.merged(partials)
    return calendar_flags(
        rows.select(
            *HOUR_KEYS,
            F.col("n").alias("total_sessions"),
            estimate("user_name").alias("approx_users"),
            estimate("computer_name").alias("approx_computers"),
            mean("duration_sum").alias("avg_duration"),
            p95("duration").alias("approx_p95_duration"),
            F.col("high_duration").alias("max_duration"),
            mean("wait").alias("avg_lock_wait_time"),
            F.col("wait").alias("total_lock_wait_time"),
            F.col("deadlocks").alias("deadlock_count"),
            F.col("exceptions").alias("exception_count"),
            F.col("timeouts").alias("timeout_count"),
        )
    )


def lock_hourly(partials: DataFrame) -> DataFrame:
    per_table = LOCK_HOUR.merged(partials, [*HOUR_KEYS, "table_name"])
    named = F.when(F.col("table_name") != "", F.struct("n", "table_name"))
    tables = per_table.groupBy(*HOUR_KEYS).agg(
        F.count("table_name").alias("unique_tables"), F.coalesce(F.max(named)["table_name"], F.lit("")).alias("top_table")
    )
    rows = LOCK_HOUR.merged(partials, HOUR_KEYS).join(tables, HOUR_KEYS)
    return calendar_flags(
        rows.select(
            *HOUR_KEYS,
            F.col("n").alias("total_lock_events"),
            F.col("deadlocks").alias("total_deadlocks"),
            F.col("timeouts").alias("total_timeouts"),
            mean("wait").alias("avg_lock_wait_time"),
            F.col("high_lock_wait_time").alias("max_lock_wait_time"),
            F.col("low_lock_wait_time").alias("min_lock_wait_time"),
            p95("lock_wait_time").alias("approx_p95_lock_wait_time"),
            mean("held").alias("avg_lock_time"),
            F.col("high_lock_time").alias("max_lock_time"),
            "unique_tables",
            "top_table",
            *[estimate(c).alias(f"approx_{a}") for c, a in (("session_id", "sessions"), ("transaction_id", "transactions"), ("user_name", "users"))],
            (F.col("n") / 60).alias("lock_intensity"),
            F.col("deadlocks").cast("double").alias("deadlock_rate"),
        )
    )


def lock_table_daily(partials: DataFrame) -> DataFrame:
    by_day = Window.partitionBy("table_name").orderBy("event_date")
    rows = LOCK_TABLE_DAY.merged(partials).select(
        "event_date",
        "table_name",
        F.col("n").alias("lock_count"),
        F.col("deadlocks").alias("deadlock_count"),
        F.col("timeouts").alias("timeout_count"),
        mean("wait").alias("avg_lock_wait_time"),
        F.col("high_lock_wait_time").alias("max_lock_wait_time"),
        p95("lock_wait_time").alias("approx_p95_lock_wait_time"),
        mean("held").alias("avg_lock_time"),
        F.col("high_lock_time").alias("max_lock_time"),
        *[estimate(c).alias(f"approx_{a}") for c, a in (("session_id", "sessions"), ("transaction_id", "transactions"), ("user_name", "users"))],
    )
    growth = pct_change(F.lag("lock_count").over(by_day), "lock_count")
    return rows.withColumn("growth_rate", F.coalesce(growth, F.lit(0.0)))


def lock_user_daily(partials: DataFrame) -> DataFrame:
    return LOCK_USER_DAY.merged(partials).select(
        "event_date",
        "user_name",
        F.col("n").alias("lock_count"),
        F.col("deadlocks").alias("deadlock_count"),
        F.col("timeouts").alias("timeout_count"),
        mean("wait").alias("avg_lock_wait_time"),
        F.col("high_lock_wait_time").alias("max_lock_wait_time"),
        estimate("table_name").alias("approx_tables"),
        estimate("session_id").alias("approx_sessions"),
    )


def techlog_hourly(partials: DataFrame) -> DataFrame:
    return TECHLOG_HOUR.merged(partials).select(
        "event_date",
        "hour",
        F.col("n").alias("total_queries"),
        mean("duration_sum").alias("avg_duration"),
        F.col("high_duration").alias("max_duration"),
        p95("duration").alias("approx_p95_duration"),
        F.col("waited").alias("total_wait_time"),
        mean("waited").alias("avg_wait_time"),
        F.col("locked").alias("total_lock_time"),
        mean("locked").alias("avg_lock_time"),
        F.coalesce("locks", F.lit(0)).alias("lock_count"),
        F.coalesce("errors", F.lit(0)).alias("errors"),
        *[estimate(c).alias(f"approx_{a}") for c, a in (("session", "sessions"), ("user_name", "users"), ("computer", "computers"))],
    )


def _rolling(view: View, partials: DataFrame) -> DataFrame:
    """Merged statistics of each hour that ends on a quarter; a quarter counts for the four hours it is in."""
    ends = F.explode(F.sequence(F.col("quarter") + 1, F.col("quarter") + 4))
    rows = view.merged(partials.withColumn("_end", ends), ["_end"])
    return rows.withColumn("as_of", from_epoch_micros(F.col("_end") * QUARTER))


def rolling_last_hour(partials: DataFrame) -> DataFrame:
    """Lock statistics of the last hour, renewed every 15 minutes."""
    return _rolling(LOCK_QUARTER, partials).select(
        "as_of",
        F.col("n").alias("total_locks"),
        "deadlocks",
        "timeouts",
        (mean("wait") / 1000).alias("avg_wait_ms"),
        (F.col("high_lock_wait_time") / 1000).alias("max_wait_ms"),
        estimate("table_name").alias("approx_tables"),
        estimate("session_id").alias("approx_sessions"),
    )


def rolling_risk(partials: DataFrame, days: int = 7) -> DataFrame:
    """Risk of the last hour, renewed every 15 minutes: statistics, the week's trend, score, level and warnings.

    The trend compares the halves of the days on which the span of ``days`` before the
    quarter has events.  It comes from sums per day and per quarter: the first day counts from
    the span's start on, the last one up to its end.  A trend reads at most ``days`` + 1
    rows per end, whatever the number of events.
    """
    day = DAY_QUARTERS
    quarters = LOCK_QUARTER.merged(partials).select("quarter", "wait", "seen_wait")
    inside = Window.partitionBy("_day").orderBy("quarter").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        quarters.withColumn("_day", F.floor(F.col("quarter") / day))
        .withColumns({"_wait": F.sum("wait").over(inside), "_seen": F.sum("seen_wait").over(inside)})
    )
    # What a day held up to each of its quarters, an array of at most 96.
    so_far = F.sort_array(F.collect_list(F.struct("quarter", "_wait", "_seen")))
    daily = running.groupBy("_day").agg(so_far.alias("_so_far"))
    statistics = rolling_last_hour(partials).withColumn("_end", (epoch_micros("as_of") / QUARTER).cast("bigint"))
    start = F.col("_end") - days * day
    spans = statistics.select("_end", F.explode(F.sequence(F.floor(start / day), F.floor((F.col("_end") - 1) / day))).alias("_day"))

    def before(bound: Column, c: str) -> Column:
        earlier = F.filter("_so_far", lambda q: q["quarter"] < bound)
        return F.coalesce(F.try_element_at(F.transform(earlier, lambda q: q[c]), F.lit(-1)), F.lit(0))

    shares = spans.join(daily, "_day").withColumns(
        {out: before(F.col("_end"), c) - before(start, c) for out, c in (("_w", "_wait"), ("_s", "_seen"))}
    )
    means = shares.filter(F.col("_s") > 0).select("_end", F.col("_day").alias("date"), (F.col("_w") / F.col("_s")).alias("avg_wait"))
    trend = trend_of_days(means, keys=("_end",)).select("_end", "trend_pct")
    return score_hourly(statistics.join(trend, "_end", "left").drop("_end"))


def rolling_sessions(partials: DataFrame) -> DataFrame:
    """Session statistics of the last hour, renewed every 15 minutes."""
    return _rolling(SESSION_QUARTER, partials).select(
        "as_of",
        F.col("n").alias("sessions"),
        estimate("user_name").alias("approx_users"),
        mean("duration_sum").alias("avg_duration"),
        "deadlocks",
        "exceptions",
        "timeouts",
    )


def conflict_pairs(partials: DataFrame) -> DataFrame:
    """Conflicting table pairs per second, from the counts of all batches."""
    return pair_counts(SECOND.merged(partials), ("second",))
