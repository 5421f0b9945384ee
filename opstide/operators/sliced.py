"""Range functions over long label series without one task per series.

A series may hold any share of all samples, so it is cut into time slices and
every window runs per (series, slice).  What has to cross slice borders - running
sums, the previous sample, the start of a run - is carried by one summary row per
slice, so the only windows over a whole series hold one row per slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparts import AsOf, epoch_micros, from_epoch_micros, ts_literal, within
from ..session import materialise, remove_since, written

SECOND = 1_000_000
HOUR = 3_600
DAY = 86_400


def _slice(seconds: int, time: str = "_t") -> Column:
    return F.floor(F.col(time) / (seconds * SECOND))


def trailing_sums(
    df: DataFrame,
    labels: list[str],
    ranges: dict[str, int],
    values: dict[str, Column],
    *,
    closed: bool = True,
    slice_seconds: int = HOUR,
) -> DataFrame:
    """Sums of ``values`` over the trailing ``ranges`` (name -> seconds) of each sample.

    Adds a column ``<value>_<range>`` per pair; needs ``_t`` (microseconds).  A
    sum over ``[t - w, t]`` (``closed``) or ``(t - w, t]`` is the running sum at
    ``t`` minus the running sum at ``t - w``.  So each sample puts itself at ``t``
    and one empty marker at ``t - w`` into the series, wherever that slice is, and
    the cost does not depend on how many samples a range holds.
    """
    marker_rank = -1 if closed else 1
    points = [F.struct(F.lit("").alias("_kind"), F.col("_t").alias("_at"), F.lit(0).alias("_rank"))]
    for name, seconds in ranges.items():
        at = F.col("_t") - seconds * SECOND
        points.append(F.struct(F.lit(name).alias("_kind"), at.alias("_at"), F.lit(marker_rank).alias("_rank")))
    weights = {name: F.when(F.col("_kind") == "", F.col(name)).otherwise(0) for name in values}
    laid_out = (
        df.select(*labels, "_t", *[v.cast("double").alias(name) for name, v in values.items()])
        .select("*", F.inline(F.array(*points)))
        .withColumns(weights)
        .withColumn("_cut", _slice(slice_seconds, "_at"))
    )
    earlier = Window.partitionBy(*labels).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        laid_out.groupBy(*labels, "_cut")
        .agg(*[F.sum(name).alias(name) for name in values])
        .select(
            *labels, "_cut", *[F.coalesce(F.sum(name).over(earlier), F.lit(0.0)).alias(f"_before_{name}") for name in values]
        )
    )
    # Peers (equal time and rank) are included, so all samples at one time see the same sum.
    inside = Window.partitionBy(*labels, "_cut").orderBy("_at", "_rank").rangeBetween(Window.unboundedPreceding, 0)
    running = laid_out.withColumns({name: F.sum(name).over(inside) for name in values}).join(carry, [*labels, "_cut"])

    def at_point(name: str, kind: str) -> Column:
        return F.max(F.when(F.col("_kind") == kind, F.col(name) + F.col(f"_before_{name}")))

    sums = running.groupBy(*labels, "_t").agg(
        *[(at_point(n, "") - at_point(n, r)).alias(f"{n}_{r}") for n in values for r in ranges]
    )
    return df.join(sums, [*labels, "_t"])


def control_chart(
    samples: DataFrame, as_of: AsOf, labels: list[str], days: int = 7, sigmas: float = 3.0, last_days: int | None = None
) -> DataFrame:
    """Trailing mean and population deviation per sample, the control band and the alarm.

    With ``last_days`` the chart holds only the samples of that span before ``as_of``,
    and reads no more than the range of its first one.
    """
    read = None if last_days is None else days + last_days
    rows = samples.filter(F.col("ts") <= ts_literal(as_of)) if read is None else within(samples, "ts", as_of, days=read)
    # Values are taken relative to the series' rounded mean: the squares stay small
    # and whole-number series are summed without any rounding.
    centres = rows.groupBy(*labels).agg(F.round(F.avg("value")).alias("_a"))
    timed = rows.join(centres, labels).withColumn("_t", epoch_micros("ts"))
    # Backwards in time the previous value is the next one: a stretch is constant when no sample but its last
    # differs from the next, whatever rounding leaves of its variance.
    turned = lag_across_slices(timed.withColumn("_t", -F.col("_t")), labels, "value", "_next")
    timed = turned.withColumn("_t", -F.col("_t"))
    differs = F.coalesce(F.col("value") != F.col("_next"), F.lit(False)).cast("int")
    x = F.col("value") - F.col("_a")
    sums = trailing_sums(timed, labels, {"w": days * DAY}, {"_n": F.lit(1), "_s1": x, "_s2": x * x, "_ch": differs})
    if last_days is not None:
        sums = within(sums, "ts", as_of, days=last_days)
    n = F.col("_n_w")
    mean = F.col("_s1_w") / n
    square = F.col("_s2_w") / n
    variance = square - mean * mean
    constant = F.col("_ch_w") == differs
    spread = F.sqrt(F.when(constant, 0.0).otherwise(F.greatest(variance, F.lit(0.0))))
    chart = sums.select(*labels, "ts", "value", (F.col("_a") + mean).alias("mean"), spread.alias("std"))
    distance = F.try_divide(F.abs(F.col("value") - F.col("mean")), F.col("std"))
    return chart.withColumns(
        {
            "upper": F.col("mean") + sigmas * F.col("std"),
            "lower": F.col("mean") - sigmas * F.col("std"),
            "sigma": distance,
            "alarm": F.coalesce(distance > sigmas, F.lit(False)),
        }
    )


def lag_across_slices(df: DataFrame, labels: list[str], value: str, out: str, seconds: int = HOUR) -> DataFrame:
    """Previous value of the series (needs ``_t``); the first row of a slice takes the
    last value of the nearest earlier slice that has rows."""
    cut = df.withColumn("_cut", _slice(seconds))
    carry = (
        cut.groupBy(*labels, "_cut")
        .agg(F.max_by(value, "_t").alias("_last"))
        .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*labels).orderBy("_cut")))
        .drop("_last")
    )
    inside = Window.partitionBy(*labels, "_cut").orderBy("_t")
    first = F.row_number().over(inside) == 1
    return (
        cut.join(carry, [*labels, "_cut"])
        .withColumn(out, F.when(first, F.col("_carry")).otherwise(F.lag(value).over(inside)))
        .drop("_carry", "_cut")
    )


def counter_increase(samples: DataFrame, labels: list[str]) -> DataFrame:
    """Increase since the previous sample; a drop means the counter restarted from zero."""
    timed = samples.withColumn("_t", epoch_micros("ts"))
    rows = lag_across_slices(timed, labels, "value", "_prev")
    change = F.col("value") - F.col("_prev")
    return rows.withColumn(
        "increase", F.when(change < 0, F.col("value")).otherwise(F.coalesce(change, F.lit(0.0)))
    ).drop("_prev")


def counter_rate(
    samples: DataFrame, labels: list[str], short: int = HOUR, long: int = DAY, factor: float = 1.5
) -> DataFrame:
    """Per-second counter rates over the trailing ``(t - w, t]`` of a short and a long
    range, and whether their ratio passes ``factor``."""
    ranges = {"short": short, "long": long}
    sums = trailing_sums(
        counter_increase(samples, labels), labels, ranges, {"_inc": F.col("increase")}, closed=False
    )
    rates = [(F.col(f"_inc_{r}") / seconds).alias(f"rate_{r}") for r, seconds in ranges.items()]
    ratio = F.try_divide("rate_short", "rate_long")
    return (
        sums.select(*samples.columns, *rates)
        .withColumn("ratio", ratio)
        .withColumn("alarm", F.coalesce(F.col("ratio") > factor, F.lit(False)))
    )


def condition_runs(df: DataFrame, labels: list[str], condition: Column, seconds: int = HOUR) -> DataFrame:
    """Start time (``run_start``) of the unbroken run of true samples each sample is in."""
    rows = df.withColumns({"_t": epoch_micros("ts"), "_c": F.coalesce(condition, F.lit(False))}).withColumn(
        "_cut", _slice(seconds)
    )
    inside = Window.partitionBy(*labels, "_cut").orderBy("_t")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    begins = F.col("_c") & ~F.coalesce(F.lag("_c").over(inside), F.lit(False))
    local = rows.withColumns(
        {
            "_begin": F.last(F.when(begins, F.col("ts")), ignorenulls=True).over(so_far),
            "_clean": F.min("_c").over(so_far),
        }
    )
    # One summary row per slice; `_exit` is the run still open at the end of the slice.
    summary = local.groupBy(*labels, "_cut").agg(
        F.min("_c").alias("_all"),
        F.max_by("_c", "_t").alias("_open"),
        F.max_by("_begin", "_t").alias("_begin_last"),
        F.min("ts").alias("_first"),
    )
    slices = Window.partitionBy(*labels).orderBy("_cut")
    enters_open = F.coalesce(F.lag("_open").over(slices), F.lit(False))
    known = (
        F.when(~F.col("_open"), F.struct(F.lit(None).cast("timestamp_ntz").alias("at")))
        .when(~F.col("_all"), F.struct(F.col("_begin_last").alias("at")))
        .when(~F.col("_entered"), F.struct(F.col("_first").alias("at")))
    )
    exits = F.last("_known", ignorenulls=True).over(slices.rowsBetween(Window.unboundedPreceding, 0))["at"]
    carried = (
        summary.withColumn("_entered", enters_open)
        .withColumn("_known", known)
        .withColumn("_exit", exits)
        .withColumn("_carry", F.lag("_exit").over(slices))
        .select(*labels, "_cut", "_carry")
    )
    start = F.when(F.col("_clean") & F.col("_carry").isNotNull(), F.col("_carry")).otherwise(F.col("_begin"))
    return (
        local.join(carried, [*labels, "_cut"])
        .withColumn("run_start", F.when(F.col("_c"), start))
        .select(*df.columns, F.col("_c").alias("condition"), "run_start")
    )


def hold_for(df: DataFrame, labels: list[str], condition: Column, seconds: int) -> DataFrame:
    """Alert state per sample: inactive, pending, or firing once held for ``seconds``."""
    held = epoch_micros("ts") - epoch_micros("run_start") >= seconds * SECOND
    state = F.when(~F.col("condition"), "inactive").when(held, "firing").otherwise("pending")
    return condition_runs(df, labels, condition).withColumn("state", state)


def successors(times: DataFrame, labels: list[str], step: int, slice_seconds: int = HOUR) -> DataFrame:
    """(labels, _t, _next): for each time of a series the first one at least ``step`` microseconds later, null if none.

    Each time puts itself and a mark ``step`` later into the series. Looking
    forward, a mark sees the first time of its own slice; where its slice has
    none any more, the first time of the next slice that has one, which is one
    row per slice.
    """
    point = F.struct(F.col("_t").alias("_at"), F.lit(None).cast("long").alias("_mark"))
    mark = F.struct((F.col("_t") + step).alias("_at"), F.col("_t").alias("_mark"))
    laid_out = times.select(*labels, F.inline(F.array(point, mark))).withColumn("_cut", _slice(slice_seconds, "_at"))
    forward = Window.partitionBy(*labels, "_cut").orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, 0)
    seen = F.min(F.when(F.col("_mark").isNull(), F.col("_at")))
    later = Window.partitionBy(*labels).orderBy("_cut").rowsBetween(1, Window.unboundedFollowing)
    carry = laid_out.groupBy(*labels, "_cut").agg(seen.alias("_first")).select(
        *labels, "_cut", F.first("_first", ignorenulls=True).over(later).alias("_carry")
    )
    marks = laid_out.withColumn("_seen", seen.over(forward)).where("_mark is not null")
    return marks.join(carry, [*labels, "_cut"]).select(*labels, F.col("_mark").alias("_t"), F.coalesce("_seen", "_carry").alias("_next"))


def notification_times(alerts: DataFrame, labels: list[str], repeat_hours: int = 24) -> DataFrame:
    """Times at which a firing group is announced: the first alert, then the first
    alert at least ``repeat_hours`` after the previous announcement.

    Each distinct alert time, to the microsecond, points to the one that would
    follow it. What the first one leads to is found by doubling: who is reached
    within 2^k steps and the pointers of 2^k steps give those of 2^(k+1). So no
    group meets in one task, and the rounds are the logarithm of a group's
    announcements. Rows without a time are no alerts; null labels are a group.
    """
    step, mark = repeat_hours * 3600 * SECOND, written()
    # joins by one text, so that null labels meet as well
    group = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in labels]), {"ignoreNullFields": "false"})
    times = alerts.select(*labels, group.alias("_g"), epoch_micros("ts").alias("_t")).where("_t is not null")
    named = materialise(times.groupBy("_g").agg(*[F.first(c).alias(c) for c in labels], F.min("_t").alias("_t")), "alert-groups")
    pointers = materialise(successors(times.select("_g", "_t").distinct(), ["_g"], step), "alert-pointers")
    # only times that something points to can be reached, beside the first ones
    reached = named.select("_g", "_t")
    targets = pointers.where("_next is not null").select("_g", F.col("_next").alias("_t")).distinct()
    pointers = materialise(pointers.join(targets.unionByName(reached).distinct(), ["_g", "_t"], "left_semi"), "alert-pointers")
    while not (open_ := pointers.where("_next is not null")).isEmpty():
        ahead = reached.join(open_, ["_g", "_t"]).select("_g", F.col("_next").alias("_t"))
        reached = materialise(reached.unionByName(ahead).distinct(), "alerts-reached")
        further = open_.select("_g", F.col("_t").alias("_next"), F.col("_next").alias("_further"))
        pointers = materialise(open_.join(further, ["_g", "_next"]).select("_g", "_t", F.col("_further").alias("_next")), "alert-pointers")
        remove_since(alerts.sparkSession, mark, named, reached, pointers)
    found = reached.join(named.drop("_t"), "_g")
    return found.select(*labels, from_epoch_micros(F.col("_t")).alias("notified_at"))
