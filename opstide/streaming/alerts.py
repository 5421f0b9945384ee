"""Alert states and notifications of a stream of samples, right in any order of arrival.

Samples are stored as they come and judged when read: a late sample may end or
join a run that later samples were part of, so what was said of them before
cannot stand. Reading works by time slices and splits a busy label.

Who wants each change of state at once and once only takes ``run_transitions``:
it keeps one row of state per label set and judges every sample as it comes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timeparts import epoch_micros
from ..operators.sliced import hold_for, lag_across_slices, notification_times
from ..session import remove
from ..sinks.tables import exists
from .rollups import run_partials


def run_samples(samples: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Store every micro-batch below ``path``; a replayed batch overwrites its own folder."""
    return run_partials(samples, lambda batch: batch, path, checkpoint)


def alert_states(stored: DataFrame, labels: list[str], condition: Column, seconds: int) -> DataFrame:
    """Inactive, pending, or firing once the condition has held, for every stored sample."""
    return hold_for(stored.drop("batch"), labels, condition, seconds)


def notifications(stored: DataFrame, labels: list[str], repeat_hours: int = 24) -> DataFrame:
    """The first alert of a group, then the first one at least ``repeat_hours`` after the last announcement."""
    return notification_times(stored, labels, repeat_hours)


STATE = ["last_ts", "state", "run_start"]


def transitions(samples: DataFrame, states: DataFrame | None, labels: list[str], condition: Column, seconds: int) -> tuple[DataFrame, DataFrame]:
    """(changes, new states) after further samples.

    ``states`` has one row per label set: ``last_ts``, ``state`` and the
    ``run_start`` of an open run. A change is the first sample of a state that
    differs from the one before it (inactive before any sample). Samples that
    are not newer than ``last_ts`` are late; they are left to the stored form.
    An open run enters as one sample at its start, so a busy label is split
    into time slices here as well.
    """
    rows = samples.select(*labels, "ts", F.coalesce(condition, F.lit(False)).alias("_on"), F.lit(None).cast("string").alias("_was")).where("ts is not null")
    if states is not None:
        known = states.select(*[F.col(c).alias(f"_k_{c}") for c in labels], "last_ts")
        same = F.lit(True)
        for c in labels:
            same = same & rows[c].eqNullSafe(known[f"_k_{c}"])
        rows = rows.join(known, same, "left").where("last_ts is null or ts > last_ts").select(*labels, "ts", "_on", "_was")
        open_ = states.where("state <> 'inactive'")
        rows = rows.unionByName(open_.select(*labels, F.col("run_start").alias("ts"), F.lit(True).alias("_on"), F.col("state").alias("_was")))
    judged = hold_for(rows, labels, F.col("_on"), seconds).withColumn("state", F.coalesce("_was", "state"))
    judged = lag_across_slices(judged.withColumn("_t", epoch_micros("ts")), labels, "state", "_before")
    changed = (F.col("state") != F.coalesce("_before", F.lit("inactive"))) & F.col("_was").isNull()
    changes = judged.where(changed).select(*labels, "ts", "state", "run_start")
    fresh = judged.where("_was is null").groupBy(*labels).agg(F.max_by(F.struct("ts", "state", "run_start"), "ts").alias("_last"))
    fresh = fresh.select(*labels, F.col("_last.ts").alias("last_ts"), "_last.state", "_last.run_start")
    if states is not None:
        both = states.select(*labels, *STATE).unionByName(fresh)
        fresh = both.groupBy(*labels).agg(F.max_by(F.struct(*STATE), "last_ts").alias("_row")).select(*labels, "_row.*")
    return changes, fresh


def run_transitions(
    samples: DataFrame, path: str, checkpoint: str, labels: list[str], condition: Column, seconds: int
) -> StreamingQuery:
    """Append each change of alert state below ``path`` as its sample comes, each once.

    The state after a batch stands in ``_state/batch=N``, one row per label
    set; the next batch reads it, and a replayed batch reads what it read
    before and overwrites its own folders. Only the last two states are kept.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        spark, before = batch.sparkSession, f"{path}/_state/batch={batch_id - 1}"
        states = spark.read.parquet(before) if batch_id and exists(spark, before) else None
        changes, after = transitions(batch, states, labels, condition, seconds)
        after.write.mode("overwrite").parquet(f"{path}/_state/batch={batch_id}")
        changes.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        if batch_id > 1:
            remove(spark, f"{path}/_state/batch={batch_id - 2}")

    return (
        samples.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
