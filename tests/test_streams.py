"""Streams against their batch forms, in several micro-batches and after restarts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opstide.operators import rollups as R
from opstide.operators import sliced as S
from opstide.operators.joins import conflict_pairs
from opstide.sources.logs import stream_log_lines
from opstide.streaming import alerts as A
from opstide.streaming import compaction as C
from opstide.streaming import ingest as I
from opstide.streaming import rollups as SR


def in_steps(spark, df, path, parts, order):
    """Write a frame as several files in time order and read it as a stream of one file each."""
    ordered = df.orderBy(order)
    n = df.count()
    numbered = ordered.rdd.zipWithIndex().collect()
    for p in range(parts):
        chunk = [r for r, i in numbered if i * parts // n == p]
        spark.createDataFrame(chunk, df.schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def stored(stream, shape, path):
    SR.run_partials(stream, shape, path, f"{path}__cp").awaitTermination()
    return stream.sparkSession.read.parquet(path)


def backwards(df):
    """Late files: the newest rows come first."""
    return F.desc("event_datetime") if "event_datetime" in df.columns else F.desc("ts")


def test_rollups_equal_batch_with_late_files(spark, inputs, tmp_path):
    events = inputs.lock_events
    views = [
        (SR.lock_hour_partials, SR.lock_hourly, R.lock_hourly),
        (SR.lock_table_day_partials, SR.lock_table_daily, R.lock_table_daily),
        (SR.lock_user_day_partials, SR.lock_user_daily, R.lock_user_daily),
    ]
    for n, (shape, merge, batch) in enumerate(views):
        stream = in_steps(spark, events, str(tmp_path / f"in{n}"), 4, backwards(events))
        got = merge(stored(stream, shape, str(tmp_path / f"out{n}")))
        got = got.drop(*[c for c in got.columns if c.startswith("approx_")])
        want = batch(events).select(*got.columns)
        assert got.count() == want.count() > 0
        rounded = lambda df: df.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in df.dtypes])
        assert rounded(got).exceptAll(rounded(want)).count() == 0


def test_ingestion_restarts_without_repeats(spark, tmp_path):
    folder, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()

    def run():
        stream = I.session_event_stream(stream_log_lines(spark, str(folder)))
        I.run_to_table(stream, out, checkpoint).awaitTermination()
        return spark.read.parquet(out).count()

    (folder / "24010100.log").write_text("20240101 00:00:01.000,CALL,session=1\njunk\n")
    assert run() == 1
    assert run() == 1
    (folder / "24010101.log").write_text("20240101 01:00:01.000,CALL,session=2\n20240101 01:00:02.000,CALL,session=3\n")
    assert run() == 3


def test_repeated_lines_are_dropped(spark, tmp_path):
    """Lines read again are dropped however late; equal lines of two files and lines that differ late in the text are not."""
    folder, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "cp")
    folder.mkdir()
    long = "x" * 1200
    lines = "".join(f"20240101 00:00:0{i}.000,CALL,session={i}\n" for i in range(5))
    lines += f"20240101 00:00:09.000,CALL,session=9,text={long}a\n20240101 00:00:09.000,CALL,session=9,text={long}b\n"

    def run(name):
        stream = stream_log_lines(spark, str(folder), max_files=1).withColumn("file", F.lit(name))
        I.run_deduplicated(stream, I.session_event_stream, out, checkpoint).awaitTermination()
        return spark.read.parquet(out).count()

    (folder / "24010100.log").write_text(lines + lines)
    assert run("a") == 7
    (folder / "24010101.log").write_text("20240301 00:00:01.000,CALL,session=1\n" + lines)
    assert run("a") == 8
    (folder / "24010102.log").write_text(lines)
    assert run("b") == 15


def test_alert_states_in_any_order(spark, inputs, tmp_path):
    samples = inputs.alerts.select(F.col("alertname").alias("instance"), "ts", "value")
    stream = in_steps(spark, samples, str(tmp_path / "in"), 5, backwards(samples))
    got = A.alert_states(stored(stream, lambda b: b, str(tmp_path / "out")), ["instance"], F.col("value") > 20, 3600)
    batch = S.hold_for(samples, ["instance"], F.col("value") > 20, 3600).select(*got.columns)
    assert got.count() == samples.count()
    assert got.exceptAll(batch).count() == 0


def test_conflicts_with_late_files(spark, inputs, tmp_path):
    events = inputs.lock_events.withColumn("event_datetime", F.date_trunc("minute", "event_datetime").cast("timestamp_ntz"))
    crowded = events.withColumn("event_datetime", F.timestamp_add("MINUTE", -F.minute("event_datetime"), "event_datetime"))
    stream = in_steps(spark, crowded, str(tmp_path / "in"), 3, backwards(crowded))
    got = SR.conflict_pairs(stored(stream, SR.second_partials("LOCK"), str(tmp_path / "pairs")))
    batch = conflict_pairs(crowded, "LOCK", "2024-12-31 00:00:00", days=4000)
    totals = got.groupBy("table1", "table2").agg(F.sum("conflicts").alias("conflicts"))
    assert batch.count() > 0 and totals.exceptAll(batch).count() == 0 and totals.count() == batch.count()


def test_upserts_are_idempotent(spark, inputs, tmp_path):
    events = inputs.events
    stream = in_steps(spark, events, str(tmp_path / "in"), 3, "event_id")
    counts = stream.groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("last")).withColumn("part", F.lit(1))
    path = str(tmp_path / "out")
    I.run_upserts(counts, path, str(tmp_path / "cp"), ["event_type"], "last", "part").awaitTermination()
    got = {r["event_type"]: r["n"] for r in spark.read.parquet(path).collect()}
    want = {r["event_type"]: r["count"] for r in events.groupBy("event_type").count().collect()}
    assert got == want


def test_parse_counters_in_progress(spark, tmp_path):
    folder, out = tmp_path / "logs", str(tmp_path / "out")
    folder.mkdir()
    (folder / "24010100.log").write_text("20240101 00:00:01.000,CALL,session=1\njunk\n\n")
    stream = I.session_event_stream(I.observed_lines(stream_log_lines(spark, str(folder))))
    query = I.run_to_table(stream, out, str(tmp_path / "cp"))
    query.awaitTermination()
    seen = [p.observedMetrics["parse_stats"] for p in query.recentProgress if p.observedMetrics]
    assert [sum(getattr(m, c) for m in seen) for c in ("lines", "parsed", "blank")] == [3, 1, 1]


def test_hours_ignore_the_session_zone(spark, inputs, tmp_path):
    events = inputs.lock_events
    stream = in_steps(spark, events, str(tmp_path / "in"), 2, "event_datetime")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = SR.rolling_last_hour(stored(stream, SR.lock_quarter_partials, str(tmp_path / "out")))
        total = got.agg(F.sum("total_locks")).first()[0]
        assert total == 4 * events.count()
        first = events.agg(F.min("event_datetime")).first()[0]
        assert dt.timedelta() < got.agg(F.min("as_of")).first()[0] - first <= dt.timedelta(minutes=15)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_notifications_in_any_order(spark, inputs, tmp_path):
    labels = ["alertname", "instance"]
    stream = in_steps(spark, inputs.alerts, str(tmp_path / "in"), 6, backwards(inputs.alerts))
    got = A.notifications(stored(stream, lambda b: b, str(tmp_path / "out")), labels)
    batch = S.notification_times(inputs.alerts, labels)
    assert got.count() == batch.count() > 0 and got.exceptAll(batch).count() == 0


def test_notifications_are_exact_to_the_microsecond(spark):
    rows = [("a", dt.datetime(2024, 1, 1, 10, 0, 59)), ("a", dt.datetime(2024, 1, 2, 10, 0, 1)), ("a", dt.datetime(2024, 1, 2, 10, 0, 59, 1))]
    got = S.notification_times(spark.createDataFrame(rows, "g string, ts timestamp_ntz"), ["g"]).collect()
    assert sorted(r["notified_at"] for r in got) == [rows[0][1], rows[2][1]]


def folders(path):
    return sorted(p.name for p in path.iterdir() if not p.name.startswith((".", "_")))


def test_compaction_changes_nothing(spark, inputs, tmp_path):
    """Reads before, between and after maintenance runs, a replayed batch, a crash before the switch, and new batches after it."""
    events, path = inputs.lock_events, tmp_path / "out"
    stream = in_steps(spark, events, str(tmp_path / "in"), 11, backwards(events))
    SR.run_partials(stream, SR.lock_hour_partials, str(path), str(tmp_path / "cp")).awaitTermination()
    drop = lambda df: df.drop(*[c for c in df.columns if c.startswith("approx_p")])
    # sums of doubles may differ in the last digit with the order of the batches
    read = lambda: sorted(repr([round(v, 6) if isinstance(v, float) else v for v in r]) for r in drop(SR.lock_hourly(C.read_partials(spark, str(path)))).collect())
    want = read()
    store = C.Store(spark, str(path))
    opened = store.units(store.current()[1])
    assert len(opened) == 11 and len(want) > 100
    # another fan-out in a second run: levels grow on those of the first
    assert C.compact(spark, str(path), SR.LOCK_HOUR.merged, fanout=3, through=5) == 2
    assert read() == want and len(folders(path)) == 11
    # readers of the manifest before it still find their folders
    assert store.read(opened).count() > 0
    (path / "_segments" / "1-0-99-left-by-a-crash").mkdir()
    assert C.compact(spark, str(path), SR.LOCK_HOUR.merged, fanout=3) == 2
    assert read() == want
    version, segments = store.current()
    assert version == 2 and [(s.level, s.first, s.last) for s in segments] == [(2, 0, 8)]
    assert [(u.level, u.first) for u in store.units(segments)] == [(2, 0), (0, 9), (0, 10)]
    assert not (path / "_segments" / "1-0-99-left-by-a-crash").exists()
    assert folders(path) == ["batch=10", "batch=6", "batch=7", "batch=8", "batch=9"]
    # a replay of a merged batch is not read
    SR.lock_hour_partials(events).write.mode("overwrite").parquet(f"{path}/batch=2")
    assert read() == want
    # a manifest that is only half written is passed over, and no two runs write the same one
    (path / "_manifest" / "000000000003.json").write_text('{"segments": [')
    assert read() == want and store.current()[0] == 2
    with pytest.raises(Exception, match="(?i)exist"):
        store.switch(3, segments)
    (path / "_manifest" / "000000000003.json").unlink()
    # batches after it count
    SR.lock_hour_partials(events).write.parquet(f"{path}/batch=11")
    assert SR.LOCK_HOUR.merged(C.read_partials(spark, str(path))).agg(F.sum("n")).first()[0] == 2 * events.count()


def test_opened_folders_grow_with_the_logarithm(spark, tmp_path):
    path = str(tmp_path / "out")
    most = 0
    for n in range(40):
        spark.range(n, n + 1).coalesce(1).write.parquet(f"{path}/batch={n}")
        C.compact(spark, path, lambda rows: rows, fanout=3)
        store = C.Store(spark, path)
        most = max(most, len(store.units(store.current()[1])))
    assert most <= 3 * 4 and sorted(r[0] for r in C.read_partials(spark, path).collect()) == list(range(40))
    assert len(folders(tmp_path / "out")) <= 2 * 3 + 3


def test_records_are_known_by_file_and_place(spark, tmp_path):
    """Equal genuine lines stay two; a file read again adds none, a grown one only what is new; copies in one batch are one."""
    folder, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "cp")

    def put(name, text):
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text)

    def run():
        stream = I.stream_placed_lines(spark, str(folder))
        I.run_positioned(stream, I.lock_event_stream, out, checkpoint, fanout=2).awaitTermination()
        found = spark.read.parquet(out).groupBy("file").count().collect()
        return {r["file"]: r["count"] for r in found}

    line = "20240101 00:00:01.000 LOCK,1,session=1,\ntableName=_T1,lockTime=5\n"
    put("a/24010100.log", line + line)
    assert run() == {"24010100.log": 2}
    put("b/24010100.log", line + line)
    assert run() == {"24010100.log": 2}
    put("c/24010100.log", line + line + line)
    put("d/24010100.log", line + line)
    put("c/24010101.log", line)
    assert run() == {"24010100.log": 3, "24010101.log": 1}
    put("e/24010100.log", line * 3)
    put("e/24010101.log", line * 2)
    put("e/24010102.log", "no record\n")
    assert run() == {"24010100.log": 3, "24010101.log": 2}
    put("f/24010101.log", line * 4)
    assert run() == {"24010100.log": 3, "24010101.log": 4}
    rows = spark.read.parquet(out)
    assert {r["table_name"] for r in rows.select("table_name").distinct().collect()} == {"_T1"}
    # one row per file, in a bounded number of folders
    seen = C.Store(spark, f"{out}/_files")
    known = I.FILE_LINES.merged(C.read_partials(spark, f"{out}/_files"))
    assert {r["file"]: r["high_n_lines"] for r in known.collect()} == {"24010100.log": 6, "24010101.log": 8, "24010102.log": 1}
    assert seen.current()[0] > 0


def test_alert_transitions_equal_held_conditions(spark, inputs, tmp_path):
    """Changes of state as they come, in several batches with a restart, equal those of all samples at once; late ones are left."""
    samples = inputs.events.select(F.col("event_type").alias("instance"), "ts", "value").where("event_id % 3 = 0")
    stream = in_steps(spark, samples, str(tmp_path / "in"), 5, F.col("ts"))
    out, checkpoint, on = str(tmp_path / "out"), str(tmp_path / "cp"), F.col("value") > 20
    for _ in range(2):
        A.run_transitions(stream, out, checkpoint, ["instance"], on, 1800).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("instance", "ts", "state").collect())
    want, before = [], {}
    for r in S.hold_for(samples, ["instance"], on, 1800).orderBy("instance", "ts").collect():
        if r["state"] != before.get(r["instance"], "inactive"):
            want.append((r["instance"], r["ts"], r["state"]))
        before[r["instance"]] = r["state"]
    assert got == want and len({s for _, _, s in got}) == 3
    # state: one row per label set, of the last two batches only
    names = sorted(p.name for p in (tmp_path / "out" / "_state").iterdir())
    assert names == ["batch=3", "batch=4"]
    assert spark.read.parquet(f"{out}/_state/batch=4").count() == len(before)
    # a late sample changes nothing, a new label set and a newer sample do
    rows = [("error", dt.datetime(2000, 1, 1), 99.0), ("new", dt.datetime(2000, 1, 1), 99.0), ("new", dt.datetime(2000, 1, 1, 1), 99.0)]
    late = spark.createDataFrame(rows, "instance string, ts timestamp_ntz, value double")
    changes, states = A.transitions(late, spark.read.parquet(f"{out}/_state/batch=4"), ["instance"], on, 1800)
    assert sorted((r["instance"], r["state"]) for r in changes.collect()) == [("new", "firing"), ("new", "pending")]
    assert states.count() == len(before) + 1 and states.where("instance = 'error'").first()["last_ts"] > dt.datetime(2001, 1, 1)
