"""Result tables: upsert, insert-if-absent, retention, history."""

import datetime as dt
import os

from pyspark.sql import functions as F

from opstide.sinks import tables as K
from opstide.sources import tables as T

SCHEMA = "date date, volume string, used_gb double, created int, month int"


def usage(spark, *rows):
    return spark.createDataFrame([(dt.date(*d), v, u, c, d[0] * 100 + d[1]) for d, v, u, c in rows], SCHEMA)


def content(spark, path):
    return {(r["date"].isoformat(), r["volume"]): r["used_gb"] for r in spark.read.parquet(path).collect()}


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "usage")
    K.upsert_latest(usage(spark, ((2024, 1, 1), "c", 1.0, 1), ((2024, 2, 1), "c", 2.0, 1)), path, ["date", "volume"], "created")
    before = set(os.listdir(f"{path}/month=202401"))
    K.upsert_latest(usage(spark, ((2024, 2, 1), "c", 9.0, 2), ((2024, 2, 2), "c", 3.0, 2)), path, ["date", "volume"], "created")
    # An older version arriving late changes nothing.
    K.upsert_latest(usage(spark, ((2024, 2, 1), "c", 0.0, 0)), path, ["date", "volume"], "created")
    assert set(os.listdir(f"{path}/month=202401")) == before
    assert content(spark, path) == {("2024-01-01", "c"): 1.0, ("2024-02-01", "c"): 9.0, ("2024-02-02", "c"): 3.0}


def test_insert_absent(spark, tmp_path):
    path = str(tmp_path / "usage")
    K.insert_absent(usage(spark, ((2024, 1, 1), "c", 1.0, 1), ((2024, 1, 1), "c", 1.0, 1)), path, ["date", "volume"])
    K.insert_absent(usage(spark, ((2024, 1, 1), "c", 5.0, 2), ((2024, 1, 2), "c", 2.0, 2)), path, ["date", "volume"])
    assert spark.read.parquet(path).count() == 2
    assert content(spark, path) == {("2024-01-01", "c"): 1.0, ("2024-01-02", "c"): 2.0}


def test_retention_drops_and_trims(spark, tmp_path):
    path = str(tmp_path / "events")
    days = [dt.date(2023, 12, 1), dt.date(2024, 1, 14), dt.date(2024, 1, 15), dt.date(2024, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "event_date date").withColumn("event_month", K.event_month())
    df.write.partitionBy("event_month").parquet(path)
    K.retain(spark, path, "2024-04-15 00:00:00", "lock_events")
    kept = sorted(r["event_date"] for r in spark.read.parquet(path).collect())
    assert kept == days[2:]
    assert "event_month=202312" not in os.listdir(path)
    # Running again changes nothing; a later date empties the boundary month.
    K.retain(spark, path, "2024-04-15 00:00:00", "lock_events")
    K.retain(spark, path, "2024-04-30 00:00:00", "lock_events")
    assert [r["event_date"] for r in spark.read.parquet(path).collect()] == days[3:]


def test_retention_dates():
    assert K.retention_start("2024-05-31 00:00:00", "session_events") == dt.date(2024, 2, 29)
    assert K.retention_start("2024-03-15 00:00:00", "techlog") == dt.date(2023, 9, 15)
    assert K.retention_start("2024-12-31 00:00:00", "lock_events") == dt.date(2024, 9, 30)
    assert K.retention_start("2024-04-10 00:00:00", "disk_alerts") == dt.date(2023, 10, 13)


def test_widths_and_pruned_scan(spark, tmp_path, inputs):
    path = str(tmp_path / "events")
    wide = inputs.session_events.withColumn("user_name", F.repeat(F.lit("x"), 300))
    K.append_session_events(wide, path)
    stored = spark.read.parquet(path)
    assert stored.select(F.max(F.length("user_name"))).first()[0] == 100
    assert set(K.SESSION_COLUMNS) <= set(stored.columns)
    scan = T.scan_events(spark, path, "2024-01-31 00:00:00", days=7)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "PushedFilters: [IsNotNull(event_date)" in plan


def test_history_and_outbox_store_json(spark, tmp_path):
    nested = spark.sql("SELECT 1 AS id, array(named_struct('level', 'critical', 'n', 2)) AS warnings")
    K.append_history(nested, str(tmp_path / "h"))
    K.write_outbox(nested, str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "h")).first()["warnings"] == '[{"level":"critical","n":2}]'
    assert spark.read.parquet(str(tmp_path / "o")).first()["acknowledged"] is False


def test_external_table_options_are_complete(spark, monkeypatch):
    """No database is at hand: only the options of the parallel read are checked."""
    seen = {}

    class Reader:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def load(self):
            return "frame"

    class Session:
        read = Reader()

    got = T.jdbc_table(Session(), "jdbc:x", "usage", partition_column="id", lower=0, upper=100, partitions=8)
    assert got == "frame" and seen["format"] == "jdbc"
    assert (seen["partitionColumn"], seen["lowerBound"], seen["upperBound"], seen["numPartitions"]) == ("id", "0", "100", "8")
