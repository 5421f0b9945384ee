"""Range functions over slices against plain per-series loops."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from opstide.operators import sliced as S

START = dt.datetime(2024, 1, 1)


def series(spark, data):
    rows = [("m", name, START + dt.timedelta(seconds=float(t)), float(v)) for name, points in data.items() for t, v in points]
    return spark.createDataFrame(rows, "metric string, instance string, ts timestamp_ntz, value double")


def random_data(seed):
    rng = np.random.default_rng(seed)
    hot = np.cumsum(np.ceil(rng.exponential(900, 1500)))
    sparse = np.cumsum(rng.exponential(86400 * 3, 12))
    return {
        "hot": [(int(t), rng.integers(0, 50)) for t in hot],
        "sparse": [(int(t), rng.integers(0, 50)) for t in sparse],
        "gap": [(0, 5), (3600, 6), (86400 * 20, 1), (86400 * 20 + 3600, 9)],
    }


def test_control_chart(spark):
    data = random_data(1)
    got = {
        (r["instance"], (r["ts"] - START).total_seconds()): r
        for r in S.control_chart(series(spark, data), "2030-01-01 00:00:00", ["instance"]).collect()
    }
    assert len(got) == sum(len(v) for v in data.values())
    for name, points in data.items():
        t, v = np.array([p[0] for p in points]), np.array([p[1] for p in points], float)
        for i in range(len(t)):
            inside = v[(t >= t[i] - 7 * 86400) & (t <= t[i])]
            row = got[(name, float(t[i]))]
            assert row["mean"] == pytest.approx(inside.mean(), abs=1e-9)
            assert row["std"] == pytest.approx(inside.std(), abs=1e-6)


def test_constant_stretches_have_no_spread(spark):
    points = [(i * 3600, 0.1) for i in range(400)] + [(400 * 3600 + i * 3600, 7.3 + i % 2) for i in range(200)]
    chart = S.control_chart(series(spark, {"a": points}), "2030-01-01 00:00:00", ["instance"])
    early = chart.filter(F.col("ts") < F.lit(START + dt.timedelta(hours=400)).cast("timestamp_ntz"))
    assert early.filter("std <> 0 or sigma is not null or alarm").count() == 0
    assert chart.filter("alarm").count() > 0


def test_counter_rate_with_reset(spark):
    points = [(0, 10), (600, 20), (1200, 5), (4000, 8), (90000, 9), (90600, 30)]
    got = S.counter_rate(series(spark, {"a": points}), ["instance"]).orderBy("ts").collect()
    increase = [0, 10, 5, 3, 1, 21]
    t = [p[0] for p in points]
    for i, row in enumerate(got):
        for column, width in (("rate_short", 3600), ("rate_long", 86400)):
            want = sum(increase[j] for j in range(i + 1) if t[j] > t[i] - width) / width
            assert row[column] == pytest.approx(want), (i, column)


@pytest.mark.parametrize("seed", range(3))
def test_hold_for_runs_across_slices(spark, seed):
    rng = np.random.default_rng(seed)
    t = np.cumsum(rng.exponential(5000, 400)).astype(int) + np.arange(400)
    v = np.repeat(rng.integers(0, 2, 40), 10)
    got = S.hold_for(series(spark, {"a": list(zip(t, v))}), ["instance"], F.col("value") > 0, 7200).orderBy("ts").collect()
    start = None
    for i, row in enumerate(got):
        start = None if not v[i] else (t[i] if start is None else start)
        want = None if start is None else START + dt.timedelta(seconds=int(start))
        assert row["run_start"] == want
        state = "inactive" if start is None else ("firing" if t[i] - start >= 7200 else "pending")
        assert row["state"] == state


def test_notifications_are_a_day_apart(spark):
    hours = [0, 1, 23, 24, 25, 47, 49, 80]
    alerts = series(spark, {"a": [(h * 3600, 1) for h in hours], "b": [(5 * 3600, 1)]})
    sent = S.notification_times(alerts, ["instance"]).orderBy("instance", "notified_at").collect()
    assert [(r["instance"], (r["notified_at"] - START).total_seconds() / 3600) for r in sent] == [
        ("a", 0), ("a", 24), ("a", 49), ("a", 80), ("b", 5),
    ]


def plain_notifications(times, step):
    sent = []
    for t in sorted(set(times)):
        if not sent or t >= sent[-1] + step:
            sent.append(t)
    return sent


def test_notifications_by_doubling(spark):
    """A dense group over many announcements, sparse ones, one alert, exact distances, microseconds, null labels, no alerts."""
    rng = np.random.default_rng(8)
    day = 86_400.0
    data = {
        "dense": np.round(np.cumsum(rng.exponential(1500, 6000)), 6).tolist(),
        "sparse": np.cumsum(rng.exponential(3 * day, 40)).round(6).tolist(),
        "exact": [i * day / 2 for i in range(9)] * 2,
        "near": [0.0, day - 1e-6, day, 2 * day - 1e-6, 2 * day],
        "one": [5.0],
        None: [0.0, 10.0, day + 1],
    }
    rows = [(n, START + dt.timedelta(microseconds=round(t * 1e6))) for n, ts in data.items() for t in ts] + [("one", None)]
    alerts = spark.createDataFrame(rows, "instance string, ts timestamp_ntz")
    got = {}
    for r in S.notification_times(alerts, ["instance"], 24).collect():
        got.setdefault(r["instance"], []).append((r["notified_at"] - START) // dt.timedelta(microseconds=1))
    want = {n: plain_notifications([round(t * 1e6) for t in ts], 86_400_000_000) for n, ts in data.items()}
    assert {n: sorted(ts) for n, ts in got.items()} == want and len(want["dense"]) > 60
    assert S.notification_times(alerts.where("1 = 0"), ["instance"], 24).count() == 0


def test_no_group_of_alerts_meets_in_one_row(spark):
    alerts = spark.range(10).selectExpr("'a' AS instance", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, cast(id AS int)) AS ts")
    plan = S.successors(alerts.selectExpr("instance", "unix_micros(cast(ts AS timestamp)) AS _t"), ["instance"], 1)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect" not in plan and plan.count("Window [") == 2


def test_chart_of_the_last_days_reads_only_its_range(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(hours=5 * i), float(i * i % 17)) for i in range(140)]
    samples = spark.createDataFrame(rows, "k string, ts timestamp_ntz, value double")
    as_of = "2024-01-25 00:00:00"
    columns = ["ts", "mean", "std", "sigma"]
    whole = S.control_chart(samples, as_of, ["k"]).filter("ts >= timestamp_ntz'2024-01-22 00:00:00'").select(*columns).orderBy("ts").collect()
    part = S.control_chart(samples, as_of, ["k"], last_days=3).select(*columns).orderBy("ts").collect()
    assert len(part) > 10 and [r["ts"] for r in part] == [r["ts"] for r in whole]
    assert np.allclose([r[1:] for r in part], [r[1:] for r in whole])
    # Nothing before the first sample's range is read.
    poisoned = samples.withColumn("value", F.when(F.col("ts") < "2024-01-15", F.raise_error(F.lit("read"))).otherwise(F.col("value")))
    assert S.control_chart(poisoned, as_of, ["k"], last_days=3).count() == len(part)
