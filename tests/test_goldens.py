"""Worked examples with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opstide.functions import alerting as A
from opstide.functions.numeric import t_quantile_975, trend_pct
from opstide.functions.text import error_text, extract_tables, label_errors, next_version
from opstide.operators import windows as W
from opstide.plans import disk as D
from opstide.plans import growth as G
from opstide.plans import locks as L
from opstide.plans import sessions as Q


def days(spark, waits, start=dt.date(2024, 1, 1)):
    rows = [(start + dt.timedelta(days=i), float(w)) for i, w in enumerate(waits)]
    return spark.createDataFrame(rows, "date date, avg_wait double")


def test_weekly_trend_ends(spark):
    week = days(spark, [w * 1000 for w in (340, 356, 367, 500, 567, 745, 892)])
    row = W.trend_of_days(week, "ends").first()
    assert row["trend_pct"] == 107.3
    assert (row["avg_first_ms"], row["avg_second_ms"]) == (pytest.approx(354.33, abs=0.01), pytest.approx(734.67, abs=0.01))


def test_weekly_trend_edges(spark):
    assert W.trend_of_days(days(spark, [1])).count() == 0
    assert W.trend_of_days(days(spark, [0, 5])).first()["trend_pct"] == 0
    assert W.trend_of_days(days(spark, [1, 2, 3]), "ends").count() == 0
    # Three days: the first alone against the other two.
    assert W.trend_of_days(days(spark, [2, 3, 5])).first()["trend_pct"] == 100


STATS = "total_locks bigint, deadlocks bigint, timeouts bigint, avg_wait_ms double, max_wait_ms double, trend_pct double"


def test_lock_risk_scores(spark):
    row = spark.createDataFrame([(1245, 3, 15, 892.0, 2345.0, 107.0)], STATS)
    default, doc = L.score_hourly(row).first(), L.score_hourly(row, "doc").first()
    assert (default["risk_score"], default["risk_level"]) == (120, "critical")
    assert (doc["risk_score"], doc["risk_level"]) == (115, "critical")
    quiet = L.score_hourly(spark.createDataFrame([(1, 0, 0, 1.0, 2.0, None)], STATS)).first()
    assert (quiet["risk_score"], quiet["risk_level"], len(quiet["warnings"])) == (0, "normal", 0)


def test_days_to_limit(spark):
    rows = spark.createDataFrame([(156.3, 2.8), (156.3, -1.0), (250.0, 1.0)], "current_used double, slope double")
    assert [r[0] for r in rows.select(D.days_to_limit(200.0)).collect()] == [15.6, None, 0.0]


def test_three_sigma(spark):
    current = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1), 42, 10.0, 0, 0)],
        "hour_start timestamp_ntz, sessions bigint, avg_duration double, deadlocks bigint, exceptions bigint",
    )
    bounds = spark.createDataFrame(
        [("sessions", 150.0, 25.0, 225.0, 75.0), ("avg_duration", 10.0, 1.0, 13.0, 7.0)],
        "metric string, mean double, std double, upper_3sigma double, lower_3sigma double",
    )
    warning = Q.sigma_check(current, bounds).first()
    assert (warning["metric"], warning["direction"], round(warning["sigma"], 2)) == ("sessions", "low", 4.32)
    verdict = Q.anomaly_verdict(Q.sigma_check(current, bounds)).first()
    assert (verdict["priority"], verdict["subject"][:12]) == ("High", "[preventive]")


def test_linear_usage_is_forecast_exactly(spark):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), "d", 100.0 + i) for i in range(60)]
    usage = spark.createDataFrame(rows, "date date, volume string, used_gb double")
    row = D.forecast_table(usage, "2024-03-01 00:00:00", 200.0).first()
    assert (row["forecast_7d_gb"], row["forecast_30d_gb"], row["days_to_limit"]) == (166.0, 189.0, 41.0)
    assert (row["mae"], row["r2"], row["confidence_interval_lower"]) == (0.0, 1.0, 173.0)


def test_ties_round_to_the_even_digit(spark):
    model = spark.createDataFrame(
        [("a", 0.0, 0.125, 0.0, 0.25), ("b", 0.0, 0.375, 0.0, 0.75)],
        "volume string, intercept double, slope double, last_day double, current_used double",
    )
    got = {r["volume"]: r["forecast_gb"] for r in D.forecast(model, horizons=(1,)).collect()}
    assert got == {"a": 0.12, "b": 0.38}
    days = {r["volume"]: r["d"] for r in model.select("volume", D.days_to_limit(F.lit(0.28125)).alias("d")).collect()}
    assert days == {"a": 0.2, "b": 0.0}


def test_warning_levels(spark):
    schema = "volume string, metric_date date, actual_used_gb double, days_to_limit double, " + ", ".join(
        f"forecast_{h}d_gb double" for h in D.HORIZONS
    )
    rows = [("a", None, 100.0, None, 100.0, 100.0, 100.0), ("b", None, 165.0, 12.0, 181.0, 190.0, 205.0)]
    got = {r["volume"]: r for r in D.disk_warnings(spark.createDataFrame(rows, schema)).collect()}
    assert got["a"]["level"] is None
    assert got["b"]["level"] == "critical"
    assert [w["level"] for w in got["b"]["warnings"]] == ["warning", "warning", "warning", "warning", "critical"]


def test_small_expressions(spark):
    def value(column):
        return spark.range(1).select(column).first()[0]

    assert value(trend_pct(F.lit(0), F.lit(5))) == 100 and value(trend_pct(F.lit(0), F.lit(0))) == 0
    assert value(next_version(F.lit("8.3.25"))) == "8.3.26" and value(next_version(F.lit("8.3"))) == "?.?.?"
    assert value(next_version(F.lit("8.3.x"))) == "?.?.?"
    assert value(error_text(F.lit("Exception in mod: bad thing\nmore"))) == "bad thing"
    assert sorted(value(extract_tables(F.lit("from _Acc1 a, _Inf b, _Acc1")))) == ["Acc1", "Inf"]
    assert value(label_errors(F.lit("Деление на НОЛЬ"))) == "division_by_zero"
    assert value(label_errors(F.lit("Нет прав, connection"))) == "permission_error"
    assert value(A.priority(F.lit("whatever"))) == "Medium"
    assert value(A.due_date(F.lit(1), "2024-01-01 00:00:00")) == dt.date(2024, 1, 2)
    assert value(A.due_date(F.lit(10), "2024-01-01 00:00:00")) == dt.date(2024, 1, 9)
    for dof, quantile in ((1, 12.706), (4, 2.776), (5, 2.571), (10, 2.228), (58, 2.002)):
        assert value(t_quantile_975(F.lit(dof))) == pytest.approx(quantile, abs=2e-3)


def test_intervals_of_a_known_history(spark):
    dates = ["2023-01-15", "2023-05-20", "2023-09-10", "2024-01-25", "2024-06-15", "2024-11-30"]
    rows = [("c", dt.date.fromisoformat(d), f"3.0.{100 + 10 * i}") for i, d in enumerate(dates)]
    history = spark.createDataFrame(rows, "product string, date date, version string")
    stats = W.interval_stats(history, "product").first()
    gaps = [125, 113, 137, 142, 168]
    assert (stats["count"], stats["min_interval"], stats["max_interval"]) == (6, 113, 168)
    assert stats["avg_interval"] == pytest.approx(sum(gaps) / 5)
    assert stats["trend"] == pytest.approx(11.5)
    after = G.next_event(history, "product").first()
    assert after["next_version"] == "3.0.151" and after["next_date"] == dt.date(2025, 4, 16)


def test_events_on_one_day_count_as_zero_gaps(spark):
    day = dt.date(2024, 1, 1)
    rows = [("p", day, "1.0.1"), ("p", day, "1.0.2"), ("p", day + dt.timedelta(days=10), "1.0.3"), ("q", day, "1.0.1")]
    got = {r["product"]: r for r in W.interval_stats(spark.createDataFrame(rows, "product string, date date, version string"), "product").collect()}
    assert (got["p"]["avg_interval"], got["p"]["min_interval"], got["p"]["max_interval"]) == (5.0, 0, 10)
    assert got["q"]["avg_interval"] is None and got["q"]["min_interval"] is None


def test_lock_forecast_needs_two_weeks(spark):
    def daily(n):
        rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), 100 + 20 * i, 200000.0 + 500000 * i) for i in range(n)]
        return spark.createDataFrame(rows, "event_date date, total_locks bigint, avg_wait double")

    assert L.lock_forecast(daily(13)).count() == 0
    first = L.lock_forecast(daily(14)).orderBy("day").first()
    assert (round(first["forecast_locks"]), round(first["trend_locks"])) == (380, 20)
    assert first["deadlock_probability"] == pytest.approx(72.0) and first["days_to_deadlock"] == 1
