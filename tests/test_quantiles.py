"""Exact quantiles against numpy, including one dominant group."""

import numpy as np
import pytest

from opstide.operators.quantiles import add_quantile, exact_quantile, exact_quantiles


def frame(spark, groups):
    rows = [(k, float(v)) for k, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "k string, v double")


@pytest.mark.parametrize("p", [0.0, 0.25, 0.5, 0.95, 1.0])
def test_matches_numpy(spark, p):
    rng = np.random.default_rng(5)
    groups = {
        "hot": rng.integers(0, 10**7, 4000),
        "ties": [3.0] * 500 + [4.0],
        "negative": rng.normal(-5, 100, 301),
        "single": [7.5],
        "pair": [1.0, 2.0],
        "tiny": rng.random(50) * 1e-9,
    }
    found = {r["k"]: r["q"] for r in exact_quantile(frame(spark, groups), ["k"], "v", p, "q").collect()}
    for k, values in groups.items():
        assert found[k] == pytest.approx(np.quantile(np.asarray(values, float), p), rel=1e-12, abs=1e-15)


def test_coarse_buckets_give_the_same_answer(spark):
    values = np.random.default_rng(1).integers(0, 1000, 777)
    df = frame(spark, {"a": values})
    for resolution in (1, 4, 4096):
        got = exact_quantile(df, [], "v", 0.95, "q", resolution).first()["q"]
        assert got == pytest.approx(np.quantile(values, 0.95))


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", 2.0), ("b", None)], "k string, v double")
    grouped = df.groupBy("k").count()
    got = {r["k"]: r["q"] for r in add_quantile(grouped, df, ["k"], "v", 0.5, "q").collect()}
    assert got == {"a": 2.0, "b": None}
    total = add_quantile(df.filter("false").groupBy().count(), df.filter("false"), [], "v", 0.5, "q").first()
    assert total["q"] is None


def test_approximate_mode_is_one_pass(spark, inputs):
    from opstide.operators import rollups as R

    exact = {r["event_date"]: r for r in R.lock_daily(inputs.lock_events, "2024-01-31 00:00:00").collect()}
    approx = R.lock_daily(inputs.lock_events, "2024-01-31 00:00:00", exact=False)
    assert set(approx.columns) == set(exact[next(iter(exact))].asDict())
    assert approx._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    for r in approx.collect():
        assert r["max_wait"] >= r["p95_wait"] > 0
        assert r["total_locks"] == exact[r["event_date"]]["total_locks"]


def test_several_quantiles_share_one_count(spark):
    values = np.random.default_rng(2).integers(0, 10**6, 999)
    df = frame(spark, {"a": values, "b": values[:3]})
    wanted = {"low": 0.01, "mid": 0.5, "high": 0.99}
    for row in exact_quantiles(df, ["k"], "v", wanted).collect():
        part = values if row["k"] == "a" else values[:3]
        assert [row[n] for n in wanted] == pytest.approx([np.quantile(part, p) for p in wanted.values()])
