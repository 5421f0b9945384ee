"""Model properties: regression, forests, forecasts, text and clusters."""

import collections
import datetime as dt
import math

import numpy as np
import pyspark
import pytest
from pyspark.sql import functions as F

from opstide.operators.regress import fit_ols, solve_penalised
from opstide.plans import forest
from opstide.plans import growth as G
from opstide.plans import models as M
from opstide.plans.iforest import Forest, fit_scaler, iforest_fit, iforest_score, standardise, training_scores


def test_ols_matches_lstsq(spark):
    rng = np.random.default_rng(0)
    rows = []
    want = {}
    for key in ("a", "b"):
        x = rng.normal(100, 10, (500, 3))
        y = x @ [1.0, -2.0, 0.5] + (3 if key == "a" else 7) + rng.normal(0, 0.1, 500)
        design = np.column_stack([np.ones(500), x])
        want[key] = np.linalg.lstsq(design, y, rcond=None)[0]
        rows += [(key, *map(float, r), float(v)) for r, v in zip(x, y)]
    rows.append(("a", None, 1.0, 1.0, 1.0))
    df = spark.createDataFrame(rows, "k string, x1 double, x2 double, x3 double, y double").repartition(5)
    for row in fit_ols(df, ["k"], ["x1", "x2", "x3"], "y").collect():
        assert row["n"] == 500 and row["r2"] > 0.99
        assert row["coef"] == pytest.approx(want[row["k"]], rel=1e-6)
    assert fit_ols(df.filter("false"), [], ["x1"], "y").count() == 0


def grid(spark, n=3000):
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(0, 1, 2))) for i in range(n)] + [(n, 10.0, -10.0)]
    return spark.createDataFrame(rows, "id int, a double, b double")


def test_isolation_forest(spark, tmp_path):
    df = grid(spark)
    model = iforest_fit(df, ["a", "b"], ["id"], trees=50)
    assert model.nodes["tree"].nunique() == 50
    assert model.nodes.loc[model.nodes["node"] == 0, "size"].between(150, 370).all()
    scored = iforest_score(df, model)
    share = scored.filter("prediction = -1").count() / df.count()
    assert share == pytest.approx(0.05, abs=0.005)
    ranked = [r["id"] for r in scored.orderBy("score").limit(10).collect()]
    assert 3000 in ranked
    model.save(spark, str(tmp_path / "m"))
    again = iforest_score(df, Forest.load(spark, str(tmp_path / "m")))
    assert again.select(F.sum("score")).first()[0] == pytest.approx(scored.select(F.sum("score")).first()[0])
    # A second run on a different partitioning gives the same trees (up to rounding of the means).
    other = iforest_fit(df.repartition(7), ["a", "b"], ["id"], trees=50).nodes
    assert other.drop(columns="split").equals(model.nodes.drop(columns="split"))
    assert np.allclose(other["split"], model.nodes["split"])


def test_forest_deals_rows_of_large_inputs_to_one_tree(spark):
    df = spark.range(60_000).select(F.col("id"), (F.col("id") % 97).cast("double").alias("a"))
    model = iforest_fit(df, ["a"], ["id"], trees=20, psi=64)
    sizes = model.nodes.loc[model.nodes["node"] == 0, "size"]
    assert len(sizes) == 20 and sizes.between(30, 110).all()


def test_standardise(spark):
    df = grid(spark, 500)
    scaled = standardise(df, fit_scaler(df, ["a", "b"]))
    row = scaled.select(F.avg("a"), F.stddev_pop("a"), F.avg("b"), F.stddev_pop("b")).first()
    assert [round(v, 9) for v in row] == [0, 1, 0, 1]
    constant = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    assert [r["a"] for r in standardise(constant, fit_scaler(constant, ["a"])).collect()] == [0.0, 0.0]


def hourly_series(bend: float, noise: float, seed: int, hours: int = 24 * 200):
    """Daily season on a trend of 2 a year in logs, bent by ``bend`` a year at 0.4 of the series."""
    rng = np.random.default_rng(seed)
    t = np.arange(hours)
    trend = 4 + 2 * t / 8766 + bend * np.maximum(t - 0.4 * hours, 0) / 8766
    values = np.expm1(trend + 0.3 * np.sin(2 * np.pi * t / 24) + rng.normal(0, noise, hours))
    return [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=int(h)), float(v)) for h, v in zip(t, values)]


def test_trend_changes_find_a_planted_bend_and_leave_straight_series(spark):
    made = {"bent": (-4.0, 0.05), "straight": (0.0, 0.05), "exact": (0.0, 0.0)}
    rows = [(k, *r) for i, (k, (bend, noise)) in enumerate(made.items()) for r in hourly_series(bend, noise, i)]
    rows += [("short", dt.datetime(2024, 1, 1), 3.0), ("short", dt.datetime(2024, 1, 2), None)]
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, value double").repartition(6)
    found = G.trend_changes(df, "key").orderBy("ts").collect()
    assert {r["key"] for r in found} == {"bent"}
    at = dt.datetime(2024, 1, 1) + dt.timedelta(hours=0.4 * 24 * 200)
    size = sum(r["slope_after"] - r["slope_before"] for r in found)
    near = [r for r in found if abs(r["ts"] - at) < dt.timedelta(days=13)]
    assert sum(r["slope_after"] - r["slope_before"] for r in near) == pytest.approx(-4, abs=0.8)
    assert size == pytest.approx(-4, abs=0.4)
    assert found[0]["slope_before"] == pytest.approx(2, abs=0.3) and found[-1]["slope_after"] == pytest.approx(-2, abs=0.3)
    assert all(a["slope_after"] == pytest.approx(b["slope_before"]) for a, b in zip(found, found[1:]))

    def last(changes):
        told = G.seasonal_forecast(df, "key", 240, changes=changes).filter("step = 240").collect()
        return {r["key"]: r["forecast"] for r in told}

    plain, bending = last(0), last(25)
    # Without a bend the forecast is that of the straight trend.
    for key in ("straight", "exact", "short"):
        assert bending[key] == pytest.approx(plain[key], rel=1e-6)
    hours = 24 * 200 + 239
    want = 4 + 2 * hours / 8766 - 4 * (hours - 0.4 * 24 * 200) / 8766 + 0.3 * np.sin(2 * np.pi * hours / 24)
    assert np.log1p(bending["bent"]) == pytest.approx(want, abs=0.1)
    assert abs(np.log1p(plain["bent"]) - want) > 0.2
    assert G.trend_changes(df.filter("false"), "key").count() == 0


def test_penalised_solution_meets_its_conditions():
    rng = np.random.default_rng(5)
    x = np.column_stack([np.ones(400), rng.normal(0, 1, (400, 3)), rng.normal(0, 1, (400, 6)).cumsum(axis=1)])
    y = x[:, :4] @ [1.0, 2.0, -1.0, 0.5] + 1.5 * x[:, 6] + rng.normal(0, 1, 400)
    rows = np.column_stack([x, y])
    n, coef, _ = solve_penalised(rows.T @ rows, 3, 1.0)
    gap = x.T @ (y - x @ coef)
    assert n == 400 and gap[:4] == pytest.approx(0, abs=1e-6)
    # At the optimum every penalised feature's product with the residual is at its bound or, at zero, within it.
    held = x[:, 4:] - x[:, :4] @ np.linalg.lstsq(x[:, :4], x[:, 4:], rcond=None)[0]
    full = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    bounds = np.sqrt(full @ full / (400 - 10) * 2 * np.log(6)) * np.sqrt((held**2).sum(axis=0))
    for g, bound, b in zip(gap[4:], bounds, coef[4:]):
        assert abs(g) <= bound * (1 + 1e-6)
        assert b == 0 or g == pytest.approx(np.sign(b) * bound, rel=1e-6)
    # A penalty beyond reach leaves plain least squares of the free features.
    _, none, _ = solve_penalised(rows.T @ rows, 3, 1e9)
    assert none[4:] == [0.0] * 6 and none[:4] == pytest.approx(np.linalg.lstsq(x[:, :4], y, rcond=None)[0], rel=1e-9)


def test_seasonal_forecast_follows_a_clean_season(spark):
    start = dt.datetime(2024, 1, 1)
    rows = []
    for h in range(24 * 28):
        level = np.exp(3 + 0.5 * np.sin(2 * np.pi * h / 24)) - 1
        rows.append(("a", start + dt.timedelta(hours=h), float(level)))
    df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, value double")
    got = G.seasonal_forecast(df, "key", 24).orderBy("step").collect()
    for r in got:
        h = 24 * 28 - 1 + r["step"]
        assert r["ts"] == start + dt.timedelta(hours=h)
        assert r["forecast"] == pytest.approx(np.exp(3 + 0.5 * np.sin(2 * np.pi * h / 24)) - 1, rel=1e-3)


def test_ar_forecast_continues_a_line(spark):
    rng = np.random.default_rng(3)
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(2 * i + rng.normal(0, 0.01))) for i in range(90)]
    df = spark.createDataFrame(rows, "key string, date date, value double")
    got = G.ar_forecast(df, "key", "value", steps=10).orderBy("step").collect()
    assert [r["date"] for r in got][0] == dt.date(2024, 3, 31)
    assert [r["forecast"] for r in got] == pytest.approx([2.0 * (89 + k) for k in range(1, 11)], abs=0.2)


def test_table_growth_reaches_the_limit(spark):
    rows = [("_T", dt.date(2024, 1, 1) + dt.timedelta(days=i), 100.0 + i) for i in range(200)]
    rows += [("_short", dt.date(2024, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(10)]
    stats = spark.createDataFrame(rows, "table_name string, date date, size_gb double")
    report = {r["table_name"]: r for r in G.table_growth_report(stats, limit_gb=310.0).collect()}
    assert set(report) == {"_T"}
    assert report["_T"]["current_size"] == 299.0
    assert report["_T"]["days_to_limit"] is not None and report["_T"]["size_at_limit"] > 310


def test_text_classifier_learns_its_labels(spark):
    words = {"lock_timeout": "deadlock blocked waiting", "db_error": "db connection refused"}
    rows = [(i, kind, f"{text} item{i % 7}") for i in range(200) for kind, text in [list(words.items())[i % 2]]]
    df = spark.createDataFrame(rows, "doc_id int, error_type string, text_for_vector string")
    for train in (M.train_error_nb, M.train_error_svm):
        _, scored, accuracy = train(df)
        assert accuracy > 0.95 and 10 < scored.count() < 80


def test_clusters_and_projection(spark):
    rows = [(i, float(c * 10 + i % 3), float(c * -5 + i % 2)) for i in range(60) for c in (i % 3,)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    vectors = M.scaled_vector(df, ["a", "b"])
    labels = M.cluster(vectors, k=3).select("id", "cluster").collect()
    groups = {r["id"] % 3: set() for r in labels}
    for r in labels:
        groups[r["id"] % 3].add(r["cluster"])
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 3
    flat = M.project_2d(vectors).select(F.stddev("x"), F.stddev("y")).first()
    assert flat[0] > flat[1]


def test_forest_regression_and_candidates(spark):
    rows = [(i, i % 8 + 1, i % 5 + 2, float((i % 8 + 1) * 10)) for i in range(800)]
    df = spark.createDataFrame(rows, "test_id int, a int, b int, y double")
    model, _, r2 = M.train_forest(df, ["a", "b"], "y", "test_id", trees=10, depth=5)
    assert r2 > 0.95
    ranked = M.importances(spark, model, ["a", "b"]).collect()
    assert ranked[0]["feature"] == "a"
    best = M.score_candidates(spark, model, {"a": (1, 8), "b": (2, 6)}, n=500, top=5).collect()
    assert len(best) == 5 and all(r["a"] <= 2 for r in best)


def test_forest_works_in_all_cores_and_sums_cells_once(spark, monkeypatch):
    # One input partition; the old fit kept all work in it.
    df = spark.range(20_000, numPartitions=1).select(
        "id", (F.col("id") % 7).alias("a"), (F.hash("id") % 1000).alias("b"), F.lit(1).alias("c"), ((F.col("id") % 7) * 3.0 + F.col("id") % 2).alias("y")
    )
    stages = []
    save = pyspark.RDD.saveAsPickleFile
    monkeypatch.setattr(pyspark.RDD, "saveAsPickleFile", lambda rdd, *a: (stages.append(rdd.getNumPartitions()), save(rdd, *a))[1])
    cells = forest.fit_regression_forest(df, ["a", "b", "c"], "y", trees=6, depth=4)
    monkeypatch.setattr(forest, "MOST_CELLS", 0)
    rows = forest.fit_regression_forest(df, ["a", "b", "c"], "y", trees=6, depth=4)
    assert all(n > 1 for n in stages)
    assert np.array_equal(cells.feature, rows.feature) and np.allclose(cells.value, rows.value)
    assert np.allclose(cells.threshold, rows.threshold) and np.allclose(cells.feature_importances, rows.feature_importances)
    # Trees of their own samples; a node's mean is that of its rows.
    assert len(np.unique(rows.value[:, 1])) == 6 and rows.value[:, 1] == pytest.approx(9.5, abs=0.2)
    assert rows.feature_importances[0] > 0.9 and rows.feature_importances[2] == 0
    with pytest.raises(ValueError):
        forest.fit_regression_forest(df.withColumn("a", F.expr("nullif(a, 3)")), ["a", "b", "c"], "y", trees=2, depth=2)


def test_forest_finds_the_split_of_least_error(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 20, (4000, 2)).astype(float)
    y = np.where(x[:, 0] > 12, 5.0, 0.0) + x[:, 1] / 10
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, y double")
    tree = forest.fit_regression_forest(df, ["a", "b"], "y", trees=1, depth=2)
    assert tree.feature[0, 1] == 0 and tree.threshold[0, 1] == 12.5
    assert tree.feature[0, 2] == tree.feature[0, 3] == 1
    scored = tree.transform(df).select("y", "prediction").toPandas()
    assert np.abs(scored["y"] - scored["prediction"]).max() < 1.1


def test_similar_errors_shuffles_rare_terms_only(spark, monkeypatch):
    words = [f"w{i % 40} w{i % 40} lost w{i % 3} rare{i}" for i in range(200)] + ["server lost", "lost lost server x"]
    rows = [(i, w) for i, w in enumerate(words)] + [(7, "server lost"), (None, "lost a"), (None, "b server"), (300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id int, error_text string")
    docs = {}
    for i, w in rows:
        docs.setdefault(i, []).extend((w or "").split())
    tf = {i: collections.Counter(w) for i, w in docs.items()}
    n_docs = collections.Counter(t for c in tf.values() for t in c)
    idf = {t: math.log((len(rows) + 1) / (d + 1)) + 1 for t, d in n_docs.items()}
    length = math.sqrt(idf["server"] ** 2 + idf["lost"] ** 2)
    want = {}
    for i, c in tf.items():
        if dot := sum(c[t] * idf[t] ** 2 for t in ("server", "lost")):
            want[i] = dot / math.sqrt(sum((k * idf[t]) ** 2 for t, k in c.items())) / length
    for shipped in (50_000, 5):
        monkeypatch.setattr(M, "SHIPPED_TERMS", shipped)
        found = M.similar_errors(df, "Server lost", top=400)
        got = {r["doc_id"]: r["similarity"] for r in found.collect()}
        assert got == pytest.approx(want)
    # Terms are counted in the row: rows of an id of their own meet by id only after their sums are made.
    plan = M._row_terms(df.select(F.col("doc_id").alias("id"), F.split("error_text", " ").alias("tokens")))
    assert "Exchange" not in plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")


def test_training_scores_are_the_scores_of_the_model(spark, tmp_path):
    df = grid(spark, 500)
    model = iforest_fit(df, ["a", "b"], ["id"], trees=20)
    stored, again = (df.select("id", "score", "prediction").orderBy("id").toPandas() for df in (training_scores(model), iforest_score(df, model)))
    assert len(stored) == 501 and np.allclose(stored, again)
    model.save(spark, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        training_scores(Forest.load(spark, str(tmp_path / "m")))


def test_arma_finds_planted_coefficients(spark):
    rng = np.random.default_rng(4)
    shock = rng.normal(0, 1, 6001)
    change = np.zeros(6001)
    for i in range(1, 6001):
        change[i] = 0.3 + 0.6 * change[i - 1] + shock[i] + 0.4 * shock[i - 1]
    level = np.cumsum(change)
    start = dt.date(2000, 1, 1)
    rows = [("a", start + dt.timedelta(days=i), float(v)) for i, v in enumerate(level)]
    rows += [("b", start + dt.timedelta(days=i), float(2 * i)) for i in range(100)]
    rows += [("short", start, 1.0), ("empty", start, None)]
    daily = spark.createDataFrame(rows, "k string, date date, v double")
    models, _ = G.arma_fit(daily, "k", "v", lags=1, averages=1, long=14)
    found = {r["k"]: r for r in models.collect()}
    assert set(found) == {"a", "b"}
    assert found["a"]["coef"] == pytest.approx([0.3, 0.6, 0.4], abs=0.08)
    out = {}
    for r in G.arma_forecast(daily, "k", "v", lags=1, averages=1, steps=200).collect():
        out.setdefault(r["key"], []).append((r["step"], r["date"], r["forecast"]))
    assert set(out) == {"a", "b"} and all(len(v) == 200 for v in out.values())
    line = sorted(out["b"])
    assert [f for _, _, f in line[:3]] == pytest.approx([200, 202, 204], abs=1e-6)
    assert line[0][1] == start + dt.timedelta(days=100)
    # The first step knows the last shock, later ones tend to the mean change 0.3 / (1 - 0.6).
    ahead = sorted(out["a"])
    c, phi, theta = found["a"]["coef"]
    error = 0.0
    for i in range(2, 6001):
        error = change[i] - (c + phi * change[i - 1] + theta * error)
    assert ahead[0][2] == pytest.approx(level[-1] + c + phi * change[-1] + theta * error, abs=1e-3)
    assert ahead[-1][2] - ahead[-2][2] == pytest.approx(c / (1 - phi), abs=1e-3)


def plain_users_ahead(users, months):
    def single(series, t):
        return [float(t), series[t - 3], series[t - 6], sum(series[t - 3 : t]) / 3]

    def row(series, t):
        s = single(series, t)
        return [1.0, *s, *[a * b for i, a in enumerate(s) for b in s[i:]]]

    design = np.array([row(users, t) for t in range(6, len(users))])
    target = np.array(users[6:], dtype=float)
    scale = np.sqrt((design**2).sum(axis=0))
    coef = np.linalg.lstsq(design / scale, target, rcond=None)[0] / scale
    series = list(map(float, users))
    for _ in range(months):
        series.append(max(float(np.dot(coef, row(series, len(series)))), 0.0))
    return series[len(users) :]


def test_users_months_ahead(spark):
    rng = np.random.default_rng(5)
    series = {k: [int(100 + slope * i + rng.integers(-9, 10)) for i in range(60)] for k, slope in (("a", 1), ("b", 3))}
    rows = [(k, dt.date(2000 + i // 12, i % 12 + 1, 1), u) for k, v in series.items() for i, u in enumerate(v)]
    rows.append(("new", dt.date(2004, 1, 1), 5))
    monthly = spark.createDataFrame(rows, "k string, month date, total_users bigint")
    got = {}
    for r in G.user_growth_forecast(monthly, 12, ("k",)).orderBy("k", "month").collect():
        got.setdefault(r["k"], []).append(r)
    assert set(got) == {"a", "b"}
    for k, rows in got.items():
        assert [r["month"] for r in rows] == [dt.date(2005, m, 1) for m in range(1, 13)]
        assert [r["users_forecast"] for r in rows][:6] == pytest.approx(plain_users_ahead(series[k], 6), rel=1e-2)
    alone = monthly.filter("k = 'a'").drop("k")
    assert [r["users_forecast"] for r in G.user_growth_forecast(alone, 12).orderBy("month").collect()] == pytest.approx(
        [r["users_forecast"] for r in got["a"]], rel=1e-6
    )
    assert G.user_growth_forecast(alone.limit(5), 12).count() == 0


def test_sigmoids_match_the_likelihood(spark):
    rng = np.random.default_rng(6)
    label = rng.integers(0, 3, 3000)
    margin = rng.normal(0, 1, (3000, 3)) + 1.5 * np.eye(3)[label]
    df = spark.createDataFrame([(float(y), [float(x) for x in m]) for y, m in zip(label, margin)], "label double, margin array<double>")
    fits = M.fit_sigmoids(df.repartition(3), 3)
    for c, (a, b) in enumerate(fits):
        # Zero gradient of the smoothed likelihood.
        yes = label == c
        target = np.where(yes, (yes.sum() + 1) / (yes.sum() + 2), 1 / ((~yes).sum() + 2))
        gap = 1 / (1 + np.exp(-(a * margin[:, c] + b))) - target
        assert abs(gap.sum()) < 1e-3 and abs((gap * margin[:, c]).sum()) < 1e-3
    out = M.with_probabilities(df, fits).collect()
    shares = np.array([r["probabilities"] for r in out])
    assert shares.sum(axis=1) == pytest.approx(np.ones(3000))
    assert [r["prediction"] for r in out] == list(shares.argmax(axis=1))
    # Calibrated: in every fifth of a class's sigmoid as many rows are of the class as its mean says.
    for c, (a, b) in enumerate(fits):
        told = 1 / (1 + np.exp(-(a * margin[:, c] + b)))
        bins = np.digitize(told, np.quantile(told, np.arange(0.2, 1, 0.2)))
        assert all(abs(told[bins == i].mean() - (label[bins == i] == c).mean()) < 0.06 for i in range(5))


def test_sigmoids_of_separated_and_missing_classes(spark):
    rows = [(0.0, [2.0, -2.0]), (1.0, [-2.0, 2.0])] * 20
    fits = M.fit_sigmoids(spark.createDataFrame(rows, "label double, margin array<double>"), 3)
    assert all(np.isfinite(f).all() for f in map(np.array, fits)) and fits[0][0] > 0 and fits[2] == (0.0, 0.0)


def test_usage_rules_against_counting(spark):
    baskets = [["a", "b"], ["a", "b", "c"], ["a", "c"], ["b"], ["a", "b", None], ["d"]]
    rows = [(i, x) for i, b in enumerate(baskets) for x in [*b, b[0]]]
    got = {
        (tuple(sorted(r["antecedent"])), r["consequent"][0]): (r["support"], r["confidence"])
        for r in M.usage_rules(spark.createDataFrame(rows, "u int, x string"), ["u"], "x", 0.3, 0.5).collect()
    }
    sets = [{x for x in b if x} for b in baskets]
    want = {}
    for a, b in [("a", "b"), ("b", "a"), ("a", "c"), ("c", "a")]:
        both, one = sum({a, b} <= s for s in sets), sum(a in s for s in sets)
        if both / 6 >= 0.3 and both / one >= 0.5:
            want[((a,), b)] = (pytest.approx(both / 6), pytest.approx(both / one))
    assert got == want
    assert M.usage_rules(spark.createDataFrame([], "u int, x string"), ["u"], "x").count() == 0
