"""Models M15, M16, M19-M23, M34 candidates, M35."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions.text import normalise_text, with_error_type
from ..operators import reports as E
from ..operators.features import SESSION_FEATURES, operation_features
from ..plans import models as M
from ..plans.iforest import Forest, iforest_fit, iforest_score, training_scores
from ..plans.sessions import anomaly_verdict, model_warnings
from ..session import materialise, scratch_path
from .q_features import session_frame
from .registry import query


def _session_forest(t):
    # Hourly rows, written once: training and scoring read them several times.
    frame = materialise(session_frame(t), "session_features")
    return frame, iforest_fit(frame, SESSION_FEATURES, ["date", "hour"])


@query("m15_iforest_nodes")
def _(t):
    _, model = _session_forest(t)
    path = scratch_path(t.spark, "forest")
    model.save(t.spark, path)
    nodes = t.spark.read.parquet(f"{path}/nodes")
    return nodes.groupBy("tree").agg(
        F.count("*").alias("nodes"), F.max("depth").alias("depth"), F.max("size").alias("sample")
    )


@query("m16_iforest_score")
def _(t):
    _, model = _session_forest(t)
    return training_scores(model).select("date", "hour", "score", "prediction")


@query("m16_most_anomalous_hours")
def _(t):
    _, model = _session_forest(t)
    scored = training_scores(model).filter(F.col("prediction") == -1)
    return scored.select("date", "hour", "sessions", "score").orderBy("score", "date", "hour").limit(10)


@query("m16_slow_query_outliers")
def _(t):
    queries = t.slow_queries
    model = iforest_fit(queries, ["duration"], ["query_id"], contamination=0.1)
    return training_scores(model).filter(F.col("prediction") == -1).select("query_id", "duration", "score")


@query("m18_model_verdict")
def _(t):
    frame, model = _session_forest(t)
    # A stored forest judges rows as a later job would.
    path = scratch_path(t.spark, "forest")
    model.save(t.spark, path)
    hour_start = F.timestamp_add("HOUR", F.col("hour"), F.col("date").cast("timestamp_ntz"))
    scored = iforest_score(frame, Forest.load(t.spark, path)).withColumn("hour_start", hour_start)
    return anomaly_verdict(model_warnings(scored))


# Every word of the query texts is in the vocabulary; two of them are no stop words.
@query("m19_tfidf", """
WITH t AS (SELECT * FROM (SELECT query_id, unnest(regexp_extract_all(lower(query_text), '\\w\\w+')) AS term FROM slow_queries)
  WHERE term NOT IN ('select', 'from', 'where', 'and', 'or', 'inner', 'left', 'join')),
idf AS (SELECT term, ln(((SELECT count(*) FROM slow_queries) + 1) / (count(DISTINCT query_id) + 1)::double) AS idf FROM t GROUP BY 1)
SELECT query_id, 1.0::double AS length, round(max(idf) / sqrt(sum(idf * idf)), 4) AS largest
FROM t JOIN idf USING (term) GROUP BY query_id""")
def _(t):
    vectors = M.tfidf(t.slow_queries, "query_text", vocabulary=500).transform(t.slow_queries)
    weights = vector_to_array("features")
    length = F.sqrt(F.aggregate(weights, F.lit(0.0), lambda a, x: a + x * x))
    return vectors.select("query_id", length.alias("length"), F.array_max(weights).alias("largest"))


@query("m20_cluster_queries")
def _(t):
    vectors = M.tfidf(t.slow_queries, "query_text").transform(t.slow_queries)
    clustered = M.cluster(vectors.select("query_id", "duration", "features"), k=10)
    return E.cluster_profile(clustered, ["duration"])


@query("m20_cluster_users")
def _(t):
    users = E.user_stats(t.user_efficiency)
    clustered = M.cluster(M.scaled_vector(users, E.EFFICIENCY), k=3)
    return clustered.select("user_name", "cluster")


def _labelled_errors(t):
    typed = with_error_type(t.error_events)
    return typed.select("doc_id", "error_type", normalise_text("error_text", "operation_name").alias("text_for_vector"))


def _hits(scored, accuracy):
    right = F.count_if(F.col("prediction") == F.col("label"))
    return scored.groupBy("error_type").agg(F.count("*").alias("n"), right.alias("right")).withColumn(
        "accuracy", F.lit(accuracy)
    )


@query("m21_train_error_nb")
def _(t):
    _, scored, accuracy = M.train_error_nb(_labelled_errors(t))
    return _hits(scored, accuracy)


@query("m22_train_error_svm")
def _(t):
    _, scored, accuracy = M.train_error_svm(_labelled_errors(t))
    return _hits(scored, accuracy)


@query("m22_class_probabilities")
def _(t):
    labels, scored = M.train_error_probabilities(_labelled_errors(t))
    names = F.array(*[F.lit(x) for x in labels])
    return scored.select(
        "doc_id", "error_type", F.get(names, F.col("prediction").cast("int")).alias("predicted_type"), "probability"
    )


@query("m23_train_duration_rf")
def _(t):
    rows = operation_features(t.operation_log)
    model, _, r2 = M.train_forest(rows, M.DURATION_FEATURES, "duration_minutes", "op_id")
    return M.importances(t.spark, model, M.DURATION_FEATURES).withColumn("r2", F.lit(r2))


# Search bounds of the settings.
SETTINGS_SPACE = {"ras_processes": (1, 8), "rmng_processes": (2, 16), "rphost_processes": (4, 32)}


@query("m34_score_candidates")
def _(t):
    features = list(SETTINGS_SPACE)
    model, _, _ = M.train_forest(t.performance_tests, features, "avg_response_time", "test_id", trees=50)
    return M.score_candidates(t.spark, model, SETTINGS_SPACE)


@query("m35_project_2d")
def _(t):
    users = M.scaled_vector(E.user_stats(t.user_efficiency), E.EFFICIENCY)
    return M.project_2d(users).select("user_name", "x", "y")


@query("m35_co_occurrence", """
WITH u AS (SELECT DISTINCT user_name, context FROM techlog),
a AS (SELECT context FROM techlog GROUP BY 1 ORDER BY count(*) DESC, context LIMIT 3),
c AS (SELECT x.context AS anchor, y.context, count(*) AS users FROM u x JOIN a ON x.context = a.context
      JOIN u y ON x.user_name = y.user_name AND y.context <> x.context GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY anchor ORDER BY users DESC, context) AS int) AS rank FROM c) WHERE rank <= 5""")
def _(t):
    anchors = t.techlog.groupBy("context").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "context").limit(3)
    return M.co_occurrence(t.techlog, "user_name", "context", anchors.select(F.col("context").alias("anchor")))


# Contexts that a session opens on one day; rules from one context to one context.
@query("m35_usage_rules", """
WITH b AS (SELECT DISTINCT session, event_date, context FROM techlog),
n AS (SELECT count(DISTINCT (session, event_date)) AS n FROM b),
i AS (SELECT context, count(*) AS c FROM b GROUP BY 1),
p AS (SELECT x.context AS context, y.context AS leads_to, count(*) AS c
      FROM b x JOIN b y ON x.session = y.session AND x.event_date = y.event_date AND x.context <> y.context GROUP BY 1, 2)
SELECT p.context, leads_to, round(p.c / i.c::double, 6) AS confidence, round(p.c / i.c::double / (j.c / n::double), 6) AS lift,
  round(p.c / n::double, 6) AS support
FROM p JOIN i ON p.context = i.context JOIN i j ON p.leads_to = j.context, n
WHERE p.c >= ceil(0.0006::double * n) AND p.c / i.c::double >= 0.01""", digits=6)
def _(t):
    rules = M.usage_rules(t.techlog, ["session", "event_date"], "context", min_support=0.0006, min_confidence=0.01)
    single = rules.filter(F.size("antecedent") == 1)
    return single.select(
        F.col("antecedent")[0].alias("context"), F.col("consequent")[0].alias("leads_to"), "confidence", "lift", "support"
    )


PROBE = "connection to the server was lost during data transfer"


@query("m35_similar_errors", rf"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(error_text), '([\p{{L}}\p{{N}}_]+)', 1)) AS term FROM error_events),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
idf AS (SELECT term, ln(((SELECT count(*) FROM error_events) + 1) / (count(*) + 1)::double) + 1 AS idf FROM tf GROUP BY 1),
p AS (SELECT term, count(*) AS ptf FROM (SELECT unnest(regexp_extract_all(lower('{PROBE}'), '([\p{{L}}\p{{N}}_]+)', 1)) AS term) GROUP BY 1),
w AS (SELECT doc_id, sum(tf * idf * ptf * idf) AS dot, sqrt(sum(pow(tf * idf, 2))) AS norm
      FROM tf JOIN idf USING (term) LEFT JOIN p USING (term) GROUP BY 1)
SELECT doc_id, round(dot / (norm * (SELECT sqrt(sum(pow(ptf * idf, 2))) FROM p JOIN idf USING (term))), 4) AS similarity
FROM w WHERE dot > 0
ORDER BY round(dot / (norm * (SELECT sqrt(sum(pow(ptf * idf, 2))) FROM p JOIN idf USING (term))), 9) DESC, doc_id LIMIT 10""")
def _(t):
    return M.similar_errors(t.error_events, PROBE)
