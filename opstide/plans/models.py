"""Text, cluster and forest models on MLlib."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, NaiveBayes, OneVsRest
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    IDF,
    PCA,
    CountVectorizer,
    Normalizer,
    RegexTokenizer,
    StandardScaler,
    StopWordsRemover,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.fpm import FPGrowth
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise
from .forest import RegressionForest, fit_regression_forest

# Stop words of query texts and of error texts.
QUERY_STOP_WORDS = ["select", "from", "where", "and", "or", "inner", "left", "join"]
ERROR_STOP_WORDS = ["в", "на", "с", "по", "для"]

WORD = r"(?U)\b\w\w+\b"


def tfidf_stages(text: str, vocabulary: int, stop_words: list[str]) -> list:
    """Tokens of two or more word characters, the most frequent ones weighted and length-normalised."""
    stages = [RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=WORD, gaps=False, toLowercase=True)]
    tokens = "_tokens"
    if stop_words:
        stages.append(StopWordsRemover(inputCol="_tokens", outputCol="_words", stopWords=stop_words))
        tokens = "_words"
    return [
        *stages,
        CountVectorizer(inputCol=tokens, outputCol="_counts", vocabSize=vocabulary),
        IDF(inputCol="_counts", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="features"),
    ]


def tfidf(df: DataFrame, text: str, vocabulary: int = 100, stop_words: list[str] | None = None) -> PipelineModel:
    words = QUERY_STOP_WORDS if stop_words is None else stop_words
    return Pipeline(stages=tfidf_stages(text, vocabulary, words)).fit(df)


def cluster(df: DataFrame, features: str = "features", k: int = 10, seed: int = 42) -> DataFrame:
    """K-means labels in ``cluster``."""
    model = KMeans(featuresCol=features, predictionCol="cluster", k=k, seed=seed).fit(df)
    return model.transform(df)


def scaled_vector(df: DataFrame, columns: list[str]) -> DataFrame:
    """Numeric columns as one vector with zero mean and unit deviation."""
    stages = [
        VectorAssembler(inputCols=columns, outputCol="_raw"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True),
    ]
    return Pipeline(stages=stages).fit(df).transform(df)


def hash_split(df: DataFrame, row_id: str, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows chosen by a hash of the row id: stable under recomputation."""
    share = F.pmod(F.xxhash64(F.col(row_id), F.lit(seed)), F.lit(10_000)) / 10_000
    return df.filter(share >= test_share), df.filter(share < test_share)


def _train_text(df: DataFrame, row_id: str, classifier, stop_words: list[str]) -> tuple[PipelineModel, DataFrame, float]:
    train, test = hash_split(df, row_id)
    stages = [
        StringIndexer(inputCol="error_type", outputCol="label", handleInvalid="keep"),
        *tfidf_stages("text_for_vector", 500, stop_words),
        classifier,
    ]
    model = Pipeline(stages=stages).fit(train)
    scored = model.transform(test)
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored)
    return model, scored, accuracy


def train_error_nb(df: DataFrame, row_id: str = "doc_id"):
    """Naive Bayes on labelled error texts: model, scored test rows, accuracy."""
    return _train_text(df, row_id, NaiveBayes(modelType="multinomial"), ERROR_STOP_WORDS)


def train_error_svm(df: DataFrame, row_id: str = "doc_id"):
    """Linear support-vector machines, one per error type: model, scored test rows, accuracy."""
    svm = OneVsRest(classifier=LinearSVC(maxIter=20, regParam=0.01))
    return _train_text(df, row_id, svm, [])


def fit_sigmoids(margins: DataFrame, classes: int, rounds: int = 20) -> list[tuple[float, float]]:
    """Slope and offset of a sigmoid per class, by Newton steps over sums.

    ``margins`` has ``label`` and the array ``margin``, one value per class. Targets are
    smoothed by the class's counts, so a class that its margin separates wholly keeps a
    finite slope. Each step is one aggregate of one row per class.
    """
    rows = margins.select(F.col("label").cast("int").alias("_label"), F.posexplode("margin").alias("_class", "_m"))
    hit = F.col("_class") == F.col("_label")
    counts = {r["_class"]: r for r in rows.groupBy("_class").agg(F.count_if(hit).alias("yes"), F.count("*").alias("n")).collect()}
    high = [(counts[c]["yes"] + 1) / (counts[c]["yes"] + 2) if c in counts else 0.5 for c in range(classes)]
    low = [1 / (counts[c]["n"] - counts[c]["yes"] + 2) if c in counts else 0.5 for c in range(classes)]
    # Starts at the class's share without any slope.
    shares = [(counts[c]["yes"] + 1) / (counts[c]["n"] + 2) if c in counts else 0.5 for c in range(classes)]
    fits = [(0.0, math.log(share / (1 - share))) for share in shares]

    def by_class(values) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("_class") + 1)

    losses = [math.inf] * classes
    steps = [(0.0, 0.0)] * classes
    done = [c not in counts for c in range(classes)]
    for _ in range(rounds):
        z = by_class([a for a, _ in fits]) * F.col("_m") + by_class([b for _, b in fits])
        p = 1 / (1 + F.exp(-z))
        target = F.when(hit, by_class(high)).otherwise(by_class(low))
        loss = F.greatest(z, F.lit(0.0)) - target * z + F.log1p(F.exp(-F.abs(z)))
        m, gap, weight = F.col("_m"), p - target, p * (1 - p)
        sums = rows.groupBy("_class").agg(
            F.sum(loss).alias("loss"), F.sum(gap * m).alias("ga"), F.sum(gap).alias("gb"),
            F.sum(weight * m * m).alias("haa"), F.sum(weight * m).alias("hab"), F.sum(weight).alias("hbb"),
        )
        for r in sums.collect():
            c = r["_class"]
            if done[c]:
                continue
            (a, b), (da, db) = fits[c], steps[c]
            if r["loss"] > losses[c] + 1e-9 and max(abs(da), abs(db)) > 1e-9:
                # A step too far: half of it.
                fits[c], steps[c] = (a - da / 2, b - db / 2), (da / 2, db / 2)
                continue
            losses[c] = r["loss"]
            haa, hbb = r["haa"] + 1e-12, r["hbb"] + 1e-12
            det = haa * hbb - r["hab"] ** 2
            da, db = -(hbb * r["ga"] - r["hab"] * r["gb"]) / det, -(haa * r["gb"] - r["hab"] * r["ga"]) / det
            done[c] = max(abs(da), abs(db)) < 1e-7
            fits[c], steps[c] = (a + da, b + db), (da, db)
        if all(done):
            break
    return fits


def with_probabilities(scored: DataFrame, fits: list[tuple[float, float]], margin: str = "margin") -> DataFrame:
    """``probabilities`` per class (sum 1) from the margins, the likeliest ``prediction`` and its ``probability``."""
    slopes = F.array(*[F.struct(F.lit(float(a)).alias("a"), F.lit(float(b)).alias("b")) for a, b in fits])
    single = F.zip_with(margin, slopes, lambda m, s: 1 / (1 + F.exp(-(s["a"] * m + s["b"]))))
    total = F.aggregate("_single", F.lit(0.0), lambda a, x: a + x)
    shares = F.transform("_single", lambda x: F.when(F.col("_total") > 0, x / F.col("_total")).otherwise(1.0 / len(fits)))
    likely = (F.array_position("probabilities", F.col("probability")) - 1).cast("double")
    return (
        scored.withColumn("_single", single)
        .withColumn("_total", total)
        .withColumn("probabilities", shares)
        .withColumn("probability", F.array_max("probabilities"))
        .withColumn("prediction", likely)
        .drop("_single", "_total")
    )


def train_error_probabilities(df: DataFrame, row_id: str = "doc_id", folds: int = 2):
    """Linear support-vector machines with class probabilities: labels in order, scored test rows.

    The sigmoids are fitted on margins of rows that the machine in question has not
    seen: each fold of the training rows is scored by machines of the other folds.
    """
    train, test = hash_split(df, row_id)
    text = Pipeline(
        stages=[StringIndexer(inputCol="error_type", outputCol="label", handleInvalid="keep"), *tfidf_stages("text_for_vector", 500, [])]
    ).fit(train)
    labels = list(text.stages[0].labels)
    vectors = materialise(text.transform(train).select(row_id, "label", "features"), "error_vectors")

    def machine(rows: DataFrame):
        return OneVsRest(classifier=LinearSVC(maxIter=20, regParam=0.01)).fit(rows)

    def margins(model, rows: DataFrame) -> DataFrame:
        return model.transform(rows).withColumn("margin", vector_to_array("rawPrediction"))

    fold = F.pmod(F.xxhash64(F.col(row_id), F.lit(43)), F.lit(folds))
    held = []
    for i in range(folds):
        model = machine(vectors.filter(fold != i))
        # A fold's machines know the classes up to the last one among their rows.
        held.append(margins(model, vectors.filter(fold == i)).select("label", F.slice("margin", 1, len(labels)).alias("margin")))
    fits = fit_sigmoids(materialise(reduce(DataFrame.unionByName, held), "error_margins"), len(labels))
    scored = margins(machine(vectors), text.transform(test))
    return labels, with_probabilities(scored, fits)


# Model inputs of the duration forest.
DURATION_FEATURES = [
    "documents_count", "lines_count", "db_size_gb", "month", "day_of_month", "day_of_week", "is_weekend",
    "is_month_start", "is_month_end", "is_quarter_end", "is_year_end", "log_documents", "log_lines", "log_db_size",
]


def train_forest(
    df: DataFrame, features: list[str], target: str, row_id: str, *, trees: int = 100, depth: int = 10, seed: int = 42
):
    """Random-forest regression with hold-out R2: model, scored test rows, R2."""
    train, test = hash_split(df, row_id)
    model = fit_regression_forest(train, features, target, trees=trees, depth=depth, seed=seed)
    scored = model.transform(test)
    r2 = RegressionEvaluator(labelCol=target, metricName="r2").evaluate(scored)
    return model, scored, r2


def importances(spark: SparkSession, model: RegressionForest, features: list[str]) -> DataFrame:
    """Feature importances of the fitted forest, largest first."""
    rows = [(f, float(v)) for f, v in zip(features, model.feature_importances)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def score_candidates(
    spark: SparkSession, model: RegressionForest, space: dict[str, tuple[int, int]], n: int = 10_000, top: int = 10, seed: int = 42
) -> DataFrame:
    """Random integer settings inside ``space`` ranked by the model's predicted response time."""
    columns: list[Column] = []
    for i, (name, (low, high)) in enumerate(space.items()):
        columns.append((F.pmod(F.xxhash64("id", F.lit(seed + i)), F.lit(high - low + 1)) + low).cast("int").alias(name))
    candidates = spark.range(n).select("id", *columns)
    scored = model.transform(candidates).select("id", *space, F.col("prediction").alias("predicted"))
    return scored.orderBy("predicted", "id").limit(top)


def project_2d(df: DataFrame, features: str = "features") -> DataFrame:
    """First two principal components as columns x and y."""
    projected = PCA(k=2, inputCol=features, outputCol="_pc").fit(df).transform(df)
    parts = vector_to_array("_pc")
    return projected.withColumns({"x": parts[0], "y": parts[1]}).drop("_pc")


def co_occurrence(df: DataFrame, user: str, item: str, anchors: DataFrame, top: int = 5) -> DataFrame:
    """Items most often used by the users of each anchor item.

    Only (user, anchor) rows are expanded, never all item pairs of a user; the
    ``anchors`` table (column ``anchor``) lists the items to advise on.
    """
    used = df.select(user, item).distinct()
    holders = used.join(anchors.select(F.col("anchor").alias(item)), item, "left_semi").withColumnRenamed(item, "anchor")
    together = holders.join(used, user).filter(F.col("anchor") != F.col(item))
    counts = together.groupBy("anchor", item).agg(F.count("*").alias("users"))
    rank = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("users"), item))
    return counts.withColumn("rank", rank).filter(F.col("rank") <= top)


def usage_rules(
    df: DataFrame, basket: list[str], item: str, min_support: float = 0.01, min_confidence: float = 0.1
) -> DataFrame:
    """Rules "who uses these items also uses that one" for all items: antecedent, consequent, confidence, lift, support.

    Baskets are the distinct items per ``basket`` columns; rows without an item are left
    out, rows without a basket column form a basket of their own value.  Frequent sets are
    grown from conditional trees that Spark deals by item, so no basket's pairs are listed.
    A basket holds at most the vocabulary; only items above the support reach the driver.
    Baskets should be sparse (a day of a session, not a year of a user): the number of
    frequent sets, and so of rules, doubles with every further item that is always used along.
    """
    baskets = df.filter(F.col(item).isNotNull()).groupBy(*basket).agg(F.collect_set(item).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    return model.associationRules.select("antecedent", "consequent", "confidence", "lift", "support")


#: Terms whose weights are sent to every task: as many of the most frequent ones as fit.
SHIPPED_TERMS = 50_000


def _row_terms(df: DataFrame, only: Column | None = None) -> DataFrame:
    """Terms of each row's sorted ``tokens`` with their number ``tf``, without a shuffle; of rows that are ``only``.

    Nothing is a filter: it would be moved below the tokens and make them twice.
    """
    tokens, starts = F.col("tokens"), F.col("_starts")
    first = F.filter(F.sequence(F.lit(0), F.size(tokens) - 1), lambda i: (i == 0) | (F.get(tokens, i) != F.get(tokens, i - 1)))
    runs = F.transform(
        starts,
        lambda at, i: F.struct(
            F.get(tokens, at).alias("term"), (F.coalesce(F.get(starts, i + 1), F.size(tokens)) - at).cast("long").alias("tf")
        ),
    )
    wanted = F.size(tokens) > 0 if only is None else (F.size(tokens) > 0) & only
    return df.select("id", "tokens", F.when(wanted, first).alias("_starts")).select("id", F.inline(runs))


def similar_errors(df: DataFrame, probe: str, row_id: str = "doc_id", text: str = "error_text", top: int = 10) -> DataFrame:
    """Rows most similar to a probe text by TF-IDF cosine.

    Whole texts are tokenised.  Terms are counted inside the row; rows that share an id
    are one text, theirs are counted by a shuffle.  Weights of frequent terms go to the
    tasks, so only occurrences of rare terms are shuffled, and of texts without a term
    of the probe none.
    """
    def tokens(column: Column) -> Column:
        return F.regexp_extract_all(F.lower(column), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))

    spark = df.sparkSession
    probes = spark.range(1).select(F.explode(tokens(F.lit(probe))).alias("term"))
    probe_tf = {r["term"]: r["count"] for r in probes.groupBy("term").count().collect()}
    rows = df.select(F.col(row_id).alias("id"), F.sort_array(tokens(F.col(text))).alias("tokens"))
    ids = df.select(F.col(row_id).alias("id"))
    shared = materialise(ids.filter(F.col("id").isNotNull()).groupBy("id").count().filter(F.col("count") > 1).select("id"), "shared_ids")
    own = rows.filter(F.col("id").isNotNull()).join(shared, "id", "left_anti")
    joint = rows.filter(F.col("id").isNull()).unionByName(rows.join(shared, "id", "left_semi"))
    joint_terms = joint.select("id", F.explode("tokens").alias("term")).groupBy("id", "term").agg(F.count("*").alias("tf"))

    n = df.count()
    counted = _row_terms(own).unionByName(joint_terms).groupBy("term").agg(F.count("*").alias("df"))
    idf = F.ln((n + 1) / (F.col("df") + 1)) + 1
    weights = materialise(counted.select("term", "df", idf.alias("idf")), "term_weights")
    # The least document count whose terms, and all more frequent ones, can be shipped.
    least, shipped = math.inf, 0
    for r in weights.groupBy("df").count().orderBy(F.desc("df")).limit(SHIPPED_TERMS).collect():
        if (shipped := shipped + r["count"]) > SHIPPED_TERMS:
            break
        least = r["df"]
    asked = F.col("term").isin(list(probe_tf))
    is_frequent = asked | (F.col("df") >= least)
    frequent, rare = weights.filter(is_frequent).select("term", "idf"), weights.filter(~is_frequent).select("term", "idf")

    probe_idf = {r["term"]: r["idf"] for r in frequent.filter(asked).collect()}
    length = math.sqrt(sum((tf * probe_idf[t]) ** 2 for t, tf in probe_tf.items() if t in probe_idf))
    hit = F.arrays_overlap("tokens", F.array(*[F.lit(t) for t in probe_tf]).cast("array<string>"))
    terms = _row_terms(own, hit).unionByName(joint_terms)
    known = terms.join(F.broadcast(frequent), "term", "left")
    weighted = known.filter(F.col("idf").isNotNull()).unionByName(known.filter(F.col("idf").isNull()).drop("idf").join(rare, "term"))
    w = F.col("tf") * F.col("idf")
    asked_tf = F.coalesce(*[F.when(F.col("term") == t, F.lit(tf)) for t, tf in probe_tf.items()], F.lit(0))
    scored = weighted.groupBy("id").agg(F.sum(w * asked_tf * F.col("idf")).alias("dot"), F.sqrt(F.sum(w * w)).alias("norm"))
    similarity = F.col("dot") / (F.col("norm") * length)
    return (
        scored.filter(F.col("dot") > 0)
        .select(F.col("id").alias(row_id), similarity.alias("similarity"))
        .orderBy(F.desc(F.round("similarity", 9)), row_id)
        .limit(top)
    )
