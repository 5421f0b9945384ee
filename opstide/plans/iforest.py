"""Isolation forest over any number of rows (Liu, Ting, Zhou 2008).

Rows are dealt to trees by a hash, so each tree sees a sample of about ``psi``
rows and the only data that is grouped is trees x psi rows.  Each tree is built
in its own task; the model is a node table of at most trees x 2 psi rows, small
enough to ship to every scoring task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import exact_quantile
from ..session import materialise

NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size int, depth int"
EULER = 0.5772156649


@dataclass(frozen=True)
class Scaler:
    """Mean and population deviation per feature, and the row count they came from."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    rows: int


def fit_scaler(df: DataFrame, features: list[str]) -> Scaler:
    """One aggregate over the data; the single result row is the model."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    row = df.agg(
        F.count("*"), F.array(*[F.avg(c) for c in filled]), F.array(*[F.stddev_pop(c) for c in filled])
    ).first()
    n, means, stds = row[0], row[1], row[2]
    return Scaler(tuple(features), tuple(means), tuple(s or 1.0 for s in stds), n)


def scaled_columns(scaler: Scaler) -> list[Column]:
    return [
        ((F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - m) / s).alias(c)
        for c, m, s in zip(scaler.features, scaler.mean, scaler.std)
    ]


def standardise(df: DataFrame, scaler: Scaler) -> DataFrame:
    columns = dict(zip(scaler.features, scaled_columns(scaler)))
    return df.withColumns(columns)


def average_path(n):
    """Mean depth of an unsuccessful search in a tree of ``n`` rows."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3)
    value = 2 * (np.log(big - 1) + EULER) - 2 * (big - 1) / big
    return np.where(n > 2, value, np.where(n == 2, 1.0, 0.0))


def _deal(df: DataFrame, row_id: list[str], n_rows: int, trees: int, psi: int, seed: int) -> DataFrame:
    """Add the tree(s) each row is a sample for; every tree gets about ``psi`` rows."""
    share = psi / max(n_rows, 1)

    def uniform(*salt: Column) -> Column:
        bits = F.xxhash64(*[F.col(c) for c in row_id], F.lit(seed), *salt)
        return F.pmod(bits, F.lit(1 << 52)) / float(1 << 52)

    # Round after round a row goes to tree (round + u) / share, so consecutive rounds fill consecutive
    # trees; a large input needs one round and one hash per row.
    rounds = F.sequence(F.lit(0), F.lit(math.ceil(trees * share) - 1))
    chosen = F.array_distinct(F.transform(rounds, lambda j: F.floor((j + uniform(j)) / share).cast("int")))
    return df.withColumn("tree", F.explode(chosen)).filter(F.col("tree") < trees)


def _build_tree(seed: int):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        data = pdf.drop(columns="tree").to_numpy(dtype=float)
        # Arrival order is not fixed, so rows are ordered before the seeded draws.
        data = data[np.lexsort(data.T)]
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(data), 2)))
        nodes = []
        pending = [(np.arange(len(data)), 0, -1, "")]
        while pending:
            rows, depth, parent, side = pending.pop()
            node = len(nodes)
            nodes.append([tree, node, -1, 0.0, -1, -1, len(rows), depth])
            if parent >= 0:
                nodes[parent][4 if side == "left" else 5] = node
            part = data[rows]
            low, high = part.min(axis=0), part.max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or len(usable) == 0:
                continue
            feature = int(rng.choice(usable))
            # Below the maximum, so that neither side is ever empty.
            split = min(float(rng.uniform(low[feature], high[feature])), np.nextafter(high[feature], low[feature]))
            goes_left = part[:, feature] <= split
            nodes[node][2:4] = [feature, split]
            pending.append((rows[~goes_left], depth + 1, node, "right"))
            pending.append((rows[goes_left], depth + 1, node, "left"))
        return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])

    return build


@dataclass(frozen=True)
class Forest:
    scaler: Scaler
    nodes: pd.DataFrame
    psi: int
    offset: float
    training: DataFrame | None = field(default=None, compare=False, repr=False)

    def save(self, spark: SparkSession, path: str) -> None:
        """Store the model as tables."""
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.mode("overwrite").parquet(f"{path}/nodes")
        s = self.scaler
        meta = [(list(s.features), list(map(float, s.mean)), list(map(float, s.std)), s.rows, self.psi, float(self.offset))]
        schema = "features array<string>, mean array<double>, std array<double>, n bigint, psi int, offset double"
        spark.createDataFrame(meta, schema).write.mode("overwrite").parquet(f"{path}/meta")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        meta = spark.read.parquet(f"{path}/meta").first()
        scaler = Scaler(tuple(meta["features"]), tuple(meta["mean"]), tuple(meta["std"]), meta["n"])
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        return Forest(scaler, nodes, meta["psi"], meta["offset"])


def _scorer(spark: SparkSession, nodes: pd.DataFrame, psi: int):
    """Vectorised anomaly score (close to 1 = isolated early) of scaled feature columns."""
    packed = []
    for _, part in nodes.sort_values(["tree", "node"]).groupby("tree"):
        leaf_depth = part["depth"].to_numpy(float) + average_path(part["size"].to_numpy())
        columns = [part[c].to_numpy() for c in ("feature", "split", "left", "right")]
        packed.append((*columns, leaf_depth, int(part["depth"].max())))
    shipped = spark.sparkContext.broadcast(packed)
    normal = float(average_path(psi)) or 1.0

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        data = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        everyone = np.arange(len(data))
        total = np.zeros(len(data))
        for feature, split, left, right, leaf_depth, deepest in shipped.value:
            at = np.zeros(len(data), dtype=int)
            for _ in range(deepest):
                f = feature[at]
                inner = f >= 0
                go_left = data[everyone, np.where(inner, f, 0)] <= split[at]
                at = np.where(inner, np.where(go_left, left[at], right[at]), at)
            total += leaf_depth[at]
        return pd.Series(np.power(2.0, -(total / len(shipped.value)) / normal))

    return score


def iforest_fit(
    df: DataFrame,
    features: list[str],
    row_id: list[str],
    *,
    trees: int = 100,
    psi: int = 256,
    contamination: float = 0.05,
    seed: int = 42,
) -> Forest:
    """Train on standardised features; the offset puts ``contamination`` of the rows below zero."""
    scaler = fit_scaler(df, features)
    psi = min(psi, scaler.rows)
    scaled = df.select(*[F.col(c).alias(f"_id{i}") for i, c in enumerate(row_id)], *scaled_columns(scaler))
    ids = [f"_id{i}" for i in range(len(row_id))]
    dealt = _deal(scaled, ids, scaler.rows, trees, psi, seed).select("tree", *features)
    # At most trees x 2 psi rows, whatever the input size.
    built = dealt.groupBy("tree").applyInPandas(_build_tree(seed), NODE_SCHEMA).toPandas()
    nodes = built.sort_values(["tree", "node"], ignore_index=True)
    score = _scorer(df.sparkSession, nodes, psi)
    # Written once: the quantile reads the scores twice, the trees should run once.
    training = materialise(df.withColumn("score", -score(*scaled_columns(scaler))), "forest_scores")
    offset = exact_quantile(training, [], "score", contamination, "offset", resolution=65536).first()["offset"]
    return Forest(scaler, nodes, psi, offset, training)


def _decided(df: DataFrame, decision: Column) -> DataFrame:
    return df.withColumn("score", decision).withColumn("prediction", F.when(F.col("score") < 0, -1).otherwise(1))


def training_scores(model: Forest) -> DataFrame:
    """What ``iforest_score`` would yield for the rows of the fit, read from the scores that the fit stored."""
    if model.training is None:
        raise ValueError("a loaded forest holds no training rows")
    return _decided(model.training, F.col("score") - F.lit(model.offset))


def iforest_score(df: DataFrame, model: Forest) -> DataFrame:
    """Add ``score`` (negative = anomalous) and ``prediction`` (-1 or 1)."""
    score = _scorer(df.sparkSession, model.nodes, model.psi)
    return _decided(df, -score(*scaled_columns(model.scaler)) - F.lit(model.offset))
