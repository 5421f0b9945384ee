"""Random-forest regression over any number of rows.

Rows are reduced once to one byte per feature (at most 32 ranges) and stored in blocks.
Each level of all trees is one pass over the blocks: a task sums bootstrap weights and
targets per (tree, node, feature, range) with numpy, the sums are added per tree and the
best split of every node is found where they meet.  Only splits reach the driver, at most
2 ** depth per tree.  Every row takes part in every tree with a Poisson weight of mean 1.
Where the features' ranges make few cells, the rows are summed once per (tree, cell), and
the levels read these sums instead of the rows: the same sums, added in another order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import remove, scratch_path

BINS = 32
#: Up to so many combinations of ranges are summed per tree once.
MOST_CELLS = 1 << 16
#: A target's variance times this is no gain but rounding.
LEAST_GAIN = 1e-12
#: Poisson weights of mean 1 by 16 random bits.
_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)])
POISSON = np.searchsorted(_CDF, (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


@dataclass(frozen=True)
class RegressionForest:
    """Trees as arrays of (tree, node); node 1 is the root, 2i and 2i + 1 are the children of i, a leaf has feature -1."""

    features: tuple[str, ...]
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    feature_importances: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the mean of the trees' leaves in ``prediction``."""
        predicted = _predictor(self.feature, self.threshold, self.value)
        return df.withColumn("prediction", predicted(*[F.col(c).cast("double") for c in self.features]))


# Functions that run in tasks stand inside others: they are shipped whole, machines need not have this package.
def _predictor(features: np.ndarray, thresholds: np.ndarray, values: np.ndarray):
    @F.pandas_udf("double")
    def predict(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for parts in columns:
            x = np.column_stack([c.to_numpy(dtype=float) for c in parts])
            if np.isnan(x).any():
                raise ValueError("a feature is null or not a number")
            flat, base, total = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x))
            for feature, threshold, value in zip(features, thresholds, values):
                node, rows = np.ones(len(x), np.intp), np.arange(len(x))
                while len(rows := rows[feature[node[rows]] >= 0]):
                    at = node[rows]
                    node[rows] = 2 * at + (flat[base[rows] + feature[at]] > threshold[at])
                total += value[node]
            yield pd.Series(total / len(values))

    return predict


def split_points(df: DataFrame, features: list[str], target: str) -> tuple[list[np.ndarray], int, float, float]:
    """Range ends per feature from all rows; number of rows, mean and variance of the target.

    Up to 32 values get a range each, more are cut at quantiles.
    """
    columns = [F.col(c).cast("double") for c in features]
    y = F.col(target).cast("double")
    bad = F.lit(False)
    for c in [*columns, y]:
        bad = bad | c.isNull() | F.isnan(c)
    counts = F.array(*[F.approx_count_distinct(c, 0.02) for c in columns])
    n, invalid, mean, variance, distinct = df.agg(F.count("*"), F.count_if(bad), F.avg(y), F.var_pop(y), counts).first()
    if invalid or not n:
        raise ValueError(f"{invalid} of {n} training rows have a null or no number in a feature or the target")
    at = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    few = [d <= 2 * BINS for d in distinct]
    found = df.agg(*[F.collect_set(c) if f else F.percentile_approx(c, at, 1_000) for c, f in zip(columns, few)]).first()
    ends = []
    for values, f in zip(map(np.unique, found), few):
        if f and len(values) > BINS:
            values = values[np.linspace(0, len(values) - 1, BINS).astype(int)[:-1]]
        elif f:
            values = (values[1:] + values[:-1]) / 2
        ends.append(values)
    return ends, n, mean, variance


def _blocks(df: DataFrame, features: list[str], target: str, ends: list[np.ndarray], mean: float, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` rows: a number of their own, one byte per feature, the target less its mean."""

    def pack(batches):
        number, held, size = TaskContext.get().partitionId() << 24, [], 0

        def block(bins, y):
            return pa.RecordBatch.from_pydict({"number": [number], "bins": [bins.tobytes()], "y": [y.tobytes()]})

        def joined():
            return np.concatenate([b for b, _ in held]), np.concatenate([y for _, y in held])

        for batch in batches:
            x = [np.asarray(c.to_numpy(zero_copy_only=False), float) for c in batch.columns]
            bins = [np.searchsorted(e, c).astype(np.uint8) for e, c in zip(ends, x)]
            held.append((np.column_stack(bins), x[-1] - mean))
            size += batch.num_rows
            if size >= rows:
                bins, y = joined()
                for i in range(0, size - rows + 1, rows):
                    yield block(bins[i : i + rows], y[i : i + rows])
                    number += 1
                held, size = [(bins[i + rows :], y[i + rows :])], size % rows
        if size:
            yield block(*joined())

    narrow = df.select(*[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate([*features, target])])
    return narrow.mapInArrow(pack, "number long, bins binary, y binary")


def _bootstrapping(trees: int, seed: int):
    def bootstrap(number: int, rows: int) -> Iterator[np.ndarray]:
        """Weights of a block's rows, tree by tree; four trees share the 64 bits of a row (SplitMix64)."""
        row = np.uint64(number) * np.uint64(1 << 20) + np.arange(rows, dtype=np.uint64)
        for first in range(0, trees, 4):
            salt = (seed * 1_000_003 + first + 1) * 0xD1342543DE82EF95 % 2**64
            z = (row + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            weights = POISSON[(z ^ (z >> np.uint64(31))).view(np.uint16).reshape(rows, 4)]
            yield from weights.T[: trees - first]

    return bootstrap


def _adding(state, level: int, width: int):
    def add(sums: np.ndarray, tree: int, flat: np.ndarray, rows: np.ndarray, w: np.ndarray, wy: np.ndarray) -> None:
        """Add weights and weighted targets by (which of the node's features, node of the level, range)."""
        feature, cut, grows, subset = state.value
        base, node = rows * width, np.ones(len(rows), np.intp)
        for _ in range(level):
            node = 2 * node + (flat.take(base + feature[tree].take(node)) > cut[tree].take(node))
        node -= 1 << level
        if not grows[tree].all():
            live = grows[tree].take(node)
            base, node, w, wy = base[live], node[live], w[live], wy[live]
        at = node * BINS
        for k in range(subset.shape[2]):
            code = at + flat.take(base + subset[tree, :, k].take(node))
            sums[0, k] += np.bincount(code, w, BINS << level)
            sums[1, k] += np.bincount(code, wy, BINS << level)

    return add


def _summing(state, level: int, width: int, bootstrap):
    add = _adding(state, level, width)

    def sums_of(blocks):
        """Sums of a task's rows per tree."""
        _, _, grows, subset = state.value
        sums = None
        for number, bins, y in blocks:
            y, flat = np.frombuffer(y), np.frombuffer(bins, np.uint8)
            if sums is None:
                sums = np.zeros((len(grows), 2, subset.shape[2], BINS << level))
            for tree, weight in enumerate(bootstrap(number, len(y))):
                if grows[tree].any():
                    rows = np.flatnonzero(weight)
                    w = weight.take(rows).astype(float)
                    add(sums[tree], tree, flat, rows, w, w * y.take(rows))
        if sums is not None:
            for tree in np.flatnonzero(grows.any(axis=1)):
                yield int(tree), sums[tree]

    return sums_of


def _cell_summing(sizes: list[int], trees: int, bootstrap):
    def cells_of(blocks):
        """Weights and weighted targets per (tree, cell) of a task's rows."""
        cells, sums = math.prod(sizes), None
        for number, bins, y in blocks:
            y, x = np.frombuffer(y), np.frombuffer(bins, np.uint8).reshape(-1, len(sizes))
            code = np.ravel_multi_index(x.T.astype(np.intp), sizes)
            if sums is None:
                sums = np.zeros((trees, 2, cells))
            for tree, weight in enumerate(bootstrap(number, len(y))):
                w = weight.astype(float)
                sums[tree, 0] += np.bincount(code, w, cells)
                sums[tree, 1] += np.bincount(code, w * y, cells)
        if sums is not None:
            yield from enumerate(sums)

    return cells_of


def _summing_cells(state, level: int, sizes: list[int]):
    add = _adding(state, level, len(sizes))

    def sums_of(tables):
        """The sums of ``_summing`` from a tree's cells."""
        _, _, grows, subset = state.value
        flat = np.stack(np.unravel_index(np.arange(math.prod(sizes)), sizes), axis=1).astype(np.uint8).ravel()
        for tree, (weights, targets) in tables:
            if grows[tree].any():
                rows = np.flatnonzero(weights)
                sums = np.zeros((2, subset.shape[2], BINS << level))
                add(sums, tree, flat, rows, weights[rows], targets[rows])
                yield tree, sums

    return sums_of


def _splitting(least: float):
    def best(sums: np.ndarray):
        """Per node of a level: which of its features, the last range to the left, what the split removes of the
        squared error (0: no split), weight and summed target of the whole and of the left side."""
        _, parts, size = sums.shape
        left = sums.reshape(2, parts, size // BINS, BINS).cumsum(axis=3)
        whole = left[..., -1:]
        right = whole - left
        with np.errstate(divide="ignore", invalid="ignore"):
            less = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]
        less[(left[0] < 0.5) | (right[0] < 0.5)] = 0
        flat = less.transpose(1, 0, 2).reshape(size // BINS, parts * BINS)
        place = flat.argmax(axis=1)
        nodes = np.arange(size // BINS)
        k, cut = place // BINS, place % BINS
        removed = flat[nodes, place]
        removed[removed <= least * whole[0, 0, :, 0]] = 0
        return k, cut, removed, whole[:, 0, :, 0], left[:, k, nodes, cut]

    return best


def fit_regression_forest(
    df: DataFrame, features: list[str], target: str, *, trees: int = 100, depth: int = 10, seed: int = 42
) -> RegressionForest:
    """Forest of ``trees`` trees; each node looks at a third of the features (one tree alone: at all)."""
    spark, width = df.sparkSession, len(features)
    sc = spark.sparkContext
    ends, n, mean, variance = split_points(df, features, target)
    # A small input is cut into as many blocks as keep all cores busy, a large one into blocks of 64 Ki rows.
    parts = 2 * sc.defaultParallelism
    path = scratch_path(spark, "forest_rows")
    rows = min(1 << 16, max(1 << 10, math.ceil(n / (2 * parts))))
    blocks = _blocks(df, features, target, ends, mean, rows).repartition(parts).rdd.map(tuple)
    bootstrap, sizes = _bootstrapping(trees, seed), [len(e) + 1 for e in ends]
    few_cells = math.prod(sizes) <= MOST_CELLS
    if few_cells:
        blocks = blocks.mapPartitions(_cell_summing(sizes, trees, bootstrap)).reduceByKey(lambda a, b: a + b, min(trees, parts))
    blocks.saveAsPickleFile(path, 1)
    blocks = sc.pickleFile(path).coalesce(parts)

    nodes = 2 << depth
    feature, cut = np.zeros((trees, nodes), np.intp), np.full((trees, nodes), BINS, np.uint8)
    split, value = np.zeros((trees, nodes), bool), np.zeros((trees, nodes))
    gains = np.zeros((trees, width))
    grows = np.ones((trees, 1), bool)
    looks = width if trees == 1 else math.ceil(width / 3)
    for level in range(depth):
        first = 1 << level
        subset = np.random.default_rng([seed, level]).random((trees, first, width)).argsort(axis=2)[:, :, :looks]
        state = sc.broadcast((feature[:, :first].copy(), cut[:, :first].copy(), grows, subset))
        if few_cells:
            sums = blocks.mapPartitions(_summing_cells(state, level, sizes))
        else:
            sums = blocks.mapPartitions(_summing(state, level, width, bootstrap)).reduceByKey(lambda a, b: a + b, min(trees, parts))
        found = sums.mapValues(_splitting(LEAST_GAIN * variance)).collect()
        state.destroy()
        grown = np.zeros((trees, 2 * first), bool)
        for tree, (k, last, removed, whole, left) in found:
            if level == 0:
                value[tree, 1] = whole[1, 0] / max(whole[0, 0], 1)
            at = np.flatnonzero((removed > 0) & grows[tree])
            heap = first + at
            feature[tree, heap] = subset[tree, at, k[at]]
            cut[tree, heap], split[tree, heap] = last[at], True
            right = whole[:, at] - left[:, at]
            value[tree, 2 * heap] = left[1, at] / left[0, at]
            value[tree, 2 * heap + 1] = right[1] / right[0]
            np.add.at(gains[tree], feature[tree, heap], removed[at])
            grown[tree, 2 * at] = grown[tree, 2 * at + 1] = True
        grows = grown
        if not grows.any():
            break
    remove(spark, path)

    limits = np.full((width, BINS + 1), np.inf)
    for i, e in enumerate(ends):
        limits[i, : len(e)] = e
    share = gains / np.maximum(gains.sum(axis=1, keepdims=True), np.finfo(float).tiny)
    total = share.sum()
    return RegressionForest(
        tuple(features), np.where(split, feature, -1), limits[feature, cut], value + mean, share.sum(axis=0) / (total or 1.0)
    )
