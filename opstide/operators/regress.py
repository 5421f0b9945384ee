"""Least squares per key from cross-product sums.

Each task reduces its rows to one small matrix per key (Arrow batches, one BLAS
product per key and batch); the matrices are then added up by key.  A key may
therefore hold any number of rows, and only one small system per key is solved.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIT_SCHEMA = "struct<n:bigint,coef:array<double>,r2:double>"
MAX_OPEN_KEYS = 50_000


def _cross_products(keys: list[str]):
    """Per task: key -> [1, features, target]' [1, features, target], flushed when many keys are open."""

    def reduce_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, np.ndarray] = {}

        def drain() -> pd.DataFrame:
            out = pd.DataFrame(list(sums), columns=keys) if keys else pd.DataFrame(index=range(len(sums)))
            out["products"] = [m.ravel().tolist() for m in sums.values()]
            sums.clear()
            return out

        for pdf in batches:
            groups = pdf.groupby(keys, dropna=False, sort=False) if keys else [((), pdf)]
            for key, part in groups:
                values = np.vstack(part["_row"].to_numpy())
                rows = np.column_stack([np.ones(len(values)), values])
                product = rows.T @ rows
                sums[key] = sums[key] + product if key in sums else product
            if len(sums) > MAX_OPEN_KEYS:
                yield drain()
        if sums:
            yield drain()

    return reduce_rows


def _solve(products: np.ndarray) -> tuple[int, list[float], float | None]:
    """Row count, coefficients (intercept first) and R2 from the summed products."""
    gram, moments, square = products[:-1, :-1], products[:-1, -1], products[-1, -1]
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    coef = np.linalg.pinv(gram / np.outer(scale, scale), rcond=1e-12, hermitian=True) @ (moments / scale) / scale
    error = square - 2 * coef @ moments + coef @ gram @ coef
    total = square - moments[0] ** 2 / gram[0, 0]
    r2 = None if total <= 0 else float(1 - max(error, 0.0) / total)
    return int(round(gram[0, 0])), coef.tolist(), r2


def _soft(value: float, bound: float) -> float:
    return max(abs(value) - bound, 0.0) * (1.0 if value > 0 else -1.0)


def solve_penalised(products: np.ndarray, free: int, penalty: float, rounds: int = 2000) -> tuple[int, list[float], float | None]:
    """As ``_solve``, with an absolute-value penalty on all features after the first ``free``.

    The free features are projected out first, so a series in which no penalised feature
    counts keeps exactly the coefficients of plain least squares.  The others are found by
    coordinate descent on the remaining products.  A feature counts if its correlation with
    what is left exceeds ``penalty`` times the bound that noise alone seldom reaches: the
    noise's deviation, taken from the full model, times sqrt(2 ln(number of features)).
    """
    gram, moments, square = products[:-1, :-1], products[:-1, -1], products[-1, -1]
    n, held = gram[0, 0], free + 1
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    g, m = gram / np.outer(scale, scale), moments / scale
    inner = np.linalg.pinv(g[:held, :held], rcond=1e-12, hermitian=True)
    rest = g[held:, held:] - g[held:, :held] @ inner @ g[:held, held:]
    pull = m[held:] - g[held:, :held] @ inner @ m[:held]
    total = max(square - m[:held] @ inner @ m[:held], 0.0)
    size = np.diag(rest).copy()
    # Features that the free ones explain, or that are zero throughout, never count.
    open_ = [j for j in range(len(size)) if size[j] > 1e-9]
    error = max(total - pull[open_] @ np.linalg.pinv(rest[np.ix_(open_, open_)], rcond=1e-9, hermitian=True) @ pull[open_], 0.0)
    noise = np.sqrt(max(error / max(n - held - len(open_), 1.0), 1e-16 * square / max(n, 1.0)))
    bound = penalty * noise * np.sqrt(2 * np.log(max(len(open_), 2)))
    found = np.zeros(len(size))
    left = pull.copy()  # products of each feature with what is left unexplained
    for _ in range(rounds):
        moved = 0.0
        for j in open_:
            value = _soft(left[j] + size[j] * found[j], bound * np.sqrt(size[j])) / size[j]
            if value != found[j]:
                left -= rest[:, j] * (value - found[j])
                moved = max(moved, abs(value - found[j]) * np.sqrt(size[j]))
                found[j] = value
        if moved <= 1e-9 * np.sqrt(square):
            break
    coef = np.concatenate([inner @ (m[:held] - g[:held, held:] @ found), found]) / scale
    spread = square - moments[0] ** 2 / n
    missed = square - 2 * coef @ moments + coef @ gram @ coef
    return int(round(n)), coef.tolist(), None if spread <= 0 else float(1 - max(missed, 0.0) / spread)


def fit_ols(df: DataFrame, keys: list[str], features: list[str | Column], target: str) -> DataFrame:
    """Linear model of ``target`` per key: row count ``n``, ``coef`` array, ``r2``.

    Rows with a missing feature or target are left out.  Features travel as one
    array column, which also keeps the optimizer from reasoning about each of
    many derived columns.
    """
    return _fit(df, keys, features, target, _solve)


def fit_penalised(
    df: DataFrame, keys: list[str], free: list[str | Column], penalised: list[str | Column], target: str, penalty: float = 1.0
) -> DataFrame:
    """As ``fit_ols`` over ``free`` and ``penalised`` features, see :func:`solve_penalised`."""
    method = partial(solve_penalised, free=len(free), penalty=penalty)
    return _fit(df, keys, [*free, *penalised], target, method)


def _fit(df: DataFrame, keys: list[str], features: list[str | Column], target: str, method) -> DataFrame:
    inputs = [F.col(c).cast("double") if isinstance(c, str) else c.cast("double") for c in [*features, target]]
    rows = df.select(*keys, F.array(*inputs).alias("_row"))
    complete = rows.filter(F.forall("_row", lambda v: v.isNotNull()))
    key_fields = [rows.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField("products", T.ArrayType(T.DoubleType()))])
    per_task = complete.mapInPandas(_cross_products(keys), schema)
    width = len(features) + 2
    summed = (
        per_task.select(*keys, F.posexplode("products").alias("_pos", "_value"))
        .groupBy(*keys, "_pos")
        .agg(F.sum("_value").alias("_value"))
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "_value")))["_value"].alias("_products"))
        .filter(F.size("_products") == width * width)
    )

    @F.pandas_udf(FIT_SCHEMA)
    def solve(products: pd.Series) -> pd.DataFrame:
        fits = [method(np.asarray(p, dtype=float).reshape(width, width)) for p in products]
        return pd.DataFrame(fits, columns=["n", "coef", "r2"])

    return summed.withColumn("_fit", solve("_products")).select(*keys, "_fit.n", "_fit.coef", "_fit.r2")


def linear_value(features: list[str | Column], coef: str = "coef") -> Column:
    """Model value of the given feature columns, with ``coef`` on the same row."""
    value = F.get(coef, 0)
    for i, c in enumerate(features):
        value = value + F.get(coef, i + 1) * (F.col(c) if isinstance(c, str) else c)
    return value
