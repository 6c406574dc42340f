"""Linear regression on series: reconstruction, folds, selection, impact.

All fits use the same sufficient statistics: counts, means and centred products
of the columns, summed on the cluster.  What reaches the driver is one small
(features x features) matrix per fit, however long the series are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctua.operators.ordering import chunk_if_long, every_seconds, running
from punctua.operators.series import time_series_folds

#: Up to this many columns the products are summed by plain expressions.
_EXPRESSION_COLUMNS = 12

# Fixed value: two-sided 95% point of the normal distribution.
Z_95 = 1.959963984540054


@dataclass(frozen=True)
class LinearFit:
    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float
    sigma: float
    rows: int

    def predict(self) -> Column:
        """Prediction as a column expression."""
        total = F.lit(self.intercept)
        for name, weight in zip(self.features, self.coefficients):
            total = total + F.col(f"`{name}`") * F.lit(weight)
        return total


def products(df: DataFrame, cols: list[str], shift: dict[str, float], by: str | None = None) -> dict[int, np.ndarray]:
    """Matrix of sums of products of ``[1, cols...]`` per value of ``by`` (one
    matrix under 0 without it).  ``shift`` is subtracted first, which keeps the
    sums accurate; rows with a NULL do not count.

    Every task sums its own rows; one matrix per task is combined.
    """
    size = len(cols) + 1
    at = [(i, j) for i in range(size) for j in range(i, size)]
    group = (F.col(by).cast("int") if by else F.lit(0)).alias("__by")
    values = [F.col(f"`{c}`").cast("double") - F.lit(shift.get(c, 0.0)) for c in cols]
    if len(cols) <= _EXPRESSION_COLUMNS:
        rows = df.select(group, *[v.alias(f"__{i}") for i, v in enumerate(values)]).na.drop()
        cell = [F.lit(1.0)] + [F.col(f"__{i}") for i in range(len(cols))]
        sums = rows.groupBy("__by").agg(F.array(*[F.sum(cell[i] * cell[j]) for i, j in at]).alias("__s"))
    else:
        rows = df.select(group, F.array(*values).alias("__v"))
        partial = rows.mapInPandas(_partial_products(size), "__by INT, __s ARRAY<DOUBLE>")
        flat = partial.select("__by", F.posexplode("__s").alias("__at", "__x"))
        cells = flat.groupBy("__by", "__at").agg(F.sum("__x").alias("__x"))
        sums = cells.groupBy("__by").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("__at", "__x"))), lambda c: c["__x"]).alias("__s")
        )
    found = {}
    for key, flat_sums in ((r["__by"], r["__s"]) for r in sums.collect()):  # one row per fold
        matrix = np.zeros((size, size))
        for (i, j), x in zip(at, flat_sums):
            matrix[i, j] = matrix[j, i] = x
        found[key] = matrix
    return found


def _partial_products(size: int):
    upper = np.triu_indices(size)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for pdf in batches:
            for key, part in pdf.groupby("__by"):
                x = np.column_stack([np.ones(len(part)), np.stack(part["__v"].to_numpy()).astype(float)])
                x = x[~np.isnan(x).any(axis=1)]
                held[key] = held.get(key, 0.0) + x.T @ x
        if held:
            yield pd.DataFrame({"__by": list(held), "__s": [m[upper] for m in held.values()]})

    return run


def _means(df: DataFrame, cols: list[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return {c: float(row[i]) if row[i] is not None else 0.0 for i, c in enumerate(cols)}


def _solve(m: np.ndarray, use: list[int]) -> tuple[np.ndarray, float]:
    """Weights and intercept from a product matrix ordered [1, features, target].

    Of several best solutions (constant or repeated features) the shortest is
    taken.
    """
    n = m[0, 0]
    mean_x, mean_y = m[0, use] / n, m[0, -1] / n
    sxx = m[np.ix_(use, use)] - n * np.outer(mean_x, mean_x)
    sxy = m[use, -1] - n * mean_x * mean_y
    weights = np.linalg.pinv(sxx, rcond=1e-12, hermitian=True) @ sxy
    return weights, float(mean_y - weights @ mean_x)


def _sse(m: np.ndarray, use: list[int], weights: np.ndarray, intercept: float) -> float:
    """Squared error of given weights on the rows behind a product matrix."""
    v = np.concatenate([[-intercept], -weights, [1.0]])
    pick = [0, *use, m.shape[0] - 1]
    return float(max(0.0, v @ m[np.ix_(pick, pick)] @ v))


def fit_linear(df: DataFrame, y: str, xs: list[str]) -> LinearFit:
    """Ordinary least squares with intercept."""
    cols = [*xs, y]
    shift = _means(df, cols)
    return _fit(products(df, cols, shift)[0], xs, y, shift)


def _fit(m: np.ndarray, xs: list[str], y: str, shift: dict[str, float], use: list[int] | None = None) -> LinearFit:
    use = use or list(range(1, len(xs) + 1))
    weights, intercept = _solve(m, use)
    n = int(round(m[0, 0]))
    sigma = float(np.sqrt(_sse(m, use, weights, intercept) / max(n - len(use) - 1, 1)))
    names = tuple(xs[i - 1] for i in use)
    intercept += shift[y] - float(sum(w * shift[c] for w, c in zip(weights, names)))
    return LinearFit(names, tuple(float(w) for w in weights), intercept, sigma, n)


def reconstruct(df: DataFrame, y: str, xs: list[str], ts: str, cutoff: str, name: str | None = None) -> DataFrame:
    """Fit before ``cutoff`` and predict all rows."""
    fit = fit_linear(df.filter(F.col(ts) < F.lit(cutoff).cast("timestamp_ntz")), y, xs)
    return df.withColumn(name or f"reg_{y}", fit.predict())


def cv_rmse(df: DataFrame, y: str, xs: list[str], order: list[str], n_folds: int = 20) -> DataFrame:
    """RMSE of each split of an expanding, time-ordered cross validation.

    The folds' product matrices are formed in one pass; a split's training
    matrix is the sum of those before it, so no data is read again.
    """
    rows = df.select(*dict.fromkeys([*order, *xs, y])).na.drop(subset=[*xs, y])
    shift = _means(rows, [*xs, y])
    blocks = products(time_series_folds(rows, order, n_folds), [*xs, y], shift, by="fold")
    use, train, scores = list(range(1, len(xs) + 1)), blocks[0], []
    for fold in range(1, n_folds + 1):
        weights, intercept = _solve(train, use)
        test = blocks[fold]
        n = int(round(test[0, 0]))
        scores.append((fold, int(round(train[0, 0])), n, float(np.sqrt(_sse(test, use, weights, intercept) / n))))
        train = train + test
    return df.sparkSession.createDataFrame(scores, "fold INT, n_train BIGINT, n_test BIGINT, rmse DOUBLE")


def interval_band(predicted: DataFrame, interval: DataFrame, col: str) -> DataFrame:
    """Add the band around a prediction that a one-row error interval gives."""
    row = interval.first()
    return predicted.withColumns(
        {"lower": F.col(col) + F.lit(row["lower"] - row["mean"]), "upper": F.col(col) + F.lit(row["upper"] - row["mean"])}
    )


def coefficients(spark: SparkSession, fit: LinearFit) -> DataFrame:
    """Feature and coefficient, one row each."""
    return spark.createDataFrame(list(zip(fit.features, fit.coefficients)), "feature STRING, coefficient DOUBLE")


def select_by_coefficient(fit: LinearFit) -> list[str]:
    """Features whose absolute coefficient reaches the mean absolute coefficient."""
    size = np.abs(fit.coefficients)
    return [x for x, s in zip(fit.features, size) if s >= size.mean()]


def rfe(df: DataFrame, y: str, xs: list[str], n: int = 3, step: int = 1) -> list[str]:
    """Recursive elimination of the features with the smallest coefficients.

    The product matrix is computed once; each elimination solves a part of it.
    """
    cols = [*xs, y]
    m = products(df, cols, _means(df, cols))[0]
    use = list(range(1, len(xs) + 1))
    while len(use) > n:
        weights, _ = _solve(m, use)
        gone = np.argsort(weights**2, kind="stable")[: min(step, len(use) - n)]
        use = [f for i, f in enumerate(use) if i not in set(gone.tolist())]
    return [xs[i - 1] for i in use]


def impact(df: DataFrame, keys: list[str], ts: str, y: str, xs: list[str], pre: tuple[str, str], post: tuple[str, str]) -> DataFrame:
    """What a series would have been after an intervention, for many series.

    Each key is fitted on its ``pre`` period (both ends included, as the
    ``post`` period).  Rows of the post period get the prediction, the point
    effect and the running effect, each with a 95% band from the residuals.
    """
    cols = [*xs, y]
    between = lambda span: F.col(ts).between(*[F.lit(s).cast("timestamp_ntz") for s in span])
    known = df.filter(between(pre)).na.drop(subset=cols)
    # Per key: sums of products, as one array, formed map-side whatever the
    # size of a key; the small solves run in tasks.
    shift = _means(known, cols)
    size = len(cols) + 1
    at = [(i, j) for i in range(size) for j in range(i, size)]
    value = [F.lit(1.0)] + [F.col(c) - F.lit(shift[c]) for c in cols]
    sums = known.groupBy(*keys).agg(F.array(*[F.sum(value[i] * value[j]) for i, j in at]).alias("__s"))
    fitted = sums.mapInPandas(
        _solve_each(keys, len(xs), at, [shift[c] for c in cols]),
        ", ".join([*[f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys], "__w ARRAY<DOUBLE>", "__c DOUBLE", "__sigma DOUBLE"]),
    )
    rows = df.filter(between(post)).join(fitted, keys)
    guess = F.col("__c")
    for i, x in enumerate(xs):
        guess = guess + F.col("__w")[i] * F.col(x)
    rows = rows.withColumn("predicted", guess).withColumn("effect", F.col(y) - F.col("predicted"))
    rows = running(
        rows, keys, [ts], {"cumulative_effect": ("sum", F.col("effect")), "__k": ("sum", F.lit(1.0))},
        chunk_if_long(df, keys, every_seconds(ts, 30 * 86400)), inclusive=True,
    )
    half = F.col("__sigma") * F.lit(Z_95)
    return rows.withColumns(
        {
            "effect_lower": F.col("effect") - half,
            "effect_upper": F.col("effect") + half,
            "cumulative_lower": F.col("cumulative_effect") - half * F.sqrt("__k"),
            "cumulative_upper": F.col("cumulative_effect") + half * F.sqrt("__k"),
        }
    ).drop("__w", "__c", "__sigma", "__k")


def _solve_each(keys: list[str], features: int, at: list[tuple[int, int]], shift: list[float]):
    use = list(range(1, features + 1))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            weights, intercepts, sigmas = [], [], []
            for flat in pdf["__s"]:
                m = np.zeros((features + 2, features + 2))
                for (i, j), x in zip(at, flat):
                    m[i, j] = m[j, i] = x
                w, c = _solve(m, use)
                weights.append(w)
                intercepts.append(c + shift[-1] - float(w @ np.asarray(shift[:-1])))
                sigmas.append(float(np.sqrt(_sse(m, use, w, c) / max(m[0, 0] - features - 1, 1))))
            yield pdf[keys].assign(__w=weights, __c=intercepts, __sigma=sigmas)

    return run
