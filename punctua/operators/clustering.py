"""K-means on sites and on hashtag series."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler
from pyspark.ml.linalg import SparseVector, Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from punctua.functions.draws import MODULUS, draw_numpy
from punctua.operators.features import assemble, standardise
from punctua.sources.writers import kept


#: Starts of which the one with the least cost is kept, each until its centres rest.
STARTS, MAX_ITER, TOLERANCE = 10, 300, 1e-4
#: Points that are worth a task, and the most of a cached partition.
FEWEST, MOST = 10_000, 1_000_000
#: Numbers a task holds of points or of their distances.
HELD = 1_000_000

_CELLS = "struct<at:array<int>,x:array<double>,size:int>"


class Fit(NamedTuple):
    """Centres (one row each), the sum of squared distances to them and their sizes."""

    centres: np.ndarray
    cost: float
    sizes: np.ndarray


def _cells(vector: str) -> Column:
    """The cells of a vector that are not 0, whatever its form, and its size."""

    def cells(v):
        at = v.indices if isinstance(v, SparseVector) else np.arange(len(v))
        x = v.values if isinstance(v, SparseVector) else v.toArray()
        return at[x != 0].tolist(), x[x != 0].tolist(), len(v)

    return F.udf(cells, _CELLS)(vector)


def _dense(at: list[np.ndarray], x: list[np.ndarray], size: int) -> np.ndarray:
    out = np.zeros((len(at), size))
    rows = np.repeat(np.arange(len(at)), [len(a) for a in at])
    out[rows, np.concatenate(at).astype(np.int64)] = np.concatenate(x)
    return out


def _squares(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of every point to every centre."""
    # Near the points themselves, as the products would cancel far from 0.
    origin = points.mean(axis=0)
    points, centres = points - origin, centres - origin
    found = np.square(points).sum(axis=1)[:, None] - 2 * points @ centres.T + np.square(centres).sum(axis=1)
    return np.maximum(found, 0, out=found)


def _blocks(batches: Iterator[pa.RecordBatch], size: int, centres: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(points, weights, draw keys) of a few rows at a time."""
    step = max(1, HELD // max(size, centres))
    for batch in batches:
        at, x = (batch.column("c").field(k).to_pandas().to_numpy() for k in (0, 1))
        w, key = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("w", "h"))
        for lo in range(0, len(w), step):
            part = slice(lo, lo + step)
            yield _dense(at[part], x[part], size), w[part], key[part]


def _first_centres(data: DataFrame, size: int, k: int, seed: int) -> list[np.ndarray]:
    """Per start up to ``k`` centres by k-means++, one step of all starts per job.

    A point is drawn with a chance in proportion to its weight and squared distance
    to the centres so far: the first in a race of exponential times wins.
    Draws depend on the point's value alone; fewer different points give fewer centres.
    """
    chosen = [np.empty((0, size)) for _ in range(STARTS)]
    for step in range(k):

        def race(batches: Iterator[pa.RecordBatch], step=step, chosen=chosen) -> Iterator[pa.RecordBatch]:
            best = [(np.inf, None)] * STARTS
            for points, w, key in _blocks(batches, size, step):
                for i, centres in enumerate(chosen):
                    rate = w * _squares(points, centres).min(axis=1) if step else w.astype(float)
                    # Centres themselves stay out, however the distances are rounded.
                    if step:
                        rate[(points[:, None, :] == centres).all(axis=2).any(axis=1)] = 0
                    u = (draw_numpy(seed + i, np.int64(step), key) + 1.0) / (MODULUS + 1.0)
                    with np.errstate(divide="ignore"):
                        time = np.where(rate > 0, -np.log(u) / rate, np.inf)
                    at = int(time.argmin())
                    if time[at] < best[i][0]:
                        best[i] = (float(time[at]), points[at])
            won = [(i, t, x) for i, (t, x) in enumerate(best) if x is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _, _ in won], pa.int32()), pa.array([t for _, t, _ in won], pa.float64()), pa.array([x.tolist() for _, _, x in won], pa.list_(pa.float64()))],
                names=["i", "t", "x"],
            )

        found = data.mapInArrow(race, "i int, t double, x array<double>").groupBy("i").agg(F.min(F.struct("t", "x")).alias("b"))
        for r in found.collect():
            chosen[r["i"]] = np.vstack([chosen[r["i"]], r["b"]["x"]])
    return chosen


def _pass(data: DataFrame, size: int, models: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Per model the weight and the sum of the points nearest to each centre, and the cost."""
    edges = np.concatenate(([0], np.cumsum([len(m) for m in models])))
    centres = np.vstack(models)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, cost = np.zeros(len(centres)), np.zeros((len(centres), size)), np.zeros(len(models))
        for points, w, _ in _blocks(batches, size, len(centres)):
            far, own = _squares(points, centres), np.zeros((len(points), len(centres)))
            rows = np.arange(len(points))
            for m, (lo, hi) in enumerate(zip(edges, edges[1:])):
                at = lo + far[:, lo:hi].argmin(axis=1)
                own[rows, at] = w
                cost[m] += w @ far[rows, at]
            n += own.sum(axis=0)
            sums += own.T @ points
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]) for a in (n, sums, cost)], names=["n", "s", "c"])

    n, sums, cost = np.zeros(len(centres)), np.zeros((len(centres), size)), np.zeros(len(models))
    # A row per task: the centres' size, whatever the number of points.
    for r in data.mapInArrow(nearest, "n binary, s binary, c binary").collect():
        n, cost = n + np.frombuffer(r["n"]), cost + np.frombuffer(r["c"])
        sums += np.frombuffer(r["s"]).reshape(sums.shape)
    return [(n[lo:hi], sums[lo:hi], float(cost[m])) for m, (lo, hi) in enumerate(zip(edges, edges[1:]))]


def best_of_starts(data: DataFrame, seed: int, ks: Sequence[int], features: str = "features") -> list[Fit]:
    """For each number of clusters the cheapest of ``STARTS`` fits; the first of equal ones.

    All starts of all numbers move in one pass over the points, a job per step instead
    of one per fit and step; a fit whose centres rest is left out of the next.  Equal
    points are one with a weight.
    """
    spark = data.sparkSession
    with kept(data.select(_cells(features).alias("c"))) as cells:
        n, size = cells.agg(F.count("c"), F.max("c.size")).first()
        if not n:
            raise ValueError("no points to cluster")
        tasks = max(min(spark.sparkContext.defaultParallelism, -(-n // FEWEST)), -(-n // MOST))
        points = cells.groupBy("c").agg(F.count(F.lit(1)).alias("w")).withColumn("h", F.xxhash64("c")).repartition(tasks, "h")
        with kept(points) as points:
            first = _first_centres(points, size, max(ks), seed)
            models = [start[:k] for k in ks for start in first]
            moving = list(range(len(models)))
            for _ in range(MAX_ITER):
                rest = []
                for m, (n, sums, _) in zip(moving, _pass(points, size, [models[m] for m in moving])):
                    # A centre without points stays where it is.
                    now = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], models[m])
                    if np.square(now - models[m]).sum(axis=1).max() > TOLERANCE**2:
                        rest.append(m)
                    models[m] = now
                moving = rest
                if not moving:
                    break
            last = _pass(points, size, models)
    fits = [Fit(model, cost, n.astype(np.int64)) for model, (n, _, cost) in zip(models, last)]
    return [min(fits[i * STARTS:(i + 1) * STARTS], key=lambda fit: fit.cost) for i in range(len(ks))]


def _with_cluster(points: DataFrame, centres: np.ndarray, features: str, name: str) -> DataFrame:
    """Add the number of the nearest centre."""

    def nearest(cells: pd.DataFrame) -> pd.Series:
        step = max(1, HELD // max(centres.shape))
        found = [
            _squares(_dense(cells["at"].to_numpy()[lo:lo + step], cells["x"].to_numpy()[lo:lo + step], centres.shape[1]), centres).argmin(axis=1)
            for lo in range(0, len(cells), step)
        ]
        return pd.Series(np.concatenate(found) if found else [], dtype="int32")

    nearest.__annotations__ = {"cells": pd.DataFrame, "return": pd.Series}
    return points.withColumn(name, F.pandas_udf(nearest, "int")(_cells(features)))


def kmeans(df: DataFrame, cols: list[str], k: int = 4, seed: int = 0, name: str = "cluster", distinct_by: list[str] | None = None) -> DataFrame:
    """Add the cluster number of each row.

    The rows are fitted as they are, so a site counts once per measurement;
    ``distinct_by`` fits on one row per such key instead.
    """
    points = assemble(df, cols, "__features")
    base = points.select(*distinct_by, "__features").distinct() if distinct_by else points
    fit = best_of_starts(base, seed, [k], "__features")[0]
    return _with_cluster(points, fit.centres, "__features", name).drop("__features")


def kmeans_elbow(df: DataFrame, cols: list[str], ks: Sequence[int] = range(2, 10), seed: int = 0) -> DataFrame:
    """Sum of squared distances to the centres for each number of clusters."""
    fits = best_of_starts(assemble(df, cols, "features"), seed, ks)
    rows = [(k, fit.cost) for k, fit in zip(ks, fits)]
    return df.sparkSession.createDataFrame(rows, "k INT, distortion DOUBLE")


def kmeans_silhouette(df: DataFrame, cols: list[str], ks: Sequence[int] = range(2, 10), seed: int = 1) -> DataFrame:
    """Silhouette on the standardised vectors for each number of clusters."""
    scorer = ClusteringEvaluator(featuresCol="standardised", predictionCol="prediction")
    with kept(standardise(df, cols, with_mean=False).select("standardised")) as data:
        rows = [
            (k, float(scorer.evaluate(KMeans(featuresCol="standardised", k=k, seed=seed).fit(data).transform(data))))
            for k in ks
        ]
    return df.sparkSession.createDataFrame(rows, "k INT, score DOUBLE")


def series_vectors(counts: DataFrame, key: str, day: str = "day", value: str = "count") -> DataFrame:
    """(key, features): one sparse vector per key, of its values at integer ``day`` >= 0.

    Days without a row are 0 and take no room; there is no column per day, so
    neither keys nor days are collected.  Values of one day add up.
    """
    cells = counts.filter(F.col(key).isNotNull() & F.col(day).isNotNull()).groupBy(key, F.col(day).cast("int").alias("__d")).agg(F.sum(value).cast("double").alias("__v"))
    size = (cells.agg(F.max("__d")).first()[0] or 0) + 1
    vector = F.udf(lambda days, values: Vectors.sparse(size, days, values), VectorUDT())
    rows = cells.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__d", "__v"))).alias("__c"))
    return rows.select(key, vector("__c.__d", "__c.__v").alias("features"))


def cluster_series(
    counts: DataFrame, key: str, k: int = 4, seed: int = 1, day: str = "day", value: str = "count", standardised: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Cluster the series of a counts table (key, day, value).

    Returns the members (key, cluster, size) and the centres (cluster, day, value),
    both of the best of several converged starts.  ``size`` is the cluster's number
    of members; days on which a centre is 0 have no row.  The raw counts are
    clustered unless ``standardised`` is set; centres then are in that scale.
    """
    points = series_vectors(counts, key, day, value)
    if standardised:
        scale = StandardScaler(inputCol="features", outputCol="__s", withMean=False)
        points = scale.fit(points).transform(points).select(key, F.col("__s").alias("features"))
    with kept(points) as points:
        fit = best_of_starts(points, seed, [k])[0]
    spark = counts.sparkSession
    cells = [(c, int(d), float(centre[d])) for c, centre in enumerate(fit.centres) for d in np.flatnonzero(centre)]
    centres = spark.createDataFrame(cells, "cluster INT, day INT, value DOUBLE")
    sizes = spark.createDataFrame([(i, int(n)) for i, n in enumerate(fit.sizes)], "cluster INT, size BIGINT")
    members = _with_cluster(points, fit.centres, "features", "cluster").select(key, "cluster")
    return members.join(sizes, "cluster").select(key, "cluster", "size"), centres


def series_distances(counts: DataFrame, centres: DataFrame, key: str, day: str = "day", value: str = "count") -> DataFrame:
    """(key, cluster, distance): squared distance of every series to every centre.

    Only the days a series has are joined; the rest of a centre comes in by its norm.
    """
    cells = counts.groupBy(key, F.col(day).cast("int").alias("day")).agg(F.sum(value).cast("double").alias("__v"))
    norms = centres.groupBy("cluster").agg(F.sum(F.col("value") * F.col("value")).alias("__c"))
    # A series meets every centre, also one it shares no day with: k rows per series.
    clusters = centres.select("cluster").distinct().agg(F.array_sort(F.collect_list("cluster"))).scalar()
    own = cells.groupBy(key).agg(F.sum(F.col("__v") * F.col("__v")).alias("__x")).withColumn("cluster", F.explode(clusters))
    shared = cells.join(centres, "day").groupBy(key, "cluster").agg(F.sum(F.col("__v") * F.col("value")).alias("__s"))
    rows = own.join(shared, [key, "cluster"], "left").join(norms, "cluster")
    return rows.select(key, "cluster", (F.col("__x") - 2 * F.coalesce("__s", F.lit(0.0)) + F.col("__c")).alias("distance"))
