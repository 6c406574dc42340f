"""Near duplicates among embeddings by lattice hashing.

Unit vectors are projected to blocks of eight random directions, and each block
is decoded to its nearest point of the E8 lattice.  The points of ``BLOCKS``
blocks together are a cell of one table.  A vector looks into its own cell and
the neighbouring cells nearest to it, in ``TABLES`` tables; whatever lies there
is a candidate, and every candidate's cosine is computed in double precision.

Equal vectors are one node, so copies are never paired.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from punctua.llm.common import stored
from punctua.llm.components import components

LEAST_COSINE = 0.95
#: Tables, E8 blocks per cell, lattice spacing in units of a projected unit
#: vector's component, and cells looked into per block.  At cosine 0.95 one
#: table finds a pair with probability of 0.4 at least, all of them 0.994; two
#: unrelated vectors meet in a table with a probability of 6e-6.
TABLES, BLOCKS, SPACING, PROBES = 10, 2, 1.6, 4
SEED = 20
_SLICE = 2048
#: Ways to change the four least certain coordinates that keep the sum even:
#: for an odd rounding one or three of them, for an even one none or two.
_ODD = ((0,), (1,), (2,), (3,), (0, 1, 2))
_EVEN = ((), (0, 1), (0, 2), (0, 3), (1, 2))


def lattice_points(x: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest found E8 points of each row of ``x`` (rows x 8), nearest first.

    E8 is the integer vectors with even sum and their shift by a half.  In each
    of the two, the rounded vector is mended by moving its least certain
    coordinates to their other neighbour; the first is the nearest point.
    """
    rows, found = np.arange(len(x)), []
    for shift in (0.0, 0.5):
        y = x - shift
        near = np.rint(y)
        other = near + np.where(y >= near, 1.0, -1.0)
        least = np.argsort(-np.abs(y - near), axis=1)[:, :4]
        odd = near.sum(axis=1) % 2 != 0
        for for_odd, for_even in zip(_ODD, _EVEN):
            point = near.copy()
            for pick, where in ((for_odd, rows[odd]), (for_even, rows[~odd])):
                for k in pick:
                    point[where, least[where, k]] = other[where, least[where, k]]
            found.append(point + shift)
    points = np.stack(found, axis=1)
    order = np.argsort(((x[:, None] - points) ** 2).sum(axis=2), axis=1, kind="stable")[:, :n]
    return np.take_along_axis(points, order[:, :, None], axis=1)


def _cells(unit: np.ndarray, table: int, probes: int) -> np.ndarray:
    """Cell keys (rows x probes ** BLOCKS) of unit vectors in one table."""
    draw = np.random.default_rng([SEED, table, unit.shape[1]])
    keys = np.full((len(unit), 1), np.uint64(table + 1))
    for _ in range(BLOCKS):
        lean, start = draw.standard_normal((unit.shape[1], 8)), draw.random(8) * 2
        points = lattice_points(unit @ lean / SPACING + start, probes)
        codes = (points * 2).astype(np.int64).astype(np.uint64)
        block = np.zeros(codes.shape[:2], np.uint64)
        for k in range(8):
            block = _mixed(block ^ codes[:, :, k])
        keys = _mixed(keys[:, :, None] ^ block[:, None, :] * np.uint64(3)).reshape(len(unit), -1)
    return keys


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads neighbouring values."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    return x * np.uint64(0xBF58476D1CE4E5B9) ^ (x >> np.uint64(32))


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists as a matrix of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _keyed(nodes: DataFrame, probes: int) -> DataFrame:
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                node, sizes = part.column(0).to_numpy(), part.column(1).value_lengths().to_numpy(zero_copy_only=False)
                for size in np.unique(sizes):
                    here = np.nonzero(sizes == size)[0]
                    x = _matrix(part.column(1).take(pa.array(here)))
                    x = x / np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    for table in range(TABLES):
                        cells = _cells(x, table, probes)
                        owner = np.repeat(node[here], cells.shape[1])
                        yield pa.RecordBatch.from_arrays([pa.array(cells.reshape(-1).view(np.int64)), pa.array(owner)], names=["cell", "node"])

    return nodes.select("node", "v").mapInArrow(keys, "cell bigint, node bigint")


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = batch.select(["a", "b"])
        for at in range(0, batch.num_rows, _SLICE):
            part = batch.slice(at, _SLICE)
            x, y = part.column("va"), part.column("vb")
            sizes = x.value_lengths().to_numpy(zero_copy_only=False)
            cosine = np.zeros(len(sizes))
            same = sizes == y.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes[same]):
                here = np.nonzero(same & (sizes == size))[0]
                cosine[here] = cosines(_matrix(x.take(pa.array(here))), _matrix(y.take(pa.array(here))))
            yield table.slice(at, _SLICE).filter(pa.array(cosine >= LEAST_COSINE))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row; scaled first, so that no square over- or underflows."""
    x, y = x / np.abs(x).max(axis=1, keepdims=True), y / np.abs(y).max(axis=1, keepdims=True)
    return np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))


def usable(v: Column) -> Column:
    """Not NULL, not empty, every component finite, not all zero."""
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda c: c != 0), F.lit(False))


def distinct_nodes(rows: DataFrame) -> DataFrame:
    """(node, v, copies, first_id) per distinct usable vector ``v`` of (vec_id, v)."""
    groups = rows.filter(usable(F.col("v"))).groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first_id"))
    return stored(groups.withColumn("node", F.monotonically_increasing_id()), "nodes")


def links(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b: nodes with a cosine of ``LEAST_COSINE`` at least, each pair once."""
    own, near = _keyed(nodes, 1), _keyed(nodes, PROBES).withColumnRenamed("node", "other")
    met = own.join(near, "cell").filter("node <> other")
    pairs = met.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
    a, b = nodes.select(F.col("node").alias("a"), F.col("v").alias("va")), nodes.select(F.col("node").alias("b"), F.col("v").alias("vb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "va", "vb").mapInArrow(_verified, "a bigint, b bigint")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row: vec_id, n_links, component_id and kept.

    ``n_links`` counts the other rows linked directly, equal vectors included;
    ``component_id`` is the smallest vec_id reachable, its own included.
    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing, vectors of different length not with each other.  A NULL
    vec_id takes part and names nothing; such a row is not kept.  Repeated ids
    are separate rows.  Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).alias("v"))
    nodes = distinct_nodes(rows)
    found = stored(links(nodes), "links")
    ends = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = nodes.select(F.col("node").alias("b"), "copies")
    near = ends.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("near")).withColumnRenamed("a", "node")
    home = nodes.select("node", "copies", "first_id").join(components(found), "node", "left")
    home = home.withColumn("component", F.coalesce("component", "node")).join(near, "node", "left")
    home = stored(home, "components")
    first = home.groupBy("component").agg(F.min("first_id").alias("smallest"))
    named = home.join(first, "component").select("node", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("links"), "smallest")
    known = nodes.select("node", "v").join(named, "node").drop("node")
    out = rows.join(known, "v", "left")
    component = F.when(usable(F.col("v")), F.col("smallest")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
