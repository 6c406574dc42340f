"""Renaming, filtering, NULL handling, sorting and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from punctua.functions.text import any_flag, true_flag


def select_as(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Pick, rename and order columns: old name -> new name."""
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[f"{prefix}{c}" for c in df.columns])


def strip_prefix(df: DataFrame, n: int) -> DataFrame:
    """Drop the first ``n`` characters of every column name."""
    return df.toDF(*[c[n:] for c in df.columns])


def runs_on_any(df: DataFrame, days: list[str]) -> DataFrame:
    return df.filter(any_flag(days))


def network_window(
    edges: DataFrame, day: str, arrive_by: Column | int, earliest: Column | int | None = None,
    departure: str = "src_departure", arrival: str = "dst_arrival",
) -> DataFrame:
    """Edges of one weekday that arrive in time and leave late enough."""
    kept = edges.filter(true_flag(day) & (F.col(arrival) <= arrive_by))
    return kept if earliest is None else kept.filter(F.col(departure) >= earliest)


def before(df: DataFrame, ts: str, moment: str | dt.datetime) -> DataFrame:
    """Rows strictly before ``moment``; a plain comparison the scan can use."""
    return df.filter(F.col(ts) < F.lit(moment).cast("timestamp_ntz"))


def in_year(df: DataFrame, ts: str, year: int) -> DataFrame:
    """Rows of one year, as a range on the column (``year(ts) = y`` would hide
    the column from the scan)."""
    lo, hi = (F.lit(f"{y}-01-01 00:00:00").cast("timestamp_ntz") for y in (year, year + 1))
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def similar_sites(df: DataFrame, site: str, name: str = "LocationName", by: tuple[str, ...] = ("altitude_cluster", "zone")) -> DataFrame:
    """Rows of all sites that share the ``by`` values of one site."""
    peers = df.filter(F.col(name) == site).select(*by).distinct()
    return df.join(peers, list(by), "left_semi")


def drop_nulls(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=subset)


def null_census(df: DataFrame) -> DataFrame:
    """Per column: NULLs and known values, counted in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count(F.col(f"`{c}`")).alias(f"__{i}") for i, c in enumerate(df.columns)]
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__{i}").alias("known")) for i, c in enumerate(df.columns)])
    rows = counts.select("__n", F.explode(pairs).alias("p"))
    return rows.select("p.column_name", (F.col("__n") - F.col("p.known")).alias("nulls"), "p.known")


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows in ``order``: every task keeps ``n`` rows, then one merges."""
    return df.orderBy(*order).limit(n)


def union_edges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Append tables with different columns; absent ones become NULL."""
    return a.unionByName(b, allowMissingColumns=True)


def nodes(edges: DataFrame, src: str = "src_stop_id", dst: str = "dst_stop_id") -> DataFrame:
    """Distinct endpoints; one pass over the edges."""
    return edges.select(F.explode(F.array(src, dst)).alias("stop_id")).distinct()
