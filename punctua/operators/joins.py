"""Joins: by a computed key set, full outer, within a time span, with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SALT = "__salt"


def keep_keys_in(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``.

    A semi join: the key list stays on the cluster.
    """
    return df.join(keys.select(*on).distinct(), on, "left_semi")


def merge_outer(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join whose key columns come from whichever side has them."""
    return left.join(right, on, "full_outer")


def align_on(left: DataFrame, right: DataFrame, ts: str) -> DataFrame:
    """Put two series side by side on their time column, never by position."""
    return merge_outer(left, right, [ts])


def hot_keys(df: DataFrame, on: list[str], share: float = 0.01) -> DataFrame:
    """Keys that hold more than ``share`` of all rows, with a count.

    At most ``1 / share`` keys can qualify, so the result may be broadcast
    whatever the size of ``df``.
    """
    per_key = df.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    total = per_key.groupBy().agg(F.sum("__n"))
    return per_key.filter(F.col("__n") > total.scalar() * F.lit(share))


def skew_join(
    big: DataFrame,
    other: DataFrame,
    on: list[str],
    how: str = "inner",
    condition: Column | None = None,
    share: float = 0.01,
    salts: int = 32,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi-join that spreads the hot keys of ``big`` over ``salts`` tasks.

    AQE splits skewed joins by itself, but not where an aggregation on the same
    key follows; this is for those places.  Only rows of ``other`` under a hot
    key are repeated.  ``how`` is ``inner``, ``left`` or ``left_semi``; every row
    of ``big`` meets all partners once.  ``hot`` holds the hot keys if they are
    known already; there must be few of them, as in :func:`hot_keys`.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"no salted form of a {how} join")
    hot = hot_keys(big, on, share) if hot is None else hot
    hot = F.broadcast(hot.select(*on, F.lit(True).alias("__hot")))
    spread = F.pmod(F.xxhash64(*big.columns), F.lit(salts)).cast("int")
    # A NULL key has no partner; its rows are spread as well.
    loose = F.col("__hot")
    for c in on:
        loose = loose | F.col(c).isNull()
    left = big.join(hot, on, "left").withColumn(_SALT, F.when(loose, spread).otherwise(F.lit(0))).drop("__hot")
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = other.join(hot, on, "left").withColumn(_SALT, F.explode(copies)).drop("__hot")
    if condition is None:
        return left.join(right, [*on, _SALT], how).drop(_SALT)
    same = F.lit(True)
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in [*on, _SALT]})
    for c in [*on, _SALT]:
        same = same & (F.col(c) == F.col(f"__r_{c}"))
    joined = left.join(right, same & condition, how)
    return joined.drop(_SALT, *[f"__r_{c}" for c in [*on, _SALT]])


def within_span(
    starts: DataFrame, ends: DataFrame, on: list[str], start: str, end: str, span: int
) -> DataFrame:
    """Pairs of the same key with ``0 < end - start < span`` (integer columns).

    Time is cut into slices of ``span``; an end can only belong to a start of
    its own or of the previous slice.  The slice is part of the join key, so
    a key with many rows is split along time and far pairs never meet.
    """
    slice_of = lambda c: F.floor(F.col(c) / F.lit(span))
    left = starts.withColumn("__slice", slice_of(start))
    right = ends.withColumn("__slice", F.explode(F.array(slice_of(end), slice_of(end) - 1)))
    gap = F.col(end) - F.col(start)
    return left.join(right, [*on, "__slice"]).filter((gap > 0) & (gap < span)).drop("__slice")
