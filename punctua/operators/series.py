"""Regular time grids: resampling, gap filling, calendar bins, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from punctua.operators.ordering import chunk_if_long, every_seconds, running
from punctua.operators.selection import number_parts


#: Bins of a gap, or of a key's series, that one task fills.
RUN = 10_000


def floor_time(ts: str, step: int) -> Column:
    """Start of the ``step``-second bin that holds ``ts``."""
    start = F.floor(F.unix_timestamp(F.col(ts)) / F.lit(step)) * F.lit(step)
    return F.timestamp_seconds(start).cast("timestamp_ntz")


def resample(df: DataFrame, keys: list[str], ts: str, step: int, aggs: dict[str, Column]) -> DataFrame:
    """Aggregate per key and ``step``-second bin, keeping the empty bins between
    the first and the last one of a key.

    Rows are reduced to bins before anything is ordered; neither a key nor a gap
    is bound to one task.
    """
    binned = df.groupBy(*keys, floor_time(ts, step).alias(ts)).agg(*[c.alias(n) for n, c in aggs.items()])
    return _fill_bins(binned, keys, ts, step, "SECOND", every_seconds(ts, step * RUN), list(aggs))


def resample_calendar(df: DataFrame, keys: list[str], ts: str, unit: str, aggs: dict[str, Column], keep_empty: bool = True) -> DataFrame:
    """Aggregate per key and calendar ``day`` or ``month`` (labelled by its last day)."""
    start = F.date_trunc(unit, F.col(ts)).cast("date")
    binned = df.groupBy(*keys, start.alias(ts)).agg(*[c.alias(n) for n, c in aggs.items()])
    if keep_empty:
        chunk = F.floor(F.unix_date(ts) / F.lit(RUN * (28 if unit == "month" else 1)))
        binned = _fill_bins(binned, keys, ts, 1, unit.upper(), chunk, list(aggs))
    return binned.withColumn(ts, F.last_day(ts)) if unit == "month" else binned


def _fill_bins(binned: DataFrame, keys: list[str], ts: str, step: int, unit: str, chunk: Column, values: list[str]) -> DataFrame:
    """Repeat each bin up to the next known one, with NULL values.

    The next bin is carried over chunks of a key, and a long gap is cut into runs
    of ``RUN`` bins that go to tasks of their own.
    """
    pause, run, rest = (F.expr(f"INTERVAL '{step * k}' {unit}") for k in (1, RUN, RUN - 1))
    kind = binned.schema[ts].dataType
    rows = running(binned, keys, [ts], {"__next": ("last", F.col(ts))}, chunk, descending=True)
    rows = rows.withColumn("__last", F.coalesce(F.col("__next") - pause, F.col(ts)).cast(kind))
    rows = rows.withColumn("__run", F.explode(F.sequence(F.col(ts), F.col("__last"), run))).repartition(*keys, "__run")
    end = F.least((F.col("__run") + rest).cast(kind), F.col("__last"))
    grid = rows.withColumn("__bin", F.explode(F.sequence(F.col("__run"), end, pause)))
    known = F.col("__bin") == F.col(ts)
    return grid.select(*keys, F.col("__bin").alias(ts), *[F.when(known, F.col(v)).alias(v) for v in values])


def interpolate_linear(df: DataFrame, keys: list[str], ts: str, cols: list[str], chunk_seconds: int = 30 * 86400) -> DataFrame:
    """Fill NULLs on the straight line between the known neighbours of a key.

    A gap at the end takes the last value, a gap at the start stays NULL.  The
    neighbours in a long series are carried over chunks of ``chunk_seconds``, so
    that it is filled by many tasks.
    """
    chunk = chunk_if_long(df, keys, every_seconds(ts, chunk_seconds))
    at = F.unix_timestamp(F.col(ts)).cast("double")
    known = {c: F.when(F.col(c).isNotNull(), F.struct(at.alias("t"), F.col(c).alias("v"))) for c in cols}
    rows = running(df, keys, [ts], {f"__p_{c}": ("last", k) for c, k in known.items()}, chunk, inclusive=True)
    rows = running(rows, keys, [ts], {f"__n_{c}": ("last", k) for c, k in known.items()}, chunk, descending=True, inclusive=True)
    filled = {}
    for c in cols:
        p, n = F.col(f"__p_{c}"), F.col(f"__n_{c}")
        line = p["v"] + (n["v"] - p["v"]) * (at - p["t"]) / (n["t"] - p["t"])
        filled[c] = F.coalesce(F.col(c), F.when(n.isNull(), p["v"]).otherwise(line))
    return rows.withColumns(filled).select(*df.columns)


def time_series_folds(df: DataFrame, order: list[str], n_splits: int = 20) -> DataFrame:
    """Number the expanding folds of a time-ordered split.

    ``fold`` 0 is trained on only; split i trains on the folds below i and
    tests on fold i.  Test folds have ``floor(rows / (n_splits + 1))`` rows.  The
    rows stay where they are: only the keys at the folds' ends are looked up.
    """

    def last_rows(n: int) -> list[int]:
        size = n // (n_splits + 1)
        if size == 0:
            raise ValueError(f"{n} rows are too few for {n_splits} splits")
        return [n - (n_splits - i) * size for i in range(n_splits)]

    return number_parts(df, order, last_rows, "fold")
