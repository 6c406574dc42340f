"""Counts, percentiles, shares, resampled means and reshaping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from punctua.functions.delays import MEASURED, delay_seconds
from punctua.functions.draws import MODULUS, draw_numpy
from punctua.functions.text import non_empty, starts_with
from punctua.functions.times import MINUTE_PATTERN, SECOND_PATTERN, iso_year, safe_ts
from punctua.operators.joins import keep_keys_in
from punctua.operators.ordering import exact_quantile


def count_by(df: DataFrame, keys: dict[str, Column], name: str = "n") -> DataFrame:
    """Row count per key expression."""
    return df.groupBy(*[c.alias(k) for k, c in keys.items()]).agg(F.count(F.lit(1)).alias(name))


def monthly_stop_counts(events: DataFrame, year: int) -> DataFrame:
    """Stops per month and transport type of one year."""
    rows = events.filter((F.col("year") == year) & non_empty("vehicle"))
    counted = count_by(rows, {"month": F.col("month"), "ttype": F.lower("vehicle")}, "stops")
    label = F.concat(F.col("month").cast("string"), F.lit(f"_{year}"))
    return counted.orderBy("month", "ttype").select(label.alias("month_year"), "ttype", "stops")


def monthly_median(df: DataFrame, keys: list[str], ts: str, value: str, digits: int = 1) -> DataFrame:
    """Exact median per group and calendar month, labelled by the month's last day."""
    dated = df.withColumn("month_end", F.last_day(ts))
    median = exact_quantile(dated, [*keys, "month_end"], value, 0.5, "__median")
    return median.select(*keys, "month_end", F.round("__median", digits).alias(value))


def percentiles(df: DataFrame, keys: list[str], value: str, ps: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """Approximate percentiles ``p_50`` etc. of one measure per group, all from
    one mergeable sketch; each is a value that occurs."""
    found = df.groupBy(*keys).agg(F.percentile_approx(value, list(ps), accuracy).alias("__p"))
    return found.select(*keys, *[F.col("__p")[i].alias(f"p_{round(p * 100)}") for i, p in enumerate(ps)])


def arrival_delays(events: DataFrame) -> DataFrame:
    """Measured arrivals with ``delay`` in seconds."""
    return _delays(events, "sched_arr", "act_arr", "arr_status")


def departure_delays(events: DataFrame) -> DataFrame:
    """Measured departures with ``delay`` in seconds and the parsed schedule time."""
    return _delays(events, "sched_dep", "act_dep", "dep_status")


def _delays(events: DataFrame, scheduled: str, actual: str, status: str) -> DataFrame:
    rows = events.filter(F.col(status).isin(*MEASURED))
    due = safe_ts(scheduled, MINUTE_PATTERN)
    return rows.withColumns({"due": due, "delay": delay_seconds(due, safe_ts(actual, SECOND_PATTERN))})


def delay_percentiles(
    events: DataFrame, station: str, year: int, trains: DataFrame, service: str = "IC", ps: Sequence[float] = (0.5, 0.75)
) -> DataFrame:
    """Arrival delay percentiles per train at one station, for the trains of a
    computed list (column ``train_number``)."""
    at = events.filter(
        (F.col("year") == year)
        & (F.col("stop_name") == station)
        & (F.col("service_type") == service)
        & (F.lower("vehicle") == "zug")
    ).withColumnRenamed("line_id", "train_number")
    return percentiles(arrival_delays(keep_keys_in(at, trains, ["train_number"])), ["train_number"], "delay", ps)


def delay_heatmap(events: DataFrame, prefix: str, years: Sequence[int], iso: bool = False) -> DataFrame:
    """Week x year matrix of the median departure delay of trains at stations
    whose name starts with ``prefix``.

    The week is the ISO week while the year is the partition's; ``iso`` takes
    the year the ISO week belongs to.
    """
    at = events.filter((F.lower("vehicle") == "zug") & starts_with("stop_name", prefix))
    if not iso:
        at = at.filter(F.col("year").isin(*years))
    rows = departure_delays(at).withColumn("week", F.weekofyear("due"))
    if iso:
        rows = rows.withColumn("year", iso_year("due"))
    return pivot_values(percentiles(rows, ["year", "week"], "delay", [0.5]), ["week"], "year", "p_50", years)


def delay_geomap(events: DataFrame, stops: DataFrame, year: int, month: int) -> DataFrame:
    """Median arrival delay of trains per station with its coordinates."""
    rows = events.filter((F.col("year") == year) & (F.col("month") == month) & (F.lower("vehicle") == "zug"))
    median = percentiles(arrival_delays(rows), ["stop_name"], "delay", [0.5])
    places = stops.select("stop_name", "stop_lat", "stop_lon").distinct()
    return median.join(places, "stop_name")


def unmatched_names(events: DataFrame, stops: DataFrame) -> DataFrame:
    """Stop names of the events that the stop table does not know, with counts.

    Names are counted before the join, so each travels once."""
    return count_by(events, {"stop_name": F.col("stop_name")}).join(stops.select("stop_name"), "stop_name", "left_anti")


def first_known(value: str, order: str) -> Column:
    """First non-NULL value in ``order``; ``first`` alone depends on arrival order."""
    return F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def distinct_values(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Sorted array of the distinct values per group.

    Copies go before the collection; the array itself is the result.
    """
    lone = df.select(*keys, value).distinct()
    return lone.groupBy(*keys).agg(F.sort_array(F.collect_list(value)).alias(name))


def top_n_with_shares(df: DataFrame, key: str, part: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent keys with the count of each of their parts.

    Rows are counted per (key, part) once; the totals come from these counts,
    and only the ``n`` winners are sent to the counts again.
    """
    parts = df.groupBy(key, part).agg(F.count(F.lit(1)).alias(f"{part}_count"))
    totals = parts.groupBy(key).agg(F.sum(f"{part}_count").alias("total_count"))
    winners = totals.orderBy(F.desc("total_count"), key).limit(n)
    shares = parts.join(F.broadcast(winners), key)  # n rows
    return shares.select(key, part, f"{part}_count", "total_count").orderBy(
        F.desc("total_count"), key, F.desc(f"{part}_count"), part
    )


def pivot_values(df: DataFrame, rows: list[str], col: str, value: str, values: Sequence, fill: float | None = None) -> DataFrame:
    """Long to wide with the wanted ``values`` as columns, one cell per value.

    The value list spares the extra job that would look for it.
    """
    wide = df.groupBy(*rows).pivot(col, list(values)).agg(F.sum(value))
    return wide if fill is None else wide.na.fill(fill)


def distinct_for_pivot(df: DataFrame, col: str, limit: int = 10_000) -> list:
    """Column values for a pivot whose range is not known beforehand."""
    found = [r[0] for r in df.select(col).distinct().orderBy(col).limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"more than {limit} columns wanted: keep {col} long")
    return found


def site_features(df: DataFrame, ts: str, site: str, sites: Sequence[str], values: Sequence[str], drop: Sequence[str] = ()) -> DataFrame:
    """One row per time, one column ``value_site`` per value and site.

    ``drop`` names columns to leave out, such as the target itself.
    """
    cells = [F.first(v, ignorenulls=True).alias(v) for v in values]
    wide = df.filter(F.col(site).isin(*sites)).groupBy(ts).pivot(site, list(sites)).agg(*cells)
    if len(values) == 1:
        wide = wide.withColumnsRenamed({s: f"{s}_{values[0]}" for s in sites})
    names = {f"{s}_{v}": f"{v}_{s}" for s in sites for v in values}
    return wide.withColumnsRenamed(names).drop(*drop)


def unpivot_sensor(df: DataFrame, ts: str, measures: Sequence[str] = ("temperature", "humidity"), id_width: int = 4) -> DataFrame:
    """Wide sensor table (columns ``{id}.{measure}``) to one row per time and sensor.

    Every measured column lands in the row of its own sensor in one grouping,
    which replaces a full outer join of one long table per measure.
    """
    names = [c for c in df.columns if c != ts]
    long = df.unpivot([F.col(f"`{ts}`")], [F.col(f"`{c}`") for c in names], "variable", "value")
    long = long.withColumn("sensor_id", F.substring("variable", 1, id_width).try_cast("int"))
    return long.groupBy(ts, "sensor_id").agg(
        *[F.max(F.when(F.lower("variable").contains(m), F.col("value"))).alias(m) for m in measures]
    )


def transpose(df: DataFrame, key: str, keys: Sequence, name: str = "variable") -> DataFrame:
    """Turn columns into rows: the ``key`` values become the column names."""
    rest = [c for c in df.columns if c != key]
    long = df.unpivot([F.col(key)], rest, name, "__value")
    return long.groupBy(name).pivot(key, list(keys)).agg(F.first("__value", ignorenulls=True))


#: Blocks a table is dealt to for the bootstrap: leaves of the binomial tree.
BLOCKS = 1024
#: Nodes near the root whose draws a task keeps.
KEPT_NODES = 128
#: Rows of a block whose draws are made at once.
DRAWN_ROWS = 256


def bootstrap_mean_ci(df: DataFrame, value: str, b: int = 10_000, seed: int = 0, key: list[str] | None = None, level: float = 0.95) -> DataFrame:
    """Mean and bootstrap interval of the mean, from ``b`` resamples of n out of n rows.

    A resample is a multinomial count per row, so it can be split: a tree of
    binomial draws halves the blocks of rows and tells each block how many of the
    n draws fall into it, for all replicates.  Every task walks from the root to its
    own blocks, with generators that depend on the node alone, and so agrees with all
    others.  Inside a block the rest is split row group by row group.  A task
    returns ``b`` sums; rows are never repeated, and a retried task draws the same.

    ``key`` (all columns by default) deals rows to blocks and orders them there.
    """
    rows = df.filter(F.col(value).isNotNull())
    place = [F.col(c) for c in key or [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]]
    rows = rows.select(F.pmod(F.xxhash64(*place), F.lit(BLOCKS)).cast("int").alias("block"), F.xxhash64(F.lit(1), *place).alias("at"), F.col(value).cast("double").alias("__x"))
    # At most BLOCKS counts.
    sizes = np.zeros(BLOCKS, np.int64)
    for r in rows.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect():
        sizes[r["block"]] = r["n"]
    n = int(sizes.sum())
    group = DRAWN_ROWS

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, block, memo = np.zeros(b), None, {}
        for batch in batches:
            blocks, values = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2))
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
            for lo, hi in zip(edges, edges[1:]):
                if lo == hi:
                    continue
                if blocks[lo] != block:
                    block = int(blocks[lo])
                    draws, left = _block_draws(sizes, block, b, seed, memo), int(sizes[block])
                    rng = np.random.Generator(np.random.Philox([seed, 1, block]))
                for at in range(lo, hi, group):
                    x = values[at:min(hi, at + group)]
                    here = draws if len(x) == left else rng.binomial(draws, len(x) / left)
                    draws, left = draws - here, left - len(x)
                    picked = x[rng.integers(0, len(x), int(here.sum()), dtype=np.int32)]
                    # Sums of runs; one zero at the end lets a run be empty.
                    total += np.where(here > 0, np.add.reduceat(np.append(picked, 0.0), np.concatenate(([0], np.cumsum(here)[:-1]))), 0.0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(b)), pa.array(total)], names=["r", "s"])

    dealt = rows.repartition("block").sortWithinPartitions("block", "at", "__x")
    parts = dealt.mapInArrow(sums, "r bigint, s double").groupBy("r").agg(F.sum("s").alias("s"))
    return _interval(parts.select("r", F.try_divide(F.col("s"), F.lit(float(n))).alias("__m")), rows, level)


def _block_draws(sizes: np.ndarray, block: int, b: int, seed: int, memo: dict[int, np.ndarray]) -> np.ndarray:
    """How many of the n draws of each replicate fall into ``block``; ``memo`` keeps
    the left shares of the first nodes."""
    draws, lo, hi, node = np.full(b, sizes.sum()), 0, len(sizes), 1
    while hi - lo > 1:
        half, share = (lo + hi) // 2, memo.get(node)
        if share is None:
            left, both = sizes[lo:half].sum(), sizes[lo:hi].sum()
            share = np.random.Generator(np.random.Philox([seed, 0, node])).binomial(draws, left / both)
            if node < KEPT_NODES:
                memo[node] = share
        draws, lo, hi, node = (share, lo, half, 2 * node) if block < half else (draws - share, half, hi, 2 * node + 1)
    return draws


def poisson_bootstrap_mean_ci(df: DataFrame, value: str, key: str, b: int = 1000, seed: int = 0, level: float = 0.95) -> DataFrame:
    """Bootstrap interval of the mean in one pass over a table of any size.

    Each row enters replicate r with a Poisson(1) weight drawn from (key, r);
    for many rows this equals drawing n out of n.  A task holds ``b`` weighted
    sums and sends nothing else; rows are never repeated.
    """
    rows = df.filter(F.col(value).isNotNull()).select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(0)).alias("__key"), F.col(value).cast("double").alias("__x")
    )
    steps, block = np.array(poisson_steps()), max(1, 2_000_000 // b)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replicate = np.arange(b, dtype=np.int64)[:, None]
        total, weight = np.zeros(b), np.zeros(b)
        for batch in batches:
            keys, values = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            for at in range(0, len(keys), block):
                u = draw_numpy(seed, replicate, keys[None, at:at + block]) / float(MODULUS)
                w = np.searchsorted(steps, u, side="right")
                total += w @ values[at:at + block]
                weight += w.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(b)), pa.array(total), pa.array(weight)], names=["r", "s", "c"])

    parts = rows.mapInArrow(sums, "r bigint, s double, c double").groupBy("r").agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
    means = parts.select("r", F.try_divide("s", "c").alias("__m"))
    return _interval(means, rows, level)


def poisson_steps(places: int = 12) -> list[float]:
    """Cumulative Poisson(1) probabilities up to ``places`` events."""
    term, total, steps = 2.718281828459045**-1, 0.0, []
    for k in range(places):
        total += term
        steps.append(total)
        term /= k + 1
    return steps


def _interval(means: DataFrame, rows: DataFrame, level: float) -> DataFrame:
    # b replicate means: their number is an argument, not a size of the data.
    tail = (1 - level) / 2
    ends = means.agg(F.percentile("__m", F.array(F.lit(tail), F.lit(1 - tail))).alias("__e"))
    mean = rows.agg(F.avg("__x")).scalar()
    return ends.select(mean.alias("mean"), F.col("__e")[0].alias("lower"), F.col("__e")[1].alias("upper"))
