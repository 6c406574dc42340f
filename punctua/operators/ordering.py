"""Order-dependent computation that never puts a whole group into one task.

A window ``partitionBy(key)`` hands all rows of a key to one task.  Where the
size of a group has no bound, the operators of this library go through the
helpers below: a group is cut into chunks along its order, every chunk is
handled on its own, and only one summary row per chunk travels further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from punctua.operators.joins import skew_join
from punctua.session import cut_lineage

#: A window over this many rows is fine for one task.
SMALL_GROUP = 200_000
#: Hash classes of keys that are counted before the keys.
KEY_CLASSES = 1 << 16
#: Classes a filter lists; with more, most keys are in one of them.
LISTED = 1000

_GROUP, _CHUNK, _CARRY = "__group", "__chunk", "__carry"


def running(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    out: dict[str, tuple[str, Column]],
    chunk: Column | None,
    descending: bool = False,
    inclusive: bool = False,
) -> DataFrame:
    """Running aggregates per key in ``order``, one task per (key, chunk).

    ``out`` maps a new column to ``(kind, value)``: ``sum``, ``max`` or ``last``
    (the latest non-NULL value) over the rows before the current one, or up to
    it when ``inclusive``.  ``chunk`` must not decrease along ``order``; it
    bounds how many rows of a key meet in a task.  None stands for groups known
    to be small, see :func:`chunk_if_long`.  With ``descending`` the rows are
    taken from the end, so that ``last`` reads the next row's value.
    """
    if chunk is None:
        step = F.desc if descending else F.asc
        w = Window.partitionBy(*keys).orderBy(*[step(c) for c in order])
        w = w.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        return df.withColumns({name: _frame(kind, value).over(w) for name, (kind, value) in out.items()})
    values = {f"__v_{name}": value for name, (_, value) in out.items()}
    rows = df.withColumns({**values, _CHUNK: chunk})
    rows = rows.withColumn(_GROUP, F.struct(*keys, _CHUNK))
    step = F.desc if descending else F.asc
    local = (
        Window.partitionBy(_GROUP)
        .orderBy(*[step(c) for c in order])
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    totals = rows.groupBy(_GROUP).agg(
        *[_total(kind, f"__v_{name}", order, descending).alias(name) for name, (kind, _) in out.items()]
    )
    before = (
        Window.partitionBy(*[f"{_GROUP}.{k}" for k in keys])
        .orderBy(step(f"{_GROUP}.{_CHUNK}"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = F.struct(*[_frame(kind, F.col(name)).over(before).alias(name) for name, (kind, _) in out.items()])
    first = F.row_number().over(before.rowsBetween(Window.unboundedPreceding, 0))
    carries = (
        totals.select(_GROUP, carried.alias(_CARRY), first.alias("__n")).filter("__n > 1").drop("__n")
    )
    rows = rows.withColumns({name: _frame(kind, F.col(f"__v_{name}")).over(local) for name, (kind, _) in out.items()})
    rows = rows.join(carries, _GROUP, "left")
    merged = {name: _merge(kind, F.col(f"{_CARRY}.{name}"), F.col(name)) for name, (kind, _) in out.items()}
    return rows.withColumns(merged).drop(_GROUP, _CHUNK, _CARRY, *values)


def _frame(kind: str, value: Column) -> Column:
    return {"sum": F.sum, "max": F.max, "last": lambda c: F.last(c, ignorenulls=True)}[kind](value)


def _total(kind: str, value: str, order: list[str], descending: bool) -> Column:
    if kind != "last":
        return _frame(kind, F.col(value))
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    return (F.min_by if descending else F.max_by)(F.col(value), place)


def _merge(kind: str, carried: Column, local: Column) -> Column:
    if kind == "last":
        return F.coalesce(local, carried)
    if kind == "max":
        return F.greatest(carried, local)
    return F.coalesce(carried + local, carried, local)


def chunk_if_long(df: DataFrame, keys: list[str], chunk: Column, most: int = SMALL_GROUP) -> Column | None:
    """``chunk`` if some key has more than ``most`` rows, else None.

    Groups are nearly always short, and then one plain window is the better
    plan.  The check counts rows per hash class of the keys, which each task does
    on its own rows first, and then per key in the classes with more than ``most``
    rows alone, mostly none.
    """
    of = F.pmod(F.xxhash64(*keys), F.lit(KEY_CLASSES))
    full = [r[0] for r in df.groupBy(of.alias("__class")).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > most).select("__class").collect()]
    if not full:
        return None
    some = df.filter(of.isin(full)) if len(full) <= LISTED else df
    longest = some.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).agg(F.max("__n")).first()[0]
    return chunk if (longest or 0) > most else None


def every(col: str, width: int) -> Column:
    """Chunk number of an integer order column."""
    return F.floor(F.col(col) / F.lit(width))


def every_seconds(ts: str, width: int) -> Column:
    """Chunk number of a timestamp order column."""
    return F.floor(F.unix_timestamp(F.col(ts)) / F.lit(width))


def number_rows(df: DataFrame, order: list[str], name: str = "row_no", keys: list[str] | None = None) -> DataFrame:
    """Exact 1-based position of each row in ``keys + order``, counted over the
    table, or per key when ``keys`` are given.

    The rows are range-partitioned and sorted, so equal keys spread over tasks
    as long as ``order`` tells them apart.  The sorted rows are checkpointed,
    because positions are only comparable within one sampling of the ranges;
    per range only the counts are looked at afterwards.
    """
    keys = keys or []
    place = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    place = cut_lineage(place.withColumns({"__id": F.monotonically_increasing_id()}))
    part = F.shiftright("__id", 33)
    inside = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    place = place.withColumns({"__part": part, "__inside": inside})
    place = place.withColumn("__at", F.struct("__part", *keys))
    counts = place.groupBy("__at").agg(F.count(F.lit(1)).alias("__n"), F.min("__inside").alias("__first"))
    # One row per range and key; without keys that is one row per task.
    earlier = Window.partitionBy(*[f"__at.{k}" for k in keys]).orderBy("__at.__part")
    offsets = counts.select(
        "__at",
        "__first",
        (F.sum("__n").over(earlier.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n")).alias("__before"),
    )
    numbered = place.join(offsets, "__at")
    position = F.col("__before") + F.col("__inside") - F.col("__first") + 1
    return numbered.withColumn(name, position).drop("__at", "__id", "__part", "__inside", "__first", "__before")


def exact_quantile(df: DataFrame, keys: list[str], value: str, q: float, name: str, accuracy: int = 100_000) -> DataFrame:
    """Exact interpolated quantile per group without collecting the groups.

    A mergeable sketch brackets the quantile first.  The exact step then counts
    the rows below the bracket and looks only at the values inside it (a share
    of about ``20 / accuracy`` of a group), collapsed to distinct values.
    ``percentile`` would hold every distinct value of a group in one buffer.
    """
    slack = 10.0 / accuracy
    sketch = F.percentile_approx(value, [max(q - slack, 0.0), min(q + slack, 1.0)], accuracy)
    # Equal values of a group are one row with a count, so a value that most rows
    # share does not weigh on any task.
    rows = df.filter(F.col(value).isNotNull()).groupBy(F.struct(*keys).alias("__key"), F.col(value).cast("double").alias("__x")).agg(
        F.count(F.lit(1)).alias("__m")
    )
    bounds = df.filter(F.col(value).isNotNull()).groupBy(F.struct(*keys).alias("__key")).agg(
        F.count(F.lit(1)).alias("__n"), sketch.alias("__b")
    )
    bounds = bounds.select(
        "__key", "__n", F.col("__b")[0].cast("double").alias("__lo"), F.col("__b")[1].cast("double").alias("__hi")
    )
    x, lo, hi = F.col("__x"), F.col("__lo"), F.col("__hi")
    # Values outside the bracket collapse to their nearest member, so that the
    # neighbours of the bracket stay known.
    zone = F.when(x < lo, F.lit(-1)).when(x > hi, F.lit(1)).otherwise(F.lit(0))
    # The groups were counted already, so the hot ones are known: at most 100
    # can have more than a hundredth of the rows.
    hot = bounds.filter(F.col("__n") > bounds.agg(F.sum("__n")).scalar() * F.lit(0.01))
    placed = skew_join(rows, bounds, ["__key"], hot=hot).withColumn("__zone", zone)
    inside = F.when(F.col("__zone") == 0, x)
    counted = placed.groupBy("__key", "__n", "__zone", inside.alias("__in")).agg(
        F.sum("__m").alias("__c"), F.min("__x").alias("__min"), F.max("__x").alias("__max")
    )
    upto = Window.partitionBy("__key").orderBy("__zone", "__in").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("__upto", F.sum("__c").over(upto))
    pos = F.lit(q) * (F.col("__n") - 1)
    found = []
    for at in (F.floor(pos), F.ceil(pos)):
        hit = (F.col("__upto") > at) & (F.col("__upto") - F.col("__c") <= at)
        # Outside the bracket only the member next to it is known by rank.
        known = (
            F.when(F.col("__zone") == 0, F.col("__in"))
            .when((F.col("__zone") == -1) & (F.col("__upto") - 1 == at), F.col("__max"))
            .when((F.col("__zone") == 1) & (F.col("__upto") - F.col("__c") == at), F.col("__min"))
            .otherwise(F.raise_error(F.lit("quantile outside its bracket: raise accuracy")))
        )
        found.append(F.max(F.when(hit, known)))
    share = pos - F.floor(pos)
    result = ranked.groupBy("__key", "__n").agg(found[0].alias("__a"), found[1].alias("__z"))
    mixed = F.col("__a") * (1 - share) + F.col("__z") * share
    return result.select("__key.*", mixed.alias(name))
