"""Rows by their place in an order, without sorting or numbering the table.

The k-th key is found by counting: the rows are counted in the buckets of a
range, the bucket with the k-th row becomes the next range, and so on; where the
first order column cannot tell rows apart the next one goes on inside its ties.
All wanted places are looked for at once.  Each round reads the order columns
only and returns at most ``BUCKETS`` counts per place, so nothing is shuffled or
stored but counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

#: Buckets per range and round.
BUCKETS = 1024
#: Equal rows that are written out again by one task.
RUN = 100_000

#: Bytes of a text that make one number.
_BYTES = 7
_NULL, _LOW, _HIGH = -2, -1, BUCKETS


class Cut(NamedTuple):
    """The end of the first ``rank`` rows: those before ``values`` (of the first keys),
    those equal to them if ``inclusive``, or else ``ties`` of the equal ones."""

    rank: int
    values: tuple
    inclusive: bool
    ties: int = 0


class _Key(NamedTuple):
    """A numeric order key."""

    value: Column
    real: bool


class _Range(NamedTuple):
    """Rows that agree in ``values``; if ``narrow``, only those whose next key lies from ``lo`` to ``hi``."""

    values: tuple
    lo: float | int | None
    hi: float | int | None
    narrow: bool = False


def _keys(df: DataFrame, order: Sequence[str | Column]) -> list[_Key]:
    """Numeric keys that order rows as ``order`` does, NULL first."""
    named = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order)])
    longest = {}
    texts = [f.name for f in named.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if texts:
        row = named.agg(*[F.max(F.octet_length(c)).alias(c) for c in texts]).first()
        longest = {c: row[c] or 0 for c in texts}
    keys: list[_Key] = []
    for column, field in zip(order, named.schema.fields):
        c, kind = F.col(column) if isinstance(column, str) else column, field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            # NaN comes last.
            keys.append(_Key(F.isnan(c).cast("bigint") + F.when(c.isNotNull(), 0), False))
            keys.append(_Key(F.when(~F.isnan(c), c.cast("double") + F.lit(0.0)), True))
        elif isinstance(kind, T.DateType):
            keys.append(_Key(F.unix_date(c).cast("bigint"), False))
        elif isinstance(kind, T.TimestampType):
            keys.append(_Key(F.unix_micros(c), False))
        elif isinstance(kind, T.TimestampNTZType):
            keys.append(_Key(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c), False))
        elif isinstance(kind, (T.IntegralType, T.BooleanType)):
            keys.append(_Key(c.cast("bigint"), False))
        elif isinstance(kind, T.DecimalType) and kind.precision <= 18:
            keys.append(_Key((c * F.lit(10**kind.scale).cast("decimal(19,0)")).cast("bigint"), False))
        elif isinstance(kind, (T.StringType, T.BinaryType)):
            data = c.cast("binary")
            for at in range(0, longest[field.name], _BYTES):
                part = F.hex(F.substring(data, at + 1, _BYTES))
                keys.append(_Key(F.conv(F.rpad(part, 2 * _BYTES, "0"), 16, 10).cast("bigint"), False))
            keys.append(_Key(F.octet_length(data).cast("bigint"), False))
        else:
            raise TypeError(f"no order of {kind.simpleString()} values")
    return keys


def find_cuts(df: DataFrame, order: Sequence[str | Column], ranks: Callable[[int], Sequence[int]]) -> list[Cut]:
    """Where the first r rows in ``order`` (ascending, NULL first) end, for every r of
    ``ranks(number of rows)``.

    Rows that agree in all of ``order`` cannot be told apart: a cut may ask for some
    of them by ``ties``.
    """
    keys = _keys(df, order)
    finite = [F.when(~F.col(f"k{i}").isin(float("inf"), float("-inf")), F.col(f"k{i}")) if k.real else F.col(f"k{i}") for i, k in enumerate(keys)]
    rows = df.select(*[k.value.alias(f"k{i}") for i, k in enumerate(keys)])
    ends = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}{i}") for i, c in enumerate(finite) for f in (F.min, F.max)]).first()
    total = ends["n"]
    whole = [(ends[f"min{i}"], ends[f"max{i}"]) for i in range(len(keys))]
    found: dict[int, Cut] = {}
    # rank -> range that holds its last row, rows wanted of it.
    active: dict[int, tuple[_Range, int]] = {}
    for rank in ranks(total):
        if rank <= 0 or rank >= total:
            found[rank] = Cut(rank, (), rank > 0)
        else:
            active[rank] = (_Range((), *whole[0]), rank)
    while active:
        places = list(dict.fromkeys(place for place, _ in active.values()))
        counts = _counts(rows, keys, places)
        for rank, (place, left) in list(active.items()):
            for n, lo, hi in counts[places.index(place)]:
                if left <= n:
                    break
                left -= n
            if lo != hi:
                active[rank] = (_Range(place.values, lo, hi, True), left)
                continue
            values = (*place.values, lo)
            if left == n:
                found[rank] = Cut(rank, values, True)
            elif len(values) == len(keys):
                found[rank] = Cut(rank, values, False, left)
            else:
                active[rank] = (_Range(values, *whole[len(values)]), left)
                continue
            del active[rank]
    return [found[rank] for rank in ranks(total)]


def _counts(rows: DataFrame, keys: list[_Key], places: list[_Range]) -> list[list[tuple]]:
    """(rows, least, greatest) of the filled buckets of every range, in order."""
    parts = []
    for i, place in enumerate(places):
        at = len(place.values)
        v, real = F.col(f"k{at}"), keys[at].real
        inside = _equal(place.values)
        if place.narrow:
            inside = inside & v.between(place.lo, place.hi)
        bucket = F.when(v.isNull(), _NULL)
        if real:
            bucket = bucket.when(v == float("-inf"), _LOW).when(v == float("inf"), _HIGH)
        bucket = bucket.otherwise(_bucket(v, place.lo, place.hi, real))
        none = F.lit(None)
        whole, broken = (none.cast("bigint"), v) if real else (v, none.cast("double"))
        parts.append(F.when(inside, F.struct(F.lit(i).alias("i"), bucket.alias("b"), whole.alias("w"), broken.alias("x"))))
    hit = rows.select(F.explode(F.array_compact(F.array(*parts))).alias("h")).select("h.*") if len(parts) > 1 else rows.select(parts[0].alias("h")).filter("h IS NOT NULL").select("h.*")
    counted = hit.groupBy("i", "b").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c in "wx" for f in (F.min, F.max)])
    out: list[list[tuple]] = [[] for _ in places]
    for r in sorted(counted.collect(), key=lambda r: r["b"]):
        real = keys[len(places[r["i"]].values)].real
        out[r["i"]].append((r["n"], r["min_x"], r["max_x"]) if real else (r["n"], r["min_w"], r["max_w"]))
    return out


def _bucket(v: Column, lo: float | int | None, hi: float | int | None, real: bool) -> Column:
    """Bucket of a value between ``lo`` and ``hi``, which fall into different ones."""
    if lo is None or lo == hi:
        return F.lit(0)
    if not real and hi - lo < 1 << 53:
        share = F.floor((v - F.lit(lo)) / F.lit((hi - lo + 1) / BUCKETS))
    else:
        # Halves, as the range of doubles itself may be infinite.
        half = F.lit(hi / 2 - lo / 2)
        share = F.floor((v.cast("double") / 2 - F.lit(lo / 2)) / half * F.lit(float(BUCKETS - 1)))
    return F.least(F.greatest(share.cast("int"), F.lit(0)), F.lit(BUCKETS - 1))


def _equal(values: tuple) -> Column:
    same = F.lit(True)
    for k, value in enumerate(values):
        same = same & F.col(f"k{k}").eqNullSafe(F.lit(value))
    return same


def _before(cut: Cut) -> Column:
    """Whether a row (with keys k0, k1, ...) lies before a cut, its ties left out."""
    inside = F.lit(cut.inclusive)
    for k in reversed(range(len(cut.values))):
        key, value = F.col(f"k{k}"), cut.values[k]
        # NULL comes first, so nothing is less than it.
        less = F.lit(False) if value is None else key.isNull() | (key < F.lit(value))
        inside = less | (key.eqNullSafe(F.lit(value)) & inside)
    return inside


def number_parts(df: DataFrame, order: Sequence[str], ranks: Callable[[int], Sequence[int]], name: str) -> DataFrame:
    """Add ``name``: in how many of the cuts behind the first ``ranks(number of rows)``
    rows a row lies behind, so 0 up to the first cut.

    ``order`` is ascending with NULL first.  Rows that agree in it are told apart by
    a hash of all columns; equal rows are interchangeable, and where a cut goes
    through a group of them they are counted and written out again.
    """
    full = [*order, F.xxhash64(*[c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))])]
    cuts = find_cuts(df, full, ranks)
    keys = _keys(df, full)
    rows = df.select(F.struct(*df.columns).alias("__row"), *[k.value.alias(f"k{i}") for i, k in enumerate(keys)])
    part = sum((F.when(_before(c), 0).otherwise(1) for c in cuts if not c.ties), F.lit(0)).cast("int")
    torn = list(dict.fromkeys(c.values for c in cuts if c.ties))
    if not torn:
        return rows.select("__row.*", part.alias(name))
    tied = F.lit(False)
    for values in torn:
        tied = tied | _equal(values)
    # A row that is not tied lies before or behind all ties of a cut.
    part = part + sum((F.when(_before(c), 0).otherwise(1) for c in cuts if c.ties), F.lit(0)).cast("int")
    out = rows.filter(~tied).select("__row.*", part.alias(name))
    for values in torn:
        inside = [c for c in cuts if c.ties and c.values == values]
        below = sum((F.when(_before(c), 0).otherwise(1) for c in cuts if not (c.ties and c.values == values)), F.lit(0)).cast("int")
        # One row per distinct row (more than one only if hashes collide).
        groups = rows.filter(_equal(values)).groupBy("__row", below.alias("__below")).agg(F.count(F.lit(1)).alias("__n"))
        ahead = Window.orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)
        groups = groups.withColumn("__from", F.coalesce(F.sum("__n").over(ahead), F.lit(0)))
        runs = groups.withColumn("__at", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__n") - 1, F.lit(RUN).cast("bigint")))).repartition("__at")
        each = runs.withColumn("__at", F.explode(F.sequence("__at", F.least(F.col("__at") + RUN, "__n") - 1)))
        place = F.col("__from") + F.col("__at") + 1
        more = sum((F.when(place > c.ties, 1).otherwise(0) for c in inside), F.lit(0)).cast("int")
        out = out.unionByName(each.select("__row.*", (F.col("__below") + more).cast("int").alias(name)))
    return out


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order`` (ascending, NULL first; all rows if there are fewer), in no order."""
    if n <= 0:
        return df.limit(0)
    return number_parts(df, order, lambda total: [min(n, total)], "__part").filter("__part = 0").drop("__part")
