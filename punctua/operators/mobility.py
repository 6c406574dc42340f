"""Stops, timetables and the transit graph.  Times of day are seconds after midnight."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from punctua.functions.geo import AREA_KM, CENTRE_LAT, CENTRE_LON, KM_PER_DEGREE, haversine_km, inside_box
from punctua.functions.text import any_flag, lacks_text, non_empty, short_stop_id, true_flag
from punctua.functions.times import (
    DAY_PATTERN, MINUTE_PATTERN, clock_seconds, day_name, in_clock_window, minute_slots, safe_date, safe_ts,
)
from punctua.operators.joins import within_span
from punctua.operators.ordering import chunk_if_long, running
from punctua.operators.relational import prefix_columns, union_edges
from punctua.sources.schemas import BUSINESS_DAYS

# Fixed values of the journey planner: walks shorter than this, in km, at this
# speed in km per minute; trains of one plan less than this many seconds apart.
WALK_KM = 0.5
WALK_KM_PER_MINUTE = 0.05
SAME_JOURNEY_SECONDS = 43_200


def stops_within(
    stops: DataFrame, lat: float = CENTRE_LAT, lon: float = CENTRE_LON, km: float = AREA_KM, fixed_cos: bool = False
) -> DataFrame:
    """Stops closer than ``km`` to a point, with ``distance_km``."""
    y, x = F.col("stop_lat"), F.col("stop_lon")
    near = stops.filter(inside_box(y, x, lat, lon, km, fixed_cos))
    distance = haversine_km(y.cast("double"), x.cast("double"), F.lit(lat), F.lit(lon), fixed_cos)
    return near.withColumn("distance_km", distance).filter(F.col("distance_km") < km)


def events_near(events: DataFrame, stops: DataFrame) -> DataFrame:
    """Stop events at the given stops where the vehicle really stops, with the
    weekday's name.  The join is by stop name, so a stop with several platforms
    repeats its events."""
    real = events.filter(~true_flag("passes_through"))
    return real.join(stops, "stop_name").withColumn("day_name", day_name(safe_date("trip_day", DAY_PATTERN)))


def delay_training(events: DataFrame, years: tuple[int, ...] = (2021, 2022, 2023)) -> DataFrame:
    """Events of the training years; a filter on the partition column."""
    return events.filter(F.col("year").isin(*years))


def od_schedule(
    events: DataFrame, day: str | None, origin: str, destination: str, service: str = "IC", max_s: int = SAME_JOURNEY_SECONDS
) -> DataFrame:
    """Direct trains from one station to another on one day, or on every day (``day`` None).

    Where the table is partitioned by year and month, only the month of ``day`` is read.
    """
    if day is not None and {"year", "month"} <= set(events.columns):
        date = datetime.strptime(day, "%d.%m.%Y")
        events = events.filter((F.col("year") == date.year) & (F.col("month") == date.month))
    real = events.filter(
        (F.lit(True) if day is None else F.col("trip_day") == day)
        & (F.col("service_type") == service)
        & ~true_flag("additional_trip")
        & ~true_flag("passes_through")
    ).withColumnRenamed("line_id", "train_number")

    def side(station: str, column: str, name: str) -> DataFrame:
        at = real.filter((F.col("stop_name") == station) & non_empty(column))
        at = at.select("trip_day", "train_number", F.col(column).alias(name), F.unix_timestamp(safe_ts(column, MINUTE_PATTERN)).alias(f"{name}_s"))
        # Times are whole minutes, so trains of one number and time are paired and sorted once, however many run.
        return at.groupBy(*at.columns).agg(F.count(F.lit(1)).cast("int").alias(f"{name}_n"))

    pairs = within_span(
        side(origin, "sched_dep", "departure"), side(destination, "sched_arr", "arrival"),
        ["trip_day", "train_number"], "departure_s", "arrival_s", max_s,
    )
    named = [*([] if day is not None else ["trip_day"]), "train_number", "departure", "arrival"]
    rows = pairs.orderBy("departure_s", "train_number").select(*named, "arrival_n", F.explode(F.sequence(F.lit(1), "departure_n")))
    return rows.select(*named, F.explode(F.sequence(F.lit(1), "arrival_n")).alias("__no")).select(*named)


def timetable(stops: DataFrame, stop_times: DataFrame, trips: DataFrame, calendar: DataFrame, routes: DataFrame) -> DataFrame:
    """Stop, stop time, trip, calendar and route in one row, as one plan."""
    return (
        stop_times.join(stops, "stop_id")
        .join(trips, "trip_id")
        .join(calendar, "service_id")
        .join(routes, "route_id")
    )


def graph_table(
    stops: DataFrame, stop_times: DataFrame, trips: DataFrame, calendar: DataFrame, routes: DataFrame,
    lo: str = "05:00:00", hi: str = "23:00:00",
) -> DataFrame:
    """Timetable rows within service hours on business days.

    The filters stand before the joins and only the twelve columns of the
    result are read; the days become booleans.
    """
    times = stop_times.filter(in_clock_window("arrival_time", lo, hi) & in_clock_window("departure_time", lo, hi))
    days = calendar.filter(any_flag(BUSINESS_DAYS))
    full = timetable(stops.select("stop_id"), times, trips, days, routes)
    return full.select(
        "stop_id",
        "trip_id",
        clock_seconds("arrival_time").alias("arrival"),
        clock_seconds("departure_time").alias("departure"),
        F.col("stop_sequence").try_cast("int").alias("stop_sequence"),
        "direction_id",
        F.col("route_desc").alias("vehicle"),
        *[true_flag(d).alias(d) for d in BUSINESS_DAYS],
    )


def normalise_stops(df: DataFrame, col: str = "stop_id") -> DataFrame:
    """Without parent stations, platforms merged into their stop, copies removed."""
    return df.filter(lacks_text(col, "Parent")).withColumn(col, short_stop_id(col)).distinct()


def trip_edges(
    table: DataFrame, order: list[str] | None = None, chunk: Column | None = None, unit: int = 60
) -> DataFrame:
    """Edges between consecutive stops of a trip, with the duration in whole
    ``unit`` seconds (minutes).

    ``table`` has trip_id, stop_id, arrival, departure and further columns of
    the trip, which the edge keeps.  ``order`` must be a total order within the
    trip; an overlong trip is processed in chunks of its first order column.
    Edges that run back in time are not among them, see :func:`backward_edges`.
    """
    edges, gap = _consecutive(table, order, chunk)
    extra = [c for c in table.columns if c not in {"trip_id", "stop_id", "arrival", "departure"}]
    return edges.filter(gap >= 0).select(
        F.col("stop_id").alias("src_stop_id"),
        F.col("__next.stop_id").alias("dst_stop_id"),
        F.col("departure").alias("src_departure"),
        F.col("__next.arrival").alias("dst_arrival"),
        F.floor(gap / F.lit(unit)).alias("duration"),
        "trip_id",
        *extra,
    )


def backward_edges(table: DataFrame, order: list[str] | None = None, chunk: Column | None = None) -> DataFrame:
    """(trip_id, n): how many edges of a trip run back in time and are left out."""
    edges, gap = _consecutive(table, order, chunk)
    return edges.filter(gap < 0).groupBy("trip_id").agg(F.count(F.lit(1)).alias("n"))


def _consecutive(table: DataFrame, order: list[str] | None, chunk: Column | None) -> tuple[DataFrame, Column]:
    """Stops with the next one of their trip, and the time between in seconds."""
    order = order or ["stop_sequence", "departure", "arrival", "stop_id"]
    chunk = F.floor(F.col(order[0]) / F.lit(512)) if chunk is None else chunk
    chunk = chunk_if_long(table, ["trip_id"], chunk)
    here = F.struct("stop_id", "arrival")
    rows = running(table, ["trip_id"], order, {"__next": ("last", here)}, chunk, descending=True)
    return rows.filter(F.col("__next").isNotNull()), F.col("__next.arrival") - F.col("departure")


def walking_pairs(stops: DataFrame, max_km: float = WALK_KM, hot_cell: int = 2000) -> DataFrame:
    """Ordered pairs of different stops closer than ``max_km``.

    The Earth is cut into bands of ``max_km``, and each band into cells that are
    not narrower even at the far edge of the next band.  Partners then lie in
    the same or a touching cell of their band and the join is by cell.  Every
    band has its own number of cells, so no stop widens the cells of others.  A
    cell with more than ``hot_cell`` stops is split: one side by a hash, the
    other repeated.
    """
    height = max_km / KM_PER_DEGREE * 1.000001

    def cells_in(band: Column) -> Column:
        edge = F.greatest(F.abs(band * height - 90.0), F.abs((band + 1) * height - 90.0)) + height
        around = F.floor(360.0 * F.cos(F.radians(F.least(F.lit(90.0), edge))) / height)
        return F.greatest(F.lit(1), around).cast("bigint")

    def cell_of(band: Column, lon: Column) -> Column:
        return F.pmod(F.floor((lon + 180.0) / (F.lit(360.0) / cells_in(band))), cells_in(band))

    row = F.floor((F.col("stop_lat") + 90.0) / F.lit(height))
    column = cell_of(row, F.col("stop_lon"))
    placed = stops.select(
        "stop_id", F.col("stop_lat").cast("double").alias("lat"), F.col("stop_lon").cast("double").alias("lon"),
        row.cast("bigint").alias("cy"), column.cast("bigint").alias("cx"),
    )
    counts = placed.groupBy("cy", "cx").agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > hot_cell)
    splits = counts.select("cy", "cx", F.ceil(F.col("__n") / F.lit(hot_cell)).cast("int").alias("__s"))
    parts = F.coalesce(F.col("__s"), F.lit(1))
    left = placed.join(splits, ["cy", "cx"], "left")
    left = left.select(
        *[F.col(c).alias(f"src_{c}") for c in ("stop_id", "lat", "lon")], "cy", "cx",
        F.pmod(F.xxhash64("stop_id"), parts).cast("int").alias("__salt"),
    )
    near_rows = F.array(*[F.col("cy") + d for d in (-1, 0, 1)])
    near_columns = F.array_distinct(F.array(*[F.pmod(F.col("cx") + d, cells_in(F.col("cy"))) for d in (-1, 0, 1)]))
    right = placed.withColumn("cy", F.explode(near_rows)).withColumn("cx", cell_of(F.col("cy"), F.col("lon")))
    right = right.withColumn("cx", F.explode(near_columns))
    right = right.join(splits, ["cy", "cx"], "left")
    right = right.select(
        *[F.col(c).alias(f"dst_{c}") for c in ("stop_id", "lat", "lon")], "cy", "cx",
        F.explode(F.sequence(F.lit(0), parts - 1)).alias("__salt"),
    )
    distance = haversine_km(F.col("src_lat"), F.col("src_lon"), F.col("dst_lat"), F.col("dst_lon"))
    pairs = left.join(right, ["cy", "cx", "__salt"]).filter(F.col("src_stop_id") != F.col("dst_stop_id"))
    return pairs.withColumn("distance_km", distance).filter(F.col("distance_km") < max_km).select(
        "src_stop_id", "dst_stop_id", "distance_km"
    )


def walking_edges(stops: DataFrame, max_km: float = WALK_KM, km_per_minute: float = WALK_KM_PER_MINUTE) -> DataFrame:
    """Walks between near stops in whole minutes, on stop numbers without platform."""
    pairs = walking_pairs(stops.filter(lacks_text("stop_id", "Parent")).distinct(), max_km)
    minutes = F.floor(F.col("distance_km") / F.lit(km_per_minute)).cast("int")
    return pairs.select(
        short_stop_id("src_stop_id").alias("src_stop_id"), short_stop_id("dst_stop_id").alias("dst_stop_id"), minutes.alias("duration")
    ).distinct()


def expand_walks(walks: DataFrame) -> DataFrame:
    """A walk at every minute of the service hours on all business days.

    Only for consumers that want plain time-stamped edges: the router works on
    the walks themselves.
    """
    each = walks.withColumn("__minute", F.explode(minute_slots()))
    return each.select(
        "src_stop_id",
        "dst_stop_id",
        (F.col("__minute") * 60).alias("src_departure"),
        ((F.col("__minute") + F.col("duration")) * 60).alias("dst_arrival"),
        F.col("duration").cast("bigint").alias("duration"),
        F.lit("foot").alias("trip_id"),
        F.lit("foot").alias("vehicle"),
        *[F.lit(True).alias(d) for d in BUSINESS_DAYS],
    )


def build_graph(transit: DataFrame, walks: DataFrame) -> DataFrame:
    """All edges: rides and time-stamped walks."""
    return union_edges(transit.drop("stop_sequence", "direction_id"), walks)


def with_names(df: DataFrame, stops: DataFrame, cols: list[str]) -> DataFrame:
    """Add ``{col}_name`` for each stop number column, one name per stop."""
    names = stops.groupBy("stop_id").agg(F.min("stop_name").alias("stop_name"))
    for col in cols:
        side = prefix_columns(names, "__")
        df = df.join(side, F.col(col) == F.col("__stop_id"), "left").withColumnRenamed("__stop_name", f"{col}_name").drop("__stop_id")
    return df
