"""Journey planning: from timetable files and delay history to routes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctua.functions.delays import delay_minutes
from punctua.functions.text import short_stop_id, true_flag
from punctua.functions.times import MINUTE_PATTERN, SECOND_PATTERN, safe_ts
from punctua.operators.delay_history import delay_cdf
from punctua.operators.mobility import graph_table, normalise_stops, stops_within, walking_edges
from punctua.operators.routing import recover, route, route_table


def network(
    stops: DataFrame, stop_times: DataFrame, trips: DataFrame, calendar: DataFrame, routes: DataFrame, day: str
) -> tuple[DataFrame, DataFrame]:
    """Stop times of one weekday in the planner's area, and the walks."""
    near = stops_within(stops)
    table = normalise_stops(graph_table(near, stop_times, trips, calendar, routes))
    return table.filter(true_flag(day)), walking_edges(near)


def history(events_near: DataFrame) -> DataFrame:
    """Delay history per stop, transport type and hour of the scheduled arrival."""
    due, real = safe_ts("sched_arr", MINUTE_PATTERN), safe_ts("act_arr", SECOND_PATTERN)
    rows = events_near.select(
        short_stop_id("stop_id").alias("stop_id"), F.lower("vehicle").alias("vehicle"), F.hour(due).alias("hour"),
        delay_minutes(due, real).alias("delay_minutes"),
    )
    return delay_cdf(rows, ["stop_id", "vehicle", "hour"])


def plan(requests: DataFrame, stop_times: DataFrame, walks: DataFrame, cdf: DataFrame, stops: DataFrame, **settings) -> DataFrame:
    """Leg-by-leg table of the best route of every request."""
    labels = route(requests, stop_times, walks, cdf, **settings)
    return route_table(recover(labels, requests), stops)
