"""Delay, delay bins and the chance of being on time."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import add

from pyspark.sql import Column, functions as F

# Upper edges (minutes) of the delay bins; a last bin is open.
BIN_EDGES = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20, 30]
N_BINS = len(BIN_EDGES) + 1

# Category numbers of the transport types; anything else is 0.
TRANSPORT_CODES = {"": 0, "zug": 1, "bus": 2, "tram": 3}

# Statuses of a prognosis that count as measured.
MEASURED = ("REAL", "GESCHAETZT")

# The fallback chance when nothing is known about a connection.
FALLBACK_BASE = 0.99
FALLBACK_MINUTES = 10


def delay_seconds(scheduled: Column, actual: Column) -> Column:
    """Lateness in seconds, early counts as 0; NULL where either is missing."""
    late = F.unix_timestamp(actual) - F.unix_timestamp(scheduled)
    return clamp_at_zero(late)


def delay_minutes(scheduled: Column, actual: Column) -> Column:
    return delay_seconds(scheduled, actual) / F.lit(60.0)


def clamp_at_zero(col: Column) -> Column:
    """Negative to 0 while NULL stays NULL (``greatest`` alone skips NULLs)."""
    return F.when(col.isNotNull(), F.greatest(F.lit(0), col))


def delay_bin(minutes: Column) -> Column:
    """Number of the right-closed bin: 0 for <= 0, ..., 14 for > 30.

    It is the number of edges below the delay, which stays inside generated
    code, unlike a function over an array of edges.
    """
    return reduce(add, [(minutes > F.lit(float(e))).cast("int") for e in BIN_EDGES])


def transport_code(vehicle: Column) -> Column:
    """Category number of a transport type, upper or lower case."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(TRANSPORT_CODES.items())])
    return F.coalesce(F.try_element_at(table, F.lower(vehicle)), F.lit(0))


def fallback_chance(minutes: Column) -> Column:
    """Chance that a delay stays within ``minutes`` when no history is known."""
    chance = F.pow(F.lit(FALLBACK_BASE), F.lit(float(FALLBACK_MINUTES)) - minutes)
    return F.when(minutes.isNotNull(), F.least(chance, F.lit(1.0)))
