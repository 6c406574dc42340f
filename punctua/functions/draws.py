"""Repeatable pseudo-random numbers from integer keys.

``rand(seed)`` depends on how rows are partitioned, so a retried task may draw
other numbers.  These draws depend on the key alone.  The constants are those
of the public Park-Miller "minimal standard" generator; the square makes
neighbouring keys unrelated.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F

MODULUS = 2147483647
STEP_A = 48271
STEP_B = 69621


def draw_int(seed: int, *keys: Column) -> Column:
    """Integer in [0, 2147483646] from ``seed`` and integer key columns."""
    x = F.lit(seed % MODULUS).cast("bigint")
    for key in keys:
        x = _mix((x * F.lit(STEP_A) + F.pmod(key.cast("bigint"), F.lit(MODULUS)) * F.lit(STEP_B)) % F.lit(MODULUS))
    return _mix(x)


def draw_numpy(seed: int, *keys: np.ndarray) -> np.ndarray:
    """The same integers for whole arrays of keys, inside a task."""
    x = np.int64(seed % MODULUS)
    for key in keys:
        x = _mix_numpy((x * STEP_A + np.mod(key.astype(np.int64), MODULUS) * STEP_B) % MODULUS)
    return _mix_numpy(x)


def draw_unit(seed: int, *keys: Column) -> Column:
    """Double in [0, 1)."""
    return draw_int(seed, *keys) / F.lit(float(MODULUS))


def draw_sql(seed: int, *keys: str) -> str:
    """The same integer as SQL text."""
    x = str(seed % MODULUS)
    for key in keys:
        x = _mix_sql(f"(({x})::BIGINT * {STEP_A} + (({key})::BIGINT % {MODULUS}) * {STEP_B}) % {MODULUS}")
    return _mix_sql(x)


def _mix(x: Column) -> Column:
    return (x * (x + F.lit(STEP_A)) + F.lit(11)) % F.lit(MODULUS)


def _mix_numpy(x: np.ndarray) -> np.ndarray:
    return (x * (x + STEP_A) + 11) % MODULUS


def _mix_sql(x: str) -> str:
    return f"list_transform([({x})::BIGINT], lambda q: (q * (q + {STEP_A}) + 11) % {MODULUS})[1]"
