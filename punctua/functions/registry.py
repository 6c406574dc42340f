"""User-defined functions: the few cases without a built-in counterpart.

Built-ins replace the row-wise functions of lower-casing, category lookup and
binning (``F.lower``, ``transport_code``, ``delay_bin``).  What remains is
registered here in vectorised form: Arrow batches in, Arrow batches out.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import SparkSession, functions as F


def register_scalar(spark: SparkSession, name: str, fn: Callable[[pd.Series], pd.Series], returns: str):
    """Register a function of whole columns for SQL and DataFrame use."""

    def batch(values: pd.Series) -> pd.Series:
        return fn(values)

    return spark.udf.register(name, F.pandas_udf(batch, returns))


def register_aggregate(spark: SparkSession, name: str, fn: Callable[[pd.Series], float], returns: str):
    """Register a function from the values of a group to one value.

    All values of a group reach one Python worker: reduce the rows first (for
    instance to daily means), so that a group has a known small size.
    """

    def whole(values: pd.Series) -> float:
        return fn(values)

    whole.__annotations__["return"] = float
    return spark.udf.register(name, F.pandas_udf(whole, returns))
