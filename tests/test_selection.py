"""Cuts at given ranks, found by counting, against sorting in the driver."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from punctua.operators import selection, series
from punctua.sources import catalog

KINDS = {
    "int": lambda r: r.choice([None, 0, 1, -5, 7]),
    "bigint": lambda r: r.choice([None, -(2**63), 2**63 - 1, r.randrange(-(2**62), 2**62), 2**60 + r.randrange(5)]),
    "double": lambda r: r.choice([None, float("nan"), math.inf, -math.inf, 0.0, -0.0, 1e308, -1e308, r.random(), 1e-300 * r.random()]),
    "string": lambda r: r.choice([None, "", "a", "a\0", "ab", "é", "long common beginning " + r.choice("abc"), "z" * 30]),
    "date": lambda r: dt.date(1969, 12, 25) + dt.timedelta(days=r.randrange(12)),
    "timestamp": lambda r: dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=r.randrange(4)),
    "boolean": lambda r: r.choice([None, True, False]),
    "decimal(9,2)": lambda r: __import__("decimal").Decimal(r.randrange(-300, 300)) / 100,
}


def place(value):
    """Sort key: NULL first, NaN last, texts by bytes."""
    if value is None:
        return (0, 0)
    if isinstance(value, float) and math.isnan(value):
        return (2, 0)
    return (1, value.encode() if isinstance(value, str) else value)


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("buckets", [4, 1024])
def test_any_kind_of_key(spark, monkeypatch, kind, buckets):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    monkeypatch.setattr(selection, "_HIGH", buckets)
    rng = random.Random(kind)
    rows = [(KINDS[kind](rng), i) for i in range(300)]
    df = spark.createDataFrame(rows, f"k {kind}, i INT").repartition(5)
    ranks = [0, 1, 2, 50, 51, 149, 150, 298, 299, 300]
    got = {r.i: r.part for r in selection.number_parts(df, ["k", "i"], lambda n: ranks, "part").collect()}
    ordered = sorted(rows, key=lambda r: (place(r[0]), r[1]))
    assert got == {i: sum(p >= r for r in ranks) for p, (_, i) in enumerate(ordered)}


def test_equal_rows_are_split_by_count(spark, monkeypatch):
    monkeypatch.setattr(selection, "RUN", 7)
    df = spark.createDataFrame([(1, "a")] * 40 + [(2, "b")] * 100 + [(3, None)] * 20, "k INT, v STRING")
    parts = selection.number_parts(df, ["k"], lambda n: [10, 40, 41, 77, 150], "part").groupBy("k", "v", "part").count().collect()
    assert {(r.k, r.part): r["count"] for r in parts} == {(1, 0): 10, (1, 1): 30, (2, 2): 1, (2, 3): 36, (2, 4): 63, (3, 4): 10, (3, 5): 10}


def test_ties_in_the_order_are_told_apart_by_the_row(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    one, two = (selection.first_rows(d, ["k"], 100) for d in (df.repartition(7), df.repartition(3)))
    assert sorted(one.collect()) == sorted(two.collect()) and one.count() == 100 and one.filter("k > 0").isEmpty()


def test_few_rows(spark):
    df = spark.range(3)
    assert selection.first_rows(df, ["id"], 0).count() == 0
    assert selection.first_rows(df, ["id"], 9).count() == 3
    assert selection.first_rows(df.limit(0), ["id"], 2).count() == 0
    with pytest.raises(TypeError):
        selection.first_rows(df.select(F.array("id").alias("a")), ["a"], 1)


def test_folds_read_counts_only(spark):
    """No sort, no shuffle of rows, no stored copy."""
    df = spark.range(5000).select((F.col("id") % 11).alias("t"), "id")
    folds = series.time_series_folds(df, ["t", "id"], 9)
    plan = folds._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Exchange", "Sort", "Window", "RDDScan")) or "Scan ExistingRDD" in plan and "Exchange" not in plan
    assert {r.fold: r["count"] for r in folds.groupBy("fold").count().collect()} == {k: 500 for k in range(10)}


def test_samples_are_filters(spark):
    df = spark.range(20_000)
    picked = catalog.sample_n(df, 500, seed=1, key=["id"])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert picked.count() == 500 and "Exchange" not in plan and "Sort" not in plan
