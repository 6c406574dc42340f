"""Order-dependent helpers against pandas, with groups split and unsplit."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from punctua.operators import joins, ordering, series
from punctua.operators.mobility import trip_edges
from punctua.operators.ordering import chunk_if_long, every, exact_quantile, number_rows, running
from punctua.sources import catalog


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; another is NULL."""
    rng = np.random.default_rng(1)
    n = 600
    keys = np.where(rng.random(n) < 0.6, "hot", rng.choice(["a", "b", None], n))
    values = [None if x < 0.2 else float(round(x * 50)) for x in rng.random(n)]
    pdf = pd.DataFrame({"k": keys, "t": rng.permutation(n), "v": values})
    df = spark.createDataFrame(list(pdf.itertuples(index=False, name=None)), "k STRING, t INT, v DOUBLE")
    df = df.withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df, pdf.assign(k=pdf.k.fillna("null")).sort_values(["k", "t"]).reset_index(drop=True)


def collected(df):
    out = pd.DataFrame([r.asDict() for r in df.collect()])
    return out.assign(k=out.k.fillna("null")).sort_values(["k", "t"]).reset_index(drop=True)


@pytest.mark.parametrize("chunk", [None, 1, 7, 1000])
@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running(skewed, chunk, descending, inclusive):
    df, pdf = skewed
    v = F.col("v")
    out = {"s": ("sum", v), "m": ("max", v), "l": ("last", v), "row": ("last", F.struct("t"))}
    got = collected(running(df, ["k"], ["t"], out, None if chunk is None else every("t", chunk), descending, inclusive))
    base = pdf.iloc[::-1] if descending else pdf
    shift = 0 if inclusive else 1
    g = base.groupby("k", sort=False)
    want = pd.DataFrame(
        {
            "s": g.v.transform(lambda x: x.fillna(0).cumsum().shift(shift).where(x.notna().cumsum().shift(shift) > 0)),
            "m": g.v.transform(lambda x: x.cummax().ffill().shift(shift)),
            "l": g.v.transform(lambda x: x.ffill().shift(shift)),
            "row": g.t.transform(lambda x: x.shift(shift)),
        }
    ).sort_index()
    got["row"] = [np.nan if r is None else r["t"] for r in got.row]
    for c in want:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), err_msg=c)


def test_chunk_if_long(skewed):
    df, _ = skewed
    assert chunk_if_long(df, ["k"], F.col("t"), most=600) is None
    assert chunk_if_long(df, ["k"], F.col("t"), most=300) is not None


@pytest.mark.parametrize("classes, listed", [(1, 1000), (1, 0), (3, 1000), (1 << 16, 1000)])
def test_chunk_if_long_counts_classes_first(spark, skewed, monkeypatch, classes, listed):
    """Keys that share a class are counted apart, and no class of them is taken for a key."""
    monkeypatch.setattr(ordering, "KEY_CLASSES", classes)
    monkeypatch.setattr(ordering, "LISTED", listed)
    test_chunk_if_long(skewed)
    short = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("t"))
    assert chunk_if_long(short, ["k"], F.col("t"), most=10) is None
    assert chunk_if_long(short, ["k"], F.col("t"), most=9) is not None
    assert chunk_if_long(short.filter("k < 0"), ["k"], F.col("t"), most=9) is None


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.99, 1.0])
def test_exact_quantile(skewed, q):
    df, pdf = skewed
    want = pdf.groupby("k").v.quantile(q)
    for accuracy in (50, 100_000):
        got = {(r.k or "null"): r.m for r in exact_quantile(df, ["k"], "v", q, "m", accuracy).collect()}
        assert got == pytest.approx(want.to_dict())


def test_number_rows(skewed):
    df, pdf = skewed
    got = collected(number_rows(df, ["t"]))
    assert (got.row_no == pdf.t + 1).all()
    got = collected(number_rows(df, ["t"], keys=["k"]))
    assert (got.row_no == pdf.groupby("k").cumcount() + 1).all()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_skew_join(spark, skewed, how):
    df, _ = skewed
    other = spark.createDataFrame([("hot", 1), ("hot", 2), ("a", 3), (None, 4)], "k STRING, x INT")
    plain = df.join(other, "k", how)
    salted = joins.skew_join(df, other, ["k"], how, share=0.3, salts=4)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.select(*plain.columns).collect()))
    assert [r.k for r in joins.hot_keys(df, ["k"], 0.3).collect()] == ["hot"]


def test_within_span(spark):
    rng = np.random.default_rng(2)
    a = [(int(k), int(t)) for k, t in zip(rng.integers(0, 3, 80), rng.integers(0, 500, 80))]
    b = [(int(k), int(t)) for k, t in zip(rng.integers(0, 3, 80), rng.integers(0, 500, 80))]
    got = joins.within_span(spark.createDataFrame(a, "k INT, s INT"), spark.createDataFrame(b, "k INT, e INT"), ["k"], "s", "e", 40)
    want = sorted((k, s, e) for k, s in a for j, e in b if j == k and 0 < e - s < 40)
    assert sorted((r.k, r.s, r.e) for r in got.collect()) == want


def test_interpolation(spark):
    v = [("a", 0, None), ("a", 1, 1.0), ("a", 2, None), ("a", 3, None), ("a", 4, 7.0), ("a", 5, None), ("b", 0, 5.0), ("b", 1, None), ("b", 2, 6.0)]
    df = spark.createDataFrame(v, "k STRING, i INT, v DOUBLE").withColumn("ts", F.timestamp_seconds(F.col("i") * 1800).cast("timestamp_ntz"))
    want = [None, 1.0, 3.0, 5.0, 7.0, 7.0, 5.0, 5.5, 6.0]
    got = series.interpolate_linear(df, ["k"], "ts", ["v"]).orderBy("k", "i")
    assert [r.v for r in got.collect()] == want


def test_interpolation_over_chunks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    v = [None if x < 0.6 else float(x) for x in rng.random(200)]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(v)], "k STRING, i INT, v DOUBLE").withColumn(
        "ts", F.timestamp_seconds(F.col("i") * 1800).cast("timestamp_ntz")
    )
    want = pd.Series(v, dtype=float).interpolate()
    for most in (1_000_000, 10):
        monkeypatch.setattr(series, "chunk_if_long", lambda d, k, c, most=most: chunk_if_long(d, k, c, most))
        got = series.interpolate_linear(df, ["k"], "ts", ["v"], chunk_seconds=1800 * 9).orderBy("i")
        np.testing.assert_allclose([np.nan if r.v is None else r.v for r in got.collect()], want)


def test_resample_keeps_empty_bins(spark):
    data = [("a", "2017-10-01 00:05:00", 1.0), ("a", "2017-10-01 00:25:00", 3.0), ("a", "2017-10-01 01:40:00", 5.0), ("b", "2017-10-01 03:00:00", 7.0)]
    df = spark.createDataFrame(data, "k STRING, t STRING, v DOUBLE").select("k", F.col("t").cast("timestamp_ntz").alias("ts"), "v")
    got = series.resample(df, ["k"], "ts", 1800, {"v": F.avg("v")}).orderBy("k", "ts").collect()
    assert [(r.k, r.ts.strftime("%H:%M"), r.v) for r in got] == [
        ("a", "00:00", 2.0), ("a", "00:30", None), ("a", "01:00", None), ("a", "01:30", 5.0), ("b", "03:00", 7.0),
    ]
    months = spark.createDataFrame([("2017-01-31", 1.0), ("2017-04-01", 2.0)], "d STRING, v DOUBLE").select(F.col("d").cast("timestamp_ntz").alias("ts"), "v")
    got = series.resample_calendar(months, [], "ts", "month", {"v": F.sum("v")}).orderBy("ts").collect()
    assert [(str(r.ts), r.v) for r in got] == [("2017-01-31", 1.0), ("2017-02-28", None), ("2017-03-31", None), ("2017-04-30", 2.0)]


def test_folds(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(47)], "t INT, v DOUBLE")
    got = series.time_series_folds(df, ["t"], 4).orderBy("t").collect()
    assert [r.fold for r in got] == [0] * 11 + [1] * 9 + [2] * 9 + [3] * 9 + [4] * 9
    with pytest.raises(ValueError):
        series.time_series_folds(df, ["t"], 60)


@pytest.mark.parametrize("run", [10_000, 3])
def test_long_gaps_are_filled_in_runs(spark, monkeypatch, run):
    """One key with a gap of 50 years, and a short and a lone one."""
    monkeypatch.setattr(series, "RUN", run)
    rows = [("a", "1970-01-03 05:00:00", 1.0), ("a", "1970-01-03 07:00:00", 3.0), ("a", "2020-01-03 00:00:00", 5.0), ("b", "1999-12-31 23:00:00", 1.0), ("b", "2000-01-02 01:00:00", 2.0), ("c", "1960-02-29 00:00:00", 7.0)]
    df = spark.createDataFrame(rows, "k STRING, t STRING, v DOUBLE").withColumn("ts", F.col("t").cast("timestamp_ntz"))
    mean = {"v": F.avg("v")}
    days = series.resample(df, ["k"], "ts", 86_400, mean)
    got = {r.k: (r.n, r.known, r.first, r.last, r.days) for r in days.groupBy("k").agg(F.count("*").alias("n"), F.count("v").alias("known"), F.min("ts").cast("string").alias("first"), F.max("ts").cast("string").alias("last"), F.countDistinct("ts").alias("days")).collect()}
    assert got == {"a": (18_263, 2, "1970-01-03 00:00:00", "2020-01-03 00:00:00", 18_263), "b": (3, 2, "1999-12-31 00:00:00", "2000-01-02 00:00:00", 3), "c": (1, 1, "1960-02-29 00:00:00", "1960-02-29 00:00:00", 1)}
    months = series.resample_calendar(df, ["k"], "ts", "month", mean)
    ends = [str(r.ts) for r in months.filter("k = 'a'").orderBy("ts").collect()]
    assert len(ends) == 601 and ends[:2] == ["1970-01-31", "1970-02-28"] and ends[-1] == "2020-01-31"
    assert series.resample_calendar(df, ["k"], "ts", "day", mean).filter("k = 'b'").count() == 3


def test_sampling(spark):
    df = spark.range(20_000)
    picked = catalog.sample_n(df, 500, seed=1, key=["id"])
    assert picked.count() == 500 and picked.distinct().count() == 500
    again = catalog.sample_n(df.repartition(13), 500, seed=1, key=["id"])
    assert picked.exceptAll(again).isEmpty()
    assert catalog.sample_n(df, 30_000, seed=1).count() == 20_000
    rest, out = catalog.holdout(df, 1000, ["id"], seed=2)
    assert (rest.count(), out.count()) == (19_000, 1000) and rest.join(out, "id", "left_semi").isEmpty()


def test_edges_of_a_long_trip(spark, monkeypatch):
    """A trip longer than the limit gives the same edges as one window."""
    from punctua.operators import mobility

    data = [("long", str(i), i * 10, i * 10 + 1, i) for i in range(2000)] + [("short", "x", 5, 6, 3), ("short", "y", 9, 9, 700)]
    df = spark.createDataFrame(data, "trip_id STRING, stop_id STRING, arrival INT, departure INT, stop_sequence INT")
    plain = sorted(map(tuple, trip_edges(df).collect()))
    monkeypatch.setattr(mobility, "chunk_if_long", lambda d, k, c: chunk_if_long(d, k, c, 100))
    assert sorted(map(tuple, trip_edges(df).collect())) == plain and len(plain) == 2000
