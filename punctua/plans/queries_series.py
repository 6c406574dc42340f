"""Queries over time grids and window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.operators import series, trends
from punctua.plans.derived import DAILY_SQL, LINE_EDGES_SQL, T, line_edges
from punctua.plans.queries_aggregates import day_counts
from punctua.plans.registry import query

STEP = 1800

GRID_SQL = f"""
    SELECT g.event_type, make_timestamp(g.b * 1000000) AS ts, value FROM (
        SELECT event_type, unnest(range(lo, hi + {STEP}, {STEP})) AS b FROM (
            SELECT event_type, min(b) AS lo, max(b) AS hi FROM (SELECT event_type, CAST(floor(epoch(ts) / {STEP}) AS BIGINT) * {STEP} AS b FROM events)
            GROUP BY event_type)) g
    LEFT JOIN (SELECT event_type, CAST(floor(epoch(ts) / {STEP}) AS BIGINT) * {STEP} AS b, avg(value) AS value FROM events GROUP BY ALL) v
      ON v.event_type = g.event_type AND v.b = g.b
"""


def grid(spark, sf):
    return series.resample(T(spark, sf, "events"), ["event_type"], "ts", STEP, {"value": F.avg("value")})


@query("win_1", f"SELECT event_type, ts, round(value, 6) AS value FROM ({GRID_SQL})")
def win_1(spark, sf):
    return grid(spark, sf).withColumn("value", F.round("value", 6))


@query("win_2", f"""
    WITH g AS ({GRID_SQL}),
    f AS (SELECT event_type, ts, value,
                 last_value(value IGNORE NULLS) OVER before AS pv, last_value(CASE WHEN value IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER before AS pt,
                 first_value(value IGNORE NULLS) OVER after AS nv, first_value(CASE WHEN value IS NOT NULL THEN epoch(ts) END IGNORE NULLS) OVER after AS nt
          FROM g WINDOW before AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        after AS (PARTITION BY event_type ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_type, ts, round(CASE WHEN value IS NOT NULL THEN value WHEN nv IS NULL THEN pv ELSE pv + (nv - pv) * (epoch(ts) - pt) / (nt - pt) END, 7) AS value FROM f
""")
def win_2(spark, sf):
    return series.interpolate_linear(grid(spark, sf), ["event_type"], "ts", ["value"]).withColumn("value", F.round("value", 7))


@query("win_3", """
    SELECT l_returnflag, CAST(last_day(l_shipdate) AS VARCHAR) AS l_shipdate, round(avg(l_extendedprice), 6) AS price, max(l_quantity) AS quantity
    FROM lineitem GROUP BY ALL
""")
def win_3(spark, sf):
    monthly = series.resample_calendar(
        T(spark, sf, "lineitem"), ["l_returnflag"], "l_shipdate", "month",
        {"price": F.round(F.avg("l_extendedprice"), 6), "quantity": F.max("l_quantity")},
    )
    return monthly.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))


@query("win_4", f"""
    SELECT day, event_type, "count", CAST(rank AS INTEGER) AS rank FROM (
        SELECT day, event_type, "count", rank() OVER (PARTITION BY day ORDER BY "count" DESC) AS rank FROM ({DAILY_SQL})) WHERE rank <= 3
""")
def win_4(spark, sf):
    top = trends.top_k_per(day_counts(spark, sf), ["day"], [F.desc("count")], 3)
    return top.select("day", "event_type", "count", "rank")


@query("win_5", f"""
    SELECT day, week, "count", event_type,
           CAST(sum("count") OVER (PARTITION BY event_type ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS BIGINT) AS rolling_sum
    FROM ({DAILY_SQL})
""")
def win_5(spark, sf):
    return trends.rolling_sum(day_counts(spark, sf), "event_type", "day", "count")


_INCREASE = f"""
    SELECT day, event_type, week, "count", lag("count", 1, 0) OVER (PARTITION BY week, event_type ORDER BY day) AS previous FROM ({DAILY_SQL})
"""


@query("win_6", f'SELECT *, "count" - previous AS increase FROM ({_INCREASE})')
def win_6(spark, sf):
    return trends.increase(day_counts(spark, sf), ["week", "event_type"], "day", "count")


@query("win_7", f"""
    SELECT * FROM (SELECT event_type, week, next_day_increase, CAST(rank() OVER (PARTITION BY week ORDER BY next_day_increase DESC) AS INTEGER) AS rank
        FROM (SELECT event_type, week, max("count" - previous) AS next_day_increase FROM ({_INCREASE}) GROUP BY ALL)) WHERE rank <= 3
""")
def win_7(spark, sf):
    return trends.trending(day_counts(spark, sf), "event_type", 3)


@query("win_8", f'SELECT *, "count" - previous AS increase, round(("count" - previous) / "count", 8) AS growth FROM ({_INCREASE})')
def win_8(spark, sf):
    grown = trends.growth_rate(day_counts(spark, sf), ["week", "event_type"], "day", "count")
    return grown.withColumn("growth", F.round("growth", 8))


@query("win_9", f"""
    SELECT src_stop_id, dst_stop_id, vehicle, count(*) AS n, CAST(sum(duration) AS BIGINT) AS days, min(src_departure) AS first_departure
    FROM ({LINE_EDGES_SQL}) GROUP BY ALL
""")
def win_9(spark, sf):
    return line_edges(spark, sf).groupBy("src_stop_id", "dst_stop_id", "vehicle").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").alias("days"), F.min("src_departure").alias("first_departure")
    )


FOLDS_SQL = """
    SELECT *, CAST(greatest(0, CAST(floor((row_no - 1 - (n - 20 * (n // 21)))::DOUBLE / (n // 21)) AS BIGINT) + 1) AS INTEGER) AS fold
    FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS row_no, count(*) OVER () AS n FROM events)
"""


@query("win_10", f"SELECT fold, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM ({FOLDS_SQL}) GROUP BY fold")
def win_10(spark, sf):
    folds = series.time_series_folds(T(spark, sf, "events"), ["ts", "event_id"], 20)
    return folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
