"""Queries over counts, percentiles, shares, bootstrap and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.functions.draws import MODULUS, draw_sql
from punctua.operators import aggregates, relational, trends
from punctua.plans.derived import (
    DAILY_SQL, LINE_EDGES_SQL, STOP_EVENTS_SQL, STOPS_SQL, T, line_edges, stop_events, stops, words,
)
from punctua.plans.registry import query, row_count

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def day_counts(spark, sf):
    return trends.daily_counts(T(spark, sf, "events"), "ts", "event_type")


@query("agg_1", f"""
    SELECT CAST(month(l_shipdate) AS VARCHAR) || '_1998' AS month_year, lower(vehicle) AS ttype, count(*) AS stops
    FROM ({STOP_EVENTS_SQL}) WHERE year(l_shipdate) = 1998 GROUP BY ALL
""")
def agg_1(spark, sf):
    return aggregates.monthly_stop_counts(stop_events(spark, sf), 1998)


@query("agg_2", DAILY_SQL)
def agg_2(spark, sf):
    return day_counts(spark, sf)


@query("agg_3", "SELECT event_type, round(avg(value), 6) AS mean_value FROM events GROUP BY event_type")
def agg_3(spark, sf):
    return T(spark, sf, "events").groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean_value"))


@query("agg_4", "SELECT user_id, round(sum(value), 4) AS total, max(value) AS top, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY user_id")
def agg_4(spark, sf):
    return T(spark, sf, "events").groupBy("user_id").agg(
        F.round(F.sum("value"), 4).alias("total"), F.max("value").alias("top"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


# Rounded as a decimal: binary rounding turns 54727.649999999994 into 54727.7.
@query("agg_5", """
    SELECT l_returnflag, CAST(last_day(l_shipdate) AS VARCHAR) AS month_end,
           CAST(round(CAST(CAST(median(l_extendedprice) AS VARCHAR) AS DECIMAL(24, 12)), 1) AS DOUBLE) AS l_extendedprice
    FROM lineitem GROUP BY ALL
""")
def agg_5(spark, sf):
    median = aggregates.monthly_median(T(spark, sf, "lineitem"), ["l_returnflag"], "l_shipdate", "l_extendedprice")
    return median.withColumn("month_end", F.col("month_end").cast("string"))


@query("agg_6", f"""
    WITH trains AS (SELECT DISTINCT l_linenumber FROM lineitem WHERE l_quantity > 25)
    SELECT CAST(l_linenumber AS VARCHAR) AS train_number, quantile_disc(arr_delay, 0.5) AS p_50, quantile_disc(arr_delay, 0.75) AS p_75
    FROM ({STOP_EVENTS_SQL})
    WHERE status <> 'PROGNOSE' AND vehicle = 'Zug' AND service_type = 'IC' AND year(l_shipdate) = 1998 AND stop_name = 'Supplier#000000003'
      AND l_linenumber IN (SELECT l_linenumber FROM trains)
    GROUP BY l_linenumber
""")
def agg_6(spark, sf):
    trains = T(spark, sf, "lineitem").filter("l_quantity > 25").select(F.col("l_linenumber").cast("string").alias("train_number"))
    return aggregates.delay_percentiles(stop_events(spark, sf), "Supplier#000000003", 1998, trains)


@query("agg_7", """
    SELECT user_id, arg_min(value, (ts, event_id)) FILTER (WHERE value >= 10) AS first_value FROM events GROUP BY user_id
""")
def agg_7(spark, sf):
    rows = T(spark, sf, "events").withColumns(
        {"value": F.when(F.col("value") >= 10, F.col("value")), "place": F.struct("ts", "event_id")}
    )
    return rows.groupBy("user_id").agg(aggregates.first_known("value", "place").alias("first_value"))


@query("agg_8", "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY user_id")
def agg_8(spark, sf):
    found = aggregates.distinct_values(T(spark, sf, "events"), ["user_id"], "event_type", "types")
    return found.withColumn("types", F.concat_ws(",", "types"))


@query("agg_9", f'SELECT week, event_type, round(avg("count"), 6) AS avg_count FROM ({DAILY_SQL}) GROUP BY ALL')
def agg_9(spark, sf):
    return trends.weekly_average(day_counts(spark, sf), "event_type").withColumn("avg_count", F.round("avg_count", 6))


@query("agg_10", """
    WITH tokens AS (SELECT lang, unnest(string_split(lower(text), ' ')) AS token FROM documents),
    parts AS (SELECT token, lang, count(*) AS lang_count FROM tokens GROUP BY ALL),
    tot AS (SELECT token, CAST(sum(lang_count) AS BIGINT) AS total_count FROM parts GROUP BY token ORDER BY total_count DESC, token LIMIT 20)
    SELECT token, lang, lang_count, total_count FROM parts JOIN tot USING (token)
""")
def agg_10(spark, sf):
    return aggregates.top_n_with_shares(words(spark, sf), "token", "lang", 20)


@query("agg_11", f"""
    SELECT (SELECT count(*) FROM ({LINE_EDGES_SQL})) AS edges,
           (SELECT count(*) FROM (SELECT src_stop_id FROM ({LINE_EDGES_SQL}) UNION SELECT dst_stop_id FROM ({LINE_EDGES_SQL}))) AS nodes
""")
def agg_11(spark, sf):
    edges = line_edges(spark, sf)
    return edges.agg(F.count(F.lit(1)).alias("edges")).select("edges", relational.nodes(edges).agg(F.count(F.lit(1))).scalar().alias("nodes"))


REPLICATES = 1000
_POISSON = "list_sum([CAST(u >= s AS INTEGER) FOR s IN [" + ", ".join(repr(s) + "::DOUBLE" for s in aggregates.poisson_steps()) + "]])"


_WEIGHTED = f"""
    w AS (SELECT r, value, ({draw_sql(5, 'r', 'coalesce(event_id, 0)')})::DOUBLE / {MODULUS}.0::DOUBLE AS u FROM events CROSS JOIN range(0, {REPLICATES}) t(r) WHERE value IS NOT NULL),
    m AS (SELECT r, sum({_POISSON} * value) / sum({_POISSON}) AS m FROM w GROUP BY r)
"""


@query("agg_12", f"""
    WITH {_WEIGHTED},
         band AS (SELECT round(quantile_cont(m, 0.025), 6) AS lower, round(quantile_cont(m, 0.975), 6) AS upper FROM m)
    SELECT n, mean, lower, upper, -2 AS lower_in_errors, 2 AS upper_in_errors FROM (SELECT count(value) AS n, round(avg(value), 6) AS mean FROM events), band
""")
def agg_12(spark, sf):
    """The band of the weighted replicates as it is, which SQL draws again, and the exact
    bootstrap with the reference's 10,000 replicates; for so many rows the latter's band is
    the normal one, given here in standard errors rounded to whole ones."""
    events = T(spark, sf, "events")
    weighted = aggregates.poisson_bootstrap_mean_ci(events, "value", "event_id", b=REPLICATES, seed=5)
    weighted = weighted.select(*[F.round(c, 6).alias(c) for c in ("lower", "upper")])
    band = aggregates.bootstrap_mean_ci(events, "value", 10_000, 5, ["event_id"])
    error = events.agg((F.stddev_pop("value") / F.sqrt(F.count("value"))).alias("e")).scalar()
    whole = lambda c: F.round((F.col(c) - F.col("mean")) / error).cast("int").alias(f"{c}_in_errors")
    # One row each.
    exact = band.select(events.agg(F.count("value")).scalar().alias("n"), F.round("mean", 6).alias("mean"), whole("lower"), whole("upper"))
    return exact.crossJoin(weighted)


@query("agg_12_poisson", f"""
    WITH w AS (SELECT r, value, ({draw_sql(5, 'r', 'event_id')})::DOUBLE / {MODULUS}.0::DOUBLE AS u FROM events CROSS JOIN range(0, {REPLICATES}) t(r)),
         m AS (SELECT r, sum({_POISSON} * value) / sum({_POISSON}) AS m FROM w GROUP BY r)
    SELECT (SELECT round(avg(value), 6) FROM events) AS mean, round(quantile_cont(m, 0.025), 6) AS lower, round(quantile_cont(m, 0.975), 6) AS upper FROM m
""")
def agg_12_poisson(spark, sf):
    band = aggregates.poisson_bootstrap_mean_ci(T(spark, sf, "events"), "value", "event_id", b=REPLICATES, seed=5)
    return band.select(*[F.round(c, 6).alias(c) for c in ("mean", "lower", "upper")])


YEARS = list(range(1995, 2002))
_YEAR_CELLS = ", ".join(f'max(CASE WHEN y = {y} THEN p_50 END) AS "{y}"' for y in YEARS)


@query("agg_13", f"""
    SELECT week, {_YEAR_CELLS} FROM (
        SELECT year(l_shipdate) AS y, CAST(week(sched_dep) AS INTEGER) AS week, CAST(quantile_disc(dep_delay, 0.5) AS BIGINT) AS p_50
        FROM ({STOP_EVENTS_SQL}) WHERE vehicle = 'Zug' AND starts_with(stop_name, 'Supplier#0') AND status <> 'PROGNOSE' GROUP BY ALL)
    GROUP BY week
""")
def agg_13(spark, sf):
    return aggregates.delay_heatmap(stop_events(spark, sf), "Supplier#0", YEARS)


@query("agg_14", f"""
    SELECT stop_name, p_50, round(stop_lat, 6) AS stop_lat, round(stop_lon, 6) AS stop_lon FROM (
        SELECT stop_name, CAST(quantile_disc(arr_delay, 0.5) AS BIGINT) AS p_50 FROM ({STOP_EVENTS_SQL})
        WHERE vehicle = 'Zug' AND status <> 'PROGNOSE' AND year(l_shipdate) = 1999 AND month(l_shipdate) = 10 GROUP BY stop_name)
    JOIN ({STOPS_SQL}) USING (stop_name)
""")
def agg_14(spark, sf):
    found = aggregates.delay_geomap(stop_events(spark, sf), stops(spark, sf), 1999, 10)
    return found.withColumns({"stop_lat": F.round("stop_lat", 6), "stop_lon": F.round("stop_lon", 6)})


_TYPE_CELLS = ", ".join(f"""coalesce(sum(CASE WHEN event_type = '{t}' THEN "count" END), 0)::BIGINT AS {t}""" for t in EVENT_TYPES)


@query("piv_1", f"SELECT day, {_TYPE_CELLS} FROM ({DAILY_SQL}) GROUP BY day")
def piv_1(spark, sf):
    return aggregates.pivot_values(day_counts(spark, sf), ["day"], "event_type", "count", EVENT_TYPES, fill=0)


_SITES = ["A", "N", "R"]
_SITE_CELLS = ", ".join(
    f"round(max(CASE WHEN l_returnflag = '{s}' THEN {v} END), 6) AS {v}_{s}" for s in _SITES for v in ("price", "quantity") if (s, v) != ("A", "price")
)


@query("piv_2", f"""
    SELECT l_shipdate, {_SITE_CELLS} FROM (
        SELECT l_shipdate, l_returnflag, avg(l_extendedprice) AS price, avg(l_quantity) AS quantity FROM lineitem GROUP BY ALL)
    GROUP BY l_shipdate
""")
def piv_2(spark, sf):
    daily = T(spark, sf, "lineitem").groupBy("l_shipdate", "l_returnflag").agg(
        F.round(F.avg("l_extendedprice"), 6).alias("price"), F.round(F.avg("l_quantity"), 6).alias("quantity")
    )
    return aggregates.site_features(daily, "l_shipdate", "l_returnflag", _SITES, ["price", "quantity"], ["price_A"])


def _wide_sensors(spark, sf):
    """Hourly means per user in one column per user class and measure."""
    events = T(spark, sf, "events").withColumns(
        {"hour": F.date_trunc("hour", "ts").cast("timestamp_ntz"), "sensor": F.pmod("user_id", F.lit(4)) + 1000}
    )
    kind = lambda s, t: F.avg(F.when((F.col("sensor") == s) & (F.col("event_type") == t), F.col("value")))
    cells = [kind(s, t).alias(f"{s}.{m}") for s in range(1000, 1004) for t, m in (("click", "temperature"), ("view", "humidity"))]
    return events.groupBy("hour").agg(*cells)


@query("piv_3", """
    SELECT h.hour, s.sensor AS sensor_id, round(avg(CASE WHEN event_type = 'click' THEN value END), 6) AS temperature,
           round(avg(CASE WHEN event_type = 'view' THEN value END), 6) AS humidity
    FROM (SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events) h CROSS JOIN (SELECT CAST(range AS INTEGER) AS sensor FROM range(1000, 1004)) s
    LEFT JOIN events e ON date_trunc('hour', e.ts) = h.hour AND e.user_id % 4 + 1000 = s.sensor
    GROUP BY ALL
""")
def piv_3(spark, sf):
    long = aggregates.unpivot_sensor(_wide_sensors(spark, sf), "hour")
    return long.withColumns({"temperature": F.round("temperature", 6), "humidity": F.round("humidity", 6)})


_DAY_CELLS = ", ".join(f"""max(CASE WHEN day = {d} THEN "count" END) AS "{d}" """ for d in range(1, 31))


@query("piv_4", f"SELECT event_type AS variable, {_DAY_CELLS} FROM ({DAILY_SQL}) GROUP BY event_type")
def piv_4(spark, sf):
    matrix = aggregates.pivot_values(day_counts(spark, sf), ["day"], "event_type", "count", EVENT_TYPES)
    return aggregates.transpose(matrix, "day", list(range(1, 31)))
