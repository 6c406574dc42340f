"""Queries over projections, filters, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.functions.text import contains_text, date_shaped, lacks_text, non_empty, starts_with
from punctua.functions.times import in_clock_window, safe_cast, safe_ts
from punctua.operators import joins, mobility, relational
from punctua.operators.mobility import timetable, walking_pairs, with_names
from punctua.plans.derived import LINE_EDGES_SQL, STOP_EVENTS_SQL, STOPS_SQL, T, clock_text, distance_sql, line_edges, stop_events, stops
from punctua.plans.registry import query, row_count


@query("prj_1", "SELECT s_name AS stop_name, s_suppkey AS stop_id, s_acctbal AS balance FROM supplier")
def prj_1(spark, sf):
    return relational.select_as(T(spark, sf, "supplier"), {"s_name": "stop_name", "s_suppkey": "stop_id", "s_acctbal": "balance"})


@query("prj_2", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def prj_2(spark, sf):
    return T(spark, sf, "customer").drop("c_name", "c_acctbal")


@query("prj_3", """
    SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n, round(sum(value * 2 + user_id), 4) AS mixed FROM events GROUP BY ALL
""")
def prj_3(spark, sf):
    rows = T(spark, sf, "events").withColumns({"hour": F.hour("ts"), "mixed": F.col("value") * 2 + F.col("user_id")})
    return rows.groupBy("hour").agg(row_count(), F.round(F.sum("mixed"), 4).alias("mixed"))


@query("prj_4", "SELECT c_custkey AS src_custkey, c_name AS src_name, c_nationkey AS src_nationkey, c_acctbal AS src_acctbal, c_mktsegment AS src_mktsegment FROM customer")
def prj_4(spark, sf):
    return relational.prefix_columns(relational.strip_prefix(T(spark, sf, "customer"), 2), "src_")


@query("flt_1", "SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' AND value > 20 GROUP BY user_id")
def flt_1(spark, sf):
    return T(spark, sf, "events").filter((F.col("event_type") == "click") & (F.col("value") > 20)).groupBy("user_id").agg(row_count())


@query("flt_2", "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('view', 'signup') GROUP BY event_type")
def flt_2(spark, sf):
    return T(spark, sf, "events").filter(F.col("event_type").isin("view", "signup")).groupBy("event_type").agg(row_count())


_SEMI = """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE {where}) GROUP BY o_orderstatus
"""


def _semi(spark, sf, where):
    keys = T(spark, sf, "customer").filter(where).select(F.col("c_custkey").alias("o_custkey"))
    kept = joins.keep_keys_in(T(spark, sf, "orders"), keys, ["o_custkey"])
    return kept.groupBy("o_orderstatus").agg(row_count(), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("flt_3", _SEMI.format(where="c_acctbal < 0"))
def flt_3(spark, sf):
    return _semi(spark, sf, F.col("c_acctbal") < 0)


@query("flt_4", "SELECT p_brand, count(*) AS n FROM part WHERE p_name LIKE 'small%' GROUP BY p_brand")
def flt_4(spark, sf):
    return T(spark, sf, "part").filter(starts_with("p_name", "small")).groupBy("p_brand").agg(row_count())


@query("flt_5", "SELECT p_type, count(*) AS n FROM part WHERE lower(p_name) LIKE '%red%' AND NOT p_name LIKE '%ring%' GROUP BY p_type")
def flt_5(spark, sf):
    part = T(spark, sf, "part")
    return part.filter(contains_text("p_name", "RED", ignore_case=True) & lacks_text("p_name", "ring")).groupBy("p_type").agg(row_count())


@query("flt_6", """
    SELECT CAST(l_linenumber AS INTEGER) AS l_linenumber, count(*) AS n FROM lineitem
    WHERE printf('%02d:%02d:00', 2 + CAST(l_linenumber AS INTEGER) * 3, CAST(l_quantity AS INTEGER)) BETWEEN '05:00:00' AND '23:00:00' GROUP BY ALL
""")
def flt_6(spark, sf):
    clock = clock_text()
    rows = T(spark, sf, "lineitem").withColumn("arrival_time", clock)
    return rows.filter(in_clock_window("arrival_time", "05:00:00", "23:00:00")).groupBy("l_linenumber").agg(row_count())


_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday"]


@query("flt_7", """
    SELECT user_id, max(CASE WHEN isodow(ts) = 1 AND event_type = 'signup' THEN 1 ELSE 0 END) AS monday,
           max(CASE WHEN isodow(ts) = 5 AND event_type = 'signup' THEN 1 ELSE 0 END) AS friday
    FROM events GROUP BY user_id HAVING monday = 1 OR friday = 1
""")
def flt_7(spark, sf):
    events = T(spark, sf, "events")
    flag = lambda i: F.max(F.when((F.weekday("ts") == i) & (F.col("event_type") == "signup"), 1).otherwise(0))
    table = events.groupBy("user_id").agg(*[flag(i).cast("string").alias(d) for i, d in enumerate(_DAYS)])
    kept = relational.runs_on_any(table, ["monday", "friday"])
    return kept.select("user_id", F.col("monday").cast("int").alias("monday"), F.col("friday").cast("int").alias("friday"))


@query("flt_8", f"""
    SELECT src_stop_id, count(*) AS n, CAST(sum(duration) AS BIGINT) AS days FROM ({LINE_EDGES_SQL})
    WHERE isodow(DATE '1995-01-01' + src_departure) = 1 AND dst_arrival <= 2000 AND src_departure >= 300 GROUP BY src_stop_id
""")
def flt_8(spark, sf):
    start = F.date_add(F.lit("1995-01-01").cast("date"), F.col("src_departure"))
    edges = line_edges(spark, sf).withColumn("monday", (F.weekday(start) == 0).cast("int"))
    kept = relational.network_window(edges, "monday", 2000, 300)
    return kept.groupBy("src_stop_id").agg(row_count(), F.sum("duration").alias("days"))


@query("flt_9", "SELECT lang, count(*) AS n FROM documents WHERE length(text) > 0 GROUP BY lang")
def flt_9(spark, sf):
    return T(spark, sf, "documents").filter(non_empty("text")).groupBy("lang").agg(row_count())


@query("flt_10", """
    SELECT 'events' AS part, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15'
    UNION ALL SELECT 'orders', count(*) FROM orders WHERE year(o_orderdate) = 1997
""")
def flt_10(spark, sf):
    early = relational.before(T(spark, sf, "events"), "ts", "2024-01-15")
    year = relational.in_year(T(spark, sf, "orders"), "o_orderdate", 1997)
    return early.agg(row_count()).select(F.lit("events").alias("part"), "n").union(year.agg(row_count()).select(F.lit("orders").alias("part"), "n"))


@query("flt_11", """
    SELECT c.c_custkey, c.c_name FROM customer c
    WHERE (c_nationkey, c_mktsegment) IN (SELECT (c_nationkey, c_mktsegment) FROM customer WHERE c_name = 'Customer#000000001')
""")
def flt_11(spark, sf):
    peers = relational.similar_sites(T(spark, sf, "customer"), "Customer#000000001", "c_name", ("c_nationkey", "c_mktsegment"))
    return peers.select("c_custkey", "c_name")


@query("flt_12", """
    SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority
""")
def flt_12(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd.MM.yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return T(spark, sf, "orders").withColumn("day", text).filter(date_shaped("day")).groupBy("o_orderpriority").agg(row_count())


def _holey(spark, sf):
    return T(spark, sf, "events").withColumns(
        {"value": F.when(F.col("value") >= 10, F.col("value")), "kind": F.when(F.col("event_type") != "error", F.col("event_type"))}
    )


_HOLEY = "(SELECT event_id, user_id, CASE WHEN value >= 10 THEN value END AS value, CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events)"


@query("nul_1", f"SELECT kind, count(*) AS n FROM {_HOLEY} WHERE value IS NOT NULL AND kind IS NOT NULL GROUP BY kind")
def nul_1(spark, sf):
    return relational.drop_nulls(_holey(spark, sf), ["value", "kind"]).groupBy("kind").agg(row_count())


@query("nul_2", f"SELECT coalesce(kind, '') AS kind, count(*) AS n, round(sum(coalesce(value, 0)), 4) AS total FROM {_HOLEY} GROUP BY 1")
def nul_2(spark, sf):
    return _holey(spark, sf).na.fill({"kind": "", "value": 0.0}).groupBy("kind").agg(row_count(), F.round(F.sum("value"), 4).alias("total"))


@query("nul_3", f"""
    SELECT 'value' AS column_name, count(*) - count(value) AS nulls, count(value) AS known FROM {_HOLEY}
    UNION ALL SELECT 'kind', count(*) - count(kind), count(kind) FROM {_HOLEY}
    UNION ALL SELECT 'user_id', count(*) - count(user_id), count(user_id) FROM {_HOLEY}
""")
def nul_3(spark, sf):
    return relational.null_census(_holey(spark, sf).select("value", "kind", "user_id"))


@query("ded_1", "SELECT DISTINCT user_id, event_type FROM events")
def ded_1(spark, sf):
    return T(spark, sf, "events").select("user_id", "event_type").distinct()


@query("cnd_1", """
    SELECT CASE WHEN value < 10 THEN 'low' WHEN value < 50 THEN 'mid' ELSE 'high' END AS band, count(*) AS n FROM events GROUP BY 1
""")
def cnd_1(spark, sf):
    band = F.when(F.col("value") < 10, "low").when(F.col("value") < 50, "mid").otherwise("high")
    return T(spark, sf, "events").groupBy(band.alias("band")).agg(row_count())


@query("cst_1", """
    SELECT p_type, count(TRY_CAST(split_part(p_name, ' ', 1) AS INTEGER)) AS bad, count(TRY_CAST(substr(p_brand, 7) AS INTEGER)) AS good,
           CAST(sum(TRY_CAST(substr(p_brand, 7) AS INTEGER)) AS BIGINT) AS total,
           count(TRY_STRPTIME(p_brand, '%d.%m.%Y')) AS dates
    FROM part GROUP BY p_type
""")
def cst_1(spark, sf):
    number = safe_cast(F.substring("p_brand", 7, 10), "int")
    return T(spark, sf, "part").groupBy("p_type").agg(
        F.count(safe_cast(F.split_part("p_name", F.lit(" "), F.lit(1)), "int")).alias("bad"),
        F.count(number).alias("good"), F.sum(number).alias("total"), F.count(safe_ts("p_brand", "dd.MM.yyyy")).alias("dates"),
    )


@query("jon_1", """
    SELECT r_name, p_type, count(*) AS n, round(sum(l_extendedprice), 2) AS total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name, p_type
""")
def jon_1(spark, sf):
    """The timetable chain: lines as stop times, suppliers as stops, orders as
    trips, parts as routes."""
    stop_times = T(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("stop_id"), F.col("l_orderkey").alias("trip_id"), F.col("l_partkey").alias("service_id"), "l_extendedprice"
    )
    places = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("stop_id"), F.col("s_nationkey").alias("route_id"))
    trips = T(spark, sf, "orders").select(F.col("o_orderkey").alias("trip_id"))
    services = T(spark, sf, "part").select(F.col("p_partkey").alias("service_id"), "p_type")
    nation = T(spark, sf, "nation").join(T(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lines = nation.select(F.col("n_nationkey").alias("route_id"), "r_name")
    full = timetable(places, stop_times, trips, services, lines)
    return full.groupBy("r_name", "p_type").agg(row_count(), F.round(F.sum("l_extendedprice"), 2).alias("total"))


_PER_DAY = "SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS {0}s FROM events WHERE event_type = '{0}' GROUP BY ALL"


def _per_day(spark, sf, kind):
    rows = T(spark, sf, "events").filter(F.col("event_type") == kind)
    return rows.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias(f"{kind}s"))


@query("jon_2", f"""
    WITH c AS ({_PER_DAY.format('click')}), v AS ({_PER_DAY.format('view')})
    SELECT user_id, CAST(day AS VARCHAR) AS day, coalesce(clicks, 0) AS clicks, coalesce(views, 0) AS views FROM c FULL JOIN v USING (user_id, day)
""")
def jon_2(spark, sf):
    both = joins.merge_outer(_per_day(spark, sf, "click"), _per_day(spark, sf, "view"), ["user_id", "day"])
    return both.na.fill(0, ["clicks", "views"]).withColumn("day", F.col("day").cast("string"))


@query("jon_3", """
    SELECT d.user_id, d.event_id AS click_id, a.event_id AS purchase_id, CAST(epoch(date_trunc('second', a.ts)) - epoch(date_trunc('second', d.ts)) AS BIGINT) AS seconds
    FROM events d JOIN events a ON d.user_id = a.user_id AND d.event_type = 'click' AND a.event_type = 'purchase'
         AND epoch(date_trunc('second', a.ts)) - epoch(date_trunc('second', d.ts)) > 0
         AND epoch(date_trunc('second', a.ts)) - epoch(date_trunc('second', d.ts)) < 43200
""")
def jon_3(spark, sf):
    def side(kind, name):
        rows = T(spark, sf, "events").filter(F.col("event_type") == kind)
        return rows.select("user_id", F.col("event_id").alias(f"{kind}_id"), F.unix_timestamp("ts").alias(name))

    pairs = joins.within_span(side("click", "start"), side("purchase", "end"), ["user_id"], "start", "end", 43_200)
    return pairs.select("user_id", "click_id", "purchase_id", (F.col("end") - F.col("start")).alias("seconds"))


_STATION = f"""
    SELECT strftime(l_shipdate, '%d.%m.%Y') AS trip_day, CAST(l_linenumber AS VARCHAR) AS train_number, r_name AS station,
           date_trunc('minute', due) AS arrival, date_trunc('minute', sched_dep) AS departure
    FROM ({STOP_EVENTS_SQL}) JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
    WHERE service_type = 'IC' AND NOT passes_through
"""


@query("jon_3_schedule", f"""
    WITH s AS ({_STATION})
    SELECT trip_day, train_number, strftime(d.departure, '%d.%m.%Y %H:%M') AS departure, strftime(a.arrival, '%d.%m.%Y %H:%M') AS arrival
    FROM s d JOIN s a USING (trip_day, train_number)
    WHERE d.station = 'EUROPE' AND a.station = 'ASIA' AND d.departure < a.arrival AND epoch(a.arrival) - epoch(d.departure) < 43200
""")
def jon_3_schedule(spark, sf):
    """Direct trains of every day; a station is a region of suppliers here, so that trains do meet."""
    place = (
        T(spark, sf, "supplier").join(T(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(T(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("s_name").alias("stop_name"), "r_name")
    )
    events = stop_events(spark, sf).join(place, "stop_name").withColumn("stop_name", F.col("r_name")).drop("r_name")
    return mobility.od_schedule(events, None, "EUROPE", "ASIA")


@query("jon_4", _SEMI.format(where="c_mktsegment = 'BUILDING'"))
def jon_4(spark, sf):
    return _semi(spark, sf, F.col("c_mktsegment") == "BUILDING")


@query("jon_5", """
    WITH parts AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL),
         totals AS (SELECT o_orderstatus, count(*) AS total FROM orders GROUP BY ALL)
    SELECT o_orderstatus, o_orderpriority, n, total FROM parts JOIN totals USING (o_orderstatus)
""")
def jon_5(spark, sf):
    parts = T(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(row_count())
    totals = parts.groupBy("o_orderstatus").agg(F.sum("n").alias("total"))
    return parts.join(totals, "o_orderstatus")


@query("jon_6", f"""
    WITH s AS ({STOPS_SQL})
    SELECT a.stop_id AS src_stop_id, b.stop_id AS dst_stop_id, round({distance_sql('a.stop_lat', 'a.stop_lon', 'b.stop_lat', 'b.stop_lon')}, 6) AS distance_km
    FROM s a JOIN s b ON a.stop_id <> b.stop_id WHERE {distance_sql('a.stop_lat', 'a.stop_lon', 'b.stop_lat', 'b.stop_lon')} < 5
""")
def jon_6(spark, sf):
    return walking_pairs(stops(spark, sf), 5.0).withColumn("distance_km", F.round("distance_km", 6))


@query("jon_7", """
    WITH c AS (SELECT date_trunc('hour', ts) AS ts, round(avg(value), 6) AS click FROM events WHERE event_type = 'click' GROUP BY 1),
         v AS (SELECT date_trunc('hour', ts) AS ts, round(avg(value), 6) AS view FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT ts, click, view FROM c FULL JOIN v USING (ts)
""")
def jon_7(spark, sf):
    def hourly(kind):
        rows = T(spark, sf, "events").filter(F.col("event_type") == kind)
        return rows.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(F.round(F.avg("value"), 6).alias(kind))

    return joins.align_on(hourly("click"), hourly("view"), "ts")


@query("jon_8", f"""
    SELECT e.vehicle, s.s_name AS src_stop_id_name, count(*) AS n FROM ({LINE_EDGES_SQL}) e
    LEFT JOIN supplier s ON e.src_stop_id = CAST(s.s_suppkey AS VARCHAR) GROUP BY ALL
""")
def jon_8(spark, sf):
    named = with_names(line_edges(spark, sf), stops(spark, sf), ["src_stop_id"])
    return named.groupBy("vehicle", "src_stop_id_name").agg(row_count())


@query("srt_1", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def srt_1(spark, sf):
    return T(spark, sf, "orders").orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey").select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("lim_1", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 5")
def lim_1(spark, sf):
    counts = T(spark, sf, "lineitem").groupBy("l_partkey").agg(row_count())
    return relational.top_n(counts, [F.desc("n"), F.asc("l_partkey")], 5)


@query("set_1", f"""
    SELECT coalesce(vehicle, 'foot') AS vehicle, count(*) AS n, count(src_departure) AS timed FROM (
        SELECT vehicle, src_departure FROM ({LINE_EDGES_SQL})
        UNION ALL BY NAME
        SELECT a.stop_id AS src FROM ({STOPS_SQL}) a JOIN ({STOPS_SQL}) b ON a.stop_id <> b.stop_id
        WHERE {distance_sql('a.stop_lat', 'a.stop_lon', 'b.stop_lat', 'b.stop_lon')} < 5) GROUP BY 1
""")
def set_1(spark, sf):
    both = relational.union_edges(line_edges(spark, sf), walking_pairs(stops(spark, sf), 5.0))
    return both.groupBy(F.coalesce("vehicle", F.lit("foot")).alias("vehicle")).agg(row_count(), F.count("src_departure").alias("timed"))


@query("set_2", f"SELECT src_stop_id AS stop_id FROM ({LINE_EDGES_SQL}) UNION SELECT dst_stop_id FROM ({LINE_EDGES_SQL})")
def set_2(spark, sf):
    return relational.nodes(line_edges(spark, sf))
