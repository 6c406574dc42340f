"""Queries over stops, the transit graph and routes."""

from __future__ import annotations

from pyspark.sql import functions as F

from punctua.operators import mobility, routing
from punctua.operators.delay_history import delay_cdf
from punctua.plans.derived import (
    LINE_DELAYS_SQL, LINE_EDGES_SQL, LINE_STOP_TIMES_SQL, STOP_EVENTS_SQL, STOPS_SQL, T, clock_text, bin_sql, distance_sql, line_delays,
    line_edges, line_stop_times, stop_events, stops,
)
from punctua.plans.registry import query, row_count


#: Circle that holds part of the derived stops.
LAT, LON, KM = 10.0, 20.0, 9000.0
_DISTANCE = distance_sql("stop_lat", "stop_lon", f"{LAT}", f"{LON}")
NEAR_SQL = f"SELECT *, {_DISTANCE} AS distance_km FROM ({STOPS_SQL}) WHERE {_DISTANCE} < {KM}"


def near(spark, sf):
    return mobility.stops_within(stops(spark, sf), LAT, LON, KM)


@query("mob_1", f"SELECT stop_id, round(distance_km, 5) AS distance_km FROM ({NEAR_SQL})")
def mob_1(spark, sf):
    return near(spark, sf).select("stop_id", F.round("distance_km", 5).alias("distance_km"))


@query("mob_2", f"""
    SELECT stop_id, dayname(l_shipdate) AS day_name, count(*) AS n FROM ({STOP_EVENTS_SQL}) JOIN ({NEAR_SQL}) USING (stop_name) WHERE NOT passes_through GROUP BY ALL
""")
def mob_2(spark, sf):
    return mobility.events_near(stop_events(spark, sf), near(spark, sf)).groupBy("stop_id", "day_name").agg(row_count())


def _timetable(spark, sf):
    """Timetable tables in their text form: lines as stop times, orders as
    trips, customers as services, nations as routes."""
    line, order = T(spark, sf, "lineitem"), T(spark, sf, "orders")
    clock = clock_text()
    stop_times = line.select(
        F.col("l_orderkey").cast("string").alias("trip_id"), clock.alias("arrival_time"), clock.alias("departure_time"),
        F.col("l_suppkey").cast("string").alias("stop_id"), F.col("l_linenumber").cast("string").alias("stop_sequence"),
    )
    trips = order.select(
        F.col("o_orderkey").cast("string").alias("trip_id"), F.col("o_custkey").cast("string").alias("service_id"),
        (F.col("o_custkey") % 25).cast("string").alias("route_id"), F.lit("0").alias("direction_id"),
    )
    runs = lambda i: F.when((F.col("c_custkey") + i) % 7 < 2, "1").otherwise("0")
    days = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
    calendar = T(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("service_id"), *[runs(i).alias(d) for i, d in enumerate(days)])
    routes = T(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("route_id"), F.col("n_name").alias("route_desc"))
    return stop_times, trips, calendar, routes


@query("mob_3", """
    SELECT n_name AS vehicle, count(*) AS n, CAST(min(clock) AS INTEGER) AS first_arrival, CAST(max(clock) AS INTEGER) AS last_departure,
           CAST(sum(CAST(c_custkey % 7 < 2 AS INTEGER)) AS BIGINT) AS mondays, CAST(sum(CAST((c_custkey + 4) % 7 < 2 AS INTEGER)) AS BIGINT) AS fridays
    FROM (SELECT *, (2 + CAST(l_linenumber AS INTEGER) * 3) * 3600 + CAST(l_quantity AS INTEGER) * 60 AS clock FROM lineitem)
    JOIN supplier ON s_suppkey = l_suppkey JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = o_custkey % 25
    WHERE clock BETWEEN 5 * 3600 AND 23 * 3600
      AND (c_custkey % 7 < 2 OR (c_custkey + 1) % 7 < 2 OR (c_custkey + 2) % 7 < 2 OR (c_custkey + 3) % 7 < 2 OR (c_custkey + 4) % 7 < 2)
    GROUP BY n_name
""")
def mob_3(spark, sf):
    table = mobility.graph_table(stops(spark, sf), *_timetable(spark, sf))
    return table.groupBy("vehicle").agg(
        row_count(), F.min("arrival").alias("first_arrival"), F.max("departure").alias("last_departure"),
        F.count_if("monday").alias("mondays"), F.count_if("friday").alias("fridays"),
    )


@query("mob_4", """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n FROM lineitem WHERE year(l_shipdate) IN (1996, 1997) GROUP BY ALL
""")
def mob_4(spark, sf):
    return mobility.delay_training(stop_events(spark, sf), (1996, 1997)).groupBy("year", "month").agg(row_count())


@query("mob_5", """
    SELECT DISTINCT substr(CAST(8500000 + l_suppkey AS VARCHAR), 1, 7) AS stop_id, l_linestatus FROM lineitem WHERE l_returnflag <> 'R'
""")
def mob_5(spark, sf):
    number = (F.lit(8500000) + F.col("l_suppkey")).cast("string")
    stop_id = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("Parent"), number)).otherwise(F.concat_ws(":", number, F.lit("0"), F.col("l_linenumber").cast("string")))
    return mobility.normalise_stops(T(spark, sf, "lineitem").select(stop_id.alias("stop_id"), "l_linestatus"))


@query("mob_6", f"SELECT src_stop_id, dst_stop_id, src_departure, dst_arrival, duration, vehicle, count(*) AS n FROM ({LINE_EDGES_SQL}) GROUP BY ALL")
def mob_6(spark, sf):
    return line_edges(spark, sf).groupBy("src_stop_id", "dst_stop_id", "src_departure", "dst_arrival", "duration", "vehicle").agg(row_count())


#: Longer and faster walks than the planner's, as the derived stops lie apart.
WALK_KM, WALK_SPEED = 5.0, 1.0
_PAIR = distance_sql("a.stop_lat", "a.stop_lon", "b.stop_lat", "b.stop_lon")
WALKS_SQL = f"""
    SELECT DISTINCT substr(a.stop_id, 1, 7) AS src_stop_id, substr(b.stop_id, 1, 7) AS dst_stop_id, CAST(floor({_PAIR} / {WALK_SPEED}) AS INTEGER) AS duration
    FROM ({STOPS_SQL}) a JOIN ({STOPS_SQL}) b ON a.stop_id <> b.stop_id WHERE {_PAIR} < {WALK_KM}
"""


def walks(spark, sf):
    return mobility.walking_edges(stops(spark, sf), WALK_KM, WALK_SPEED)


@query("mob_7", WALKS_SQL)
def mob_7(spark, sf):
    return walks(spark, sf)


@query("mob_8", f"""
    SELECT src_stop_id, dst_stop_id, count(*) AS n, CAST(min(slot) * 60 AS INTEGER) AS first_departure, CAST(max(slot + duration) * 60 AS INTEGER) AS last_arrival
    FROM ({WALKS_SQL}) CROSS JOIN (SELECT unnest(range(300, 1381)) AS slot) GROUP BY ALL
""")
def mob_8(spark, sf):
    return mobility.expand_walks(walks(spark, sf)).groupBy("src_stop_id", "dst_stop_id").agg(
        row_count(), F.min("src_departure").alias("first_departure"), F.max("dst_arrival").alias("last_arrival")
    )


@query("mob_9", f"""
    SELECT vehicle, count(*) AS n, CAST(sum(duration) AS BIGINT) AS total FROM (
        SELECT vehicle, duration FROM ({LINE_EDGES_SQL})
        UNION ALL SELECT 'foot', duration FROM ({WALKS_SQL}) CROSS JOIN range(300, 1381)) GROUP BY vehicle
""")
def mob_9(spark, sf):
    graph = mobility.build_graph(line_edges(spark, sf), mobility.expand_walks(walks(spark, sf)))
    return graph.groupBy("vehicle").agg(row_count(), F.sum("duration").alias("total"))


#: The SQL writes this many rounds out; the search itself goes on until nothing improves.
ROUNDS, TRANSFER, CONFIDENCE = 8, 1, 0.3


def requests(spark, sf):
    """One request per nation: from its last supplier to its first, to arrive
    by a day that differs from nation to nation."""
    return T(spark, sf, "supplier").groupBy("s_nationkey").agg(F.min("s_suppkey").alias("lo"), F.max("s_suppkey").alias("hi")).select(
        F.col("s_nationkey").cast("bigint").alias("req_id"), F.col("hi").cast("string").alias("origin_id"), F.col("lo").cast("string").alias("dest_id"),
        (1300 + F.col("s_nationkey") * 20).alias("earliest_departure"), (2000 + F.col("s_nationkey") * 20).alias("arrive_by"),
        F.lit(CONFIDENCE).alias("min_confidence"),
    )


def search(spark, sf, asked=None):
    return routing.route(
        requests(spark, sf) if asked is None else asked, line_stop_times(spark, sf), walks(spark, sf), delay_cdf(line_delays(spark, sf), ["vehicle"]),
        cdf_keys=("vehicle",), transfer=TRANSFER, per_minute=1, slice_width=50,
    )


def best_routes(spark, sf):
    """The latest of all routes worth offering per request."""
    return routing.recover(search(spark, sf), requests(spark, sf)).filter("route_no = 1")


def _route_sql() -> str:
    """The rounds written out one by one; a ride here is any pair of stops of a trip."""

    def best(rows: str, columns: str = "*") -> str:
        """The labels worth keeping per request and stop."""
        order = "p DESC, walk, rides, rnd, t DESC, d DESC, b DESC, nd DESC, nf DESC"
        one = f"SELECT {columns} FROM ({rows}) QUALIFY row_number() OVER (PARTITION BY req_id, stop_id, dep ORDER BY {order}) = 1"
        later = "max(p) OVER (PARTITION BY req_id, stop_id ORDER BY dep DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return f"SELECT * FROM ({one}) QUALIFY p > coalesce({later}, -1)"

    walk = """
        SELECT l.req_id, w.src_stop_id AS stop_id, l.dep - w.minutes AS dep, l.p, l.walk + w.minutes AS walk, l.rides, l.rnd, l.q, l.earliest, l.dest_id, 'foot' AS t, w.dst_stop_id AS d, CAST(l.dep AS BIGINT) AS b, CAST(l.dep AS BIGINT) AS nd, false AS nf,
               list_prepend({'t': 'foot', 'v': 'foot', 's': w.src_stop_id, 'd': w.dst_stop_id, 'a': l.dep - w.minutes, 'b': CAST(l.dep AS BIGINT), 'p': l.p}, l.path) AS path
        FROM %s l JOIN foot w ON w.dst_stop_id = l.stop_id WHERE l.dep - w.minutes >= l.earliest AND w.src_stop_id <> l.dest_id"""
    parts = [f"""
        st AS MATERIALIZED ({LINE_STOP_TIMES_SQL}),
        b AS (SELECT vehicle, {bin_sql('delay_minutes')} AS b FROM ({LINE_DELAYS_SQL})),
        cdf AS MATERIALIZED (SELECT vehicle, g.range AS bin, count(CASE WHEN b <= g.range THEN 1 END) / count(*) AS chance FROM b CROSS JOIN range(0, 15) g GROUP BY ALL),
        foot AS MATERIALIZED (SELECT src_stop_id, dst_stop_id, CAST(min(duration) AS INTEGER) AS minutes FROM ({WALKS_SQL}) WHERE src_stop_id <> dst_stop_id GROUP BY ALL),
        start AS (SELECT CAST(s_nationkey AS BIGINT) AS req_id, CAST(min(s_suppkey) AS VARCHAR) AS stop_id, CAST(2000 + s_nationkey * 20 AS BIGINT) AS dep, 1.0::DOUBLE AS p,
                         0 AS walk, 0 AS rides, 0 AS rnd, {CONFIDENCE}::DOUBLE AS q, CAST(1300 + s_nationkey * 20 AS BIGINT) AS earliest, CAST(min(s_suppkey) AS VARCHAR) AS dest_id,
                         CAST(NULL AS VARCHAR) AS t, CAST(NULL AS VARCHAR) AS d, CAST(NULL AS BIGINT) AS b, CAST(NULL AS BIGINT) AS nd, CAST(NULL AS BOOLEAN) AS nf,
                         CAST([] AS STRUCT(t VARCHAR, v VARCHAR, s VARCHAR, d VARCHAR, a BIGINT, b BIGINT, p DOUBLE)[]) AS path
                  FROM supplier GROUP BY s_nationkey),
        l0 AS MATERIALIZED ({best("SELECT * FROM start UNION ALL BY NAME " + walk % 'start')})"""]
    for k in range(1, ROUNDS + 1):
        before = f"l{k - 1}"
        parts.append(f"""
        off{k} AS MATERIALIZED (
            SELECT l.req_id, a.trip_id, a.stop_sequence, a.arrival, a.stop_id AS "to", a.vehicle, l.walk, l.rides, l.path, l.dep AS nd, coalesce(l.t = 'foot', false) AS nf, l.q, l.earliest, l.dest_id, l.p * c.chance AS p
            FROM {before} l JOIN st a ON a.stop_id = l.stop_id AND l.rnd = {k - 1}
                 AND a.arrival + CASE WHEN l.stop_id = l.dest_id THEN 0 ELSE {TRANSFER} END <= l.dep AND a.arrival >= l.earliest
            JOIN cdf c ON c.vehicle = a.vehicle AND c.bin = {bin_sql(f"CAST(l.dep - a.arrival - CASE WHEN l.stop_id = l.dest_id THEN 0 ELSE {TRANSFER} END AS DOUBLE)")}
            WHERE l.p * c.chance >= l.q),
        on{k} AS MATERIALIZED (
            SELECT o.req_id, s.stop_id, s.departure AS dep, o.p, o.walk, o.rides + 1 AS rides, {k} AS rnd, o.q, o.earliest, o.dest_id, s.trip_id AS t, o."to" AS d, CAST(o.arrival AS BIGINT) AS b, CAST(o.nd AS BIGINT) AS nd, o.nf,
                   list_prepend({{'t': s.trip_id, 'v': s.vehicle, 's': s.stop_id, 'd': o."to", 'a': s.departure, 'b': o.arrival, 'p': o.p}}, o.path) AS path, o.stop_sequence AS osq
            FROM off{k} o JOIN st s ON s.trip_id = o.trip_id AND s.stop_sequence < o.stop_sequence AND s.departure >= o.earliest AND s.stop_id <> o.dest_id
            QUALIFY row_number() OVER (PARTITION BY o.req_id, s.trip_id, s.stop_sequence ORDER BY o.p DESC, o.walk, o.rides, o.stop_sequence, o.nd DESC, o.nf DESC) = 1),
        r{k} AS MATERIALIZED ({best(f"SELECT * FROM on{k}", "* EXCLUDE (osq)")}),
        l{k} AS MATERIALIZED ({best(f"SELECT * FROM {before} UNION ALL BY NAME SELECT * FROM r{k} UNION ALL BY NAME {walk % f'r{k}'}")})""")
    return "WITH " + ",".join(parts)


_LABELS_SQL = _route_sql()
#: The latest route per request.
_FIRST_SQL = f"SELECT * FROM l{ROUNDS} JOIN ask USING (req_id, stop_id) QUALIFY row_number() OVER (PARTITION BY req_id ORDER BY dep DESC) = 1"
_ASK_SQL = "SELECT CAST(s_nationkey AS BIGINT) AS req_id, CAST(max(s_suppkey) AS VARCHAR) AS stop_id FROM supplier GROUP BY s_nationkey"


@query("mob_10", f"""{_LABELS_SQL}
    SELECT req_id, stop_id, dep, CAST(walk AS INTEGER) AS walk, CAST(rides AS INTEGER) AS rides FROM l{ROUNDS}
""")
def mob_10(spark, sf):
    return search(spark, sf).labels.select("req_id", "stop_id", "dep", "walk", "rides")


@query("mob_11", f"{_LABELS_SQL} SELECT req_id, count(*) AS n, round(min(p), 8) AS worst, round(avg(p), 8) AS mean_p FROM l{ROUNDS} GROUP BY req_id")
def mob_11(spark, sf):
    return search(spark, sf).labels.groupBy("req_id").agg(row_count(), F.round(F.min("p"), 8).alias("worst"), F.round(F.avg("p"), 8).alias("mean_p"))


@query("mob_12", f"""{_LABELS_SQL}, ask AS ({_ASK_SQL})
    SELECT req_id, l.stop_id, l.dep, round(l.p, 8) AS p, CAST(len(l.path) AS INTEGER) AS legs, array_to_string([x.t || ':' || x.s || '>' || x.d FOR x IN l.path], ' ') AS way
    FROM ({_FIRST_SQL}) l
""")
def mob_12(spark, sf):
    found = best_routes(spark, sf)
    way = F.transform("path", lambda x: F.concat(x["trip_id"], F.lit(":"), x["src_stop_id"], F.lit(">"), x["dst_stop_id"]))
    return found.select("req_id", "stop_id", "dep", F.round("p", 8).alias("p"), F.size("path").alias("legs"), F.array_join(way, " ").alias("way"))


@query("mob_10_list", f"""{_LABELS_SQL}, ask AS ({_ASK_SQL})
    SELECT req_id, CAST(row_number() OVER (PARTITION BY req_id ORDER BY dep DESC) AS INTEGER) AS route_no, dep, round(p, 8) AS p, CAST(walk AS INTEGER) AS walk, CAST(rides AS INTEGER) AS rides
    FROM l{ROUNDS} l JOIN ask USING (req_id, stop_id)
""")
def mob_10_list(spark, sf):
    """All routes worth offering per request, from the latest on."""
    found = routing.recover(search(spark, sf), requests(spark, sf))
    return found.select("req_id", "route_no", "dep", F.round("p", 8).alias("p"), "walk", "rides")


@query("mob_13", f"""{_LABELS_SQL}, ask AS ({_ASK_SQL}),
    legs AS (SELECT req_id, round(l.p * 100, 2) AS confidence, unnest(l.path) AS x, generate_subscripts(l.path, 1) - 1 AS leg_no FROM ({_FIRST_SQL}) l)
    SELECT req_id, CAST(leg_no AS INTEGER) AS leg_no, x.t AS trip_id, x.v AS vehicle, x.a AS departure, x.b AS arrival, f.s_name AS "from", g.s_name AS "to", confidence
    FROM legs JOIN supplier f ON CAST(f.s_suppkey AS VARCHAR) = x.s JOIN supplier g ON CAST(g.s_suppkey AS VARCHAR) = x.d
""")
def mob_13(spark, sf):
    table = routing.route_table(best_routes(spark, sf), stops(spark, sf))
    return table.select(
        "req_id", "leg_no", "trip_id", "vehicle", "departure", "arrival",
        F.col("src_stop_id_name").alias("from"), F.col("dst_stop_id_name").alias("to"), "confidence",
    )
