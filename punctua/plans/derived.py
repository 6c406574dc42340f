"""The library's domain tables, derived from the standard tables.

Each DataFrame here has an SQL text beside it that derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from punctua.functions.times import MINUTE_PATTERN, SECOND_PATTERN, DAY_PATTERN
from punctua.operators.mobility import trip_edges
from punctua.operators.ordering import chunk_if_long, running
from punctua.sources.readers import read_table

T = read_table

#: A total order of the lines of an order.
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


def stop_events(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments as stop events: text times, as in the actual-data feed."""
    line = T(spark, folder, "lineitem")
    due = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(mins=(360 + F.col("l_linenumber") * 60 + F.col("l_quantity")).cast("int"))
    late = lambda factor: F.make_dt_interval(secs=F.pmod(F.floor(F.col("l_extendedprice") * factor), F.lit(3000)) - 600)
    leave = F.col("due") + F.make_dt_interval(mins=F.lit(2))
    rows = line.withColumn("due", due)
    return rows.select(
        F.date_format("l_shipdate", DAY_PATTERN).alias("trip_day"),
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.when(F.col("l_linestatus") == "F", "Zug").when(F.col("l_discount") > 0.05, "Bus").otherwise("tram").alias("vehicle"),
        F.col("l_linenumber").cast("string").alias("line_id"),
        F.when(F.col("l_tax") < 0.04, "IC").otherwise("IR").alias("service_type"),
        F.lit("false").alias("additional_trip"),
        F.when(F.col("l_discount") == 0, "true").otherwise("false").alias("passes_through"),
        F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0")).alias("stop_name"),
        F.date_format("due", MINUTE_PATTERN).alias("sched_arr"),
        F.date_format(F.col("due") + late(1), SECOND_PATTERN).alias("act_arr"),
        _status().alias("arr_status"),
        F.date_format(leave, MINUTE_PATTERN).alias("sched_dep"),
        F.date_format(leave + late(7), SECOND_PATTERN).alias("act_dep"),
        _status().alias("dep_status"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    )


def _status() -> Column:
    return F.when(F.col("l_returnflag") == "A", "REAL").when(F.col("l_returnflag") == "N", "GESCHAETZT").otherwise("PROGNOSE")


STOP_EVENTS_SQL = """
    SELECT *, due + to_seconds(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 3000 - 600 AS INTEGER)) AS act_arr,
           due + INTERVAL 2 MINUTE AS sched_dep,
           due + INTERVAL 2 MINUTE + to_seconds(CAST(CAST(floor(l_extendedprice * 7) AS BIGINT) % 3000 - 600 AS INTEGER)) AS act_dep,
           greatest(0, CAST(floor(l_extendedprice) AS BIGINT) % 3000 - 600) AS arr_delay,
           greatest(0, CAST(floor(l_extendedprice * 7) AS BIGINT) % 3000 - 600) AS dep_delay
    FROM (SELECT l.*, CASE WHEN l_linestatus = 'F' THEN 'Zug' WHEN l_discount > 0.05 THEN 'Bus' ELSE 'tram' END AS vehicle,
                 CASE WHEN l_tax < 0.04 THEN 'IC' ELSE 'IR' END AS service_type,
                 l_discount = 0 AS passes_through,
                 printf('Supplier#%09d', l_suppkey) AS stop_name,
                 CASE l_returnflag WHEN 'A' THEN 'REAL' WHEN 'N' THEN 'GESCHAETZT' ELSE 'PROGNOSE' END AS status,
                 l_shipdate + to_minutes(CAST(360 + l_linenumber * 60 + l_quantity AS INTEGER)) AS due
          FROM lineitem l)
"""


def stops(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as stops: groups of five on a line, the groups all over the globe."""
    s = F.col("s_suppkey")
    block = F.floor(s / 5)
    lat = F.lit(-50.0) + F.pmod(block * 7919, F.lit(10007)) / F.lit(100.07) + F.pmod(s, F.lit(5)) * F.lit(0.01)
    lon = F.lit(-170.0) + F.pmod(block * 104729, F.lit(30011)) / F.lit(88.27)
    return T(spark, folder, "supplier").select(
        s.cast("string").alias("stop_id"), F.col("s_name").alias("stop_name"), lat.alias("stop_lat"), lon.alias("stop_lon")
    )


STOPS_SQL = """
    SELECT CAST(s_suppkey AS VARCHAR) AS stop_id, s_name AS stop_name,
           -50.0::DOUBLE + (((s_suppkey // 5) * 7919) % 10007)::DOUBLE / 100.07::DOUBLE + (s_suppkey % 5)::DOUBLE * 0.01::DOUBLE AS stop_lat,
           -170.0::DOUBLE + (((s_suppkey // 5) * 104729) % 30011)::DOUBLE / 88.27::DOUBLE AS stop_lon
    FROM supplier
"""


def distance_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0 * asin(least(1.0, sqrt(cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2)"
        f" + pow(sin(radians({lat2} - {lat1}) / 2), 2))))"
    )


def ship_days() -> Column:
    return F.datediff("l_shipdate", F.lit("1995-01-01").cast("date"))


def line_stops(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as trips, their lines as stops; time in days since 1995."""
    return T(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("trip_id"),
        F.col("l_suppkey").cast("string").alias("stop_id"),
        ship_days().alias("arrival"),
        ship_days().alias("departure"),
        F.col("l_returnflag").alias("vehicle"),
        *LINE_ORDER,
    )


def line_edges(spark: SparkSession, folder: str) -> DataFrame:
    table = line_stops(spark, folder)
    return trip_edges(table, LINE_ORDER, F.floor(F.col("arrival") / 64), unit=1).drop(*LINE_ORDER)


LINE_EDGES_SQL = """
    SELECT * FROM (
        SELECT CAST(l_suppkey AS VARCHAR) AS src_stop_id,
               CAST(lead(l_suppkey) OVER trip AS VARCHAR) AS dst_stop_id,
               CAST(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS INTEGER) AS src_departure,
               CAST(date_diff('day', TIMESTAMP '1995-01-01', lead(l_shipdate) OVER trip) AS INTEGER) AS dst_arrival,
               CAST(date_diff('day', l_shipdate, lead(l_shipdate) OVER trip) AS BIGINT) AS duration,
               CAST(l_orderkey AS VARCHAR) AS trip_id, l_returnflag AS vehicle
        FROM lineitem
        WINDOW trip AS (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice))
    WHERE dst_stop_id IS NOT NULL
"""


def line_stop_times(spark: SparkSession, folder: str) -> DataFrame:
    """The trips with a position per stop, as the router wants them."""
    # Numbered as lines, which are smaller rows than stops.
    line = T(spark, folder, "lineitem").select("l_orderkey", "l_returnflag", *LINE_ORDER)
    chunk = chunk_if_long(line, ["l_orderkey"], F.floor(ship_days() / 64))
    placed = running(line, ["l_orderkey"], LINE_ORDER, {"stop_sequence": ("sum", F.lit(1))}, chunk, inclusive=True)
    return placed.select(
        F.col("l_orderkey").cast("string").alias("trip_id"), F.col("stop_sequence").cast("int").alias("stop_sequence"),
        F.col("l_suppkey").cast("string").alias("stop_id"), ship_days().alias("arrival"), ship_days().alias("departure"), F.col("l_returnflag").alias("vehicle"),
    )


LINE_STOP_TIMES_SQL = """
    SELECT CAST(l_orderkey AS VARCHAR) AS trip_id,
           CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INTEGER) AS stop_sequence,
           CAST(l_suppkey AS VARCHAR) AS stop_id,
           CAST(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS BIGINT) AS arrival,
           CAST(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) AS BIGINT) AS departure,
           l_returnflag AS vehicle
    FROM lineitem
"""


def line_delays(spark: SparkSession, folder: str) -> DataFrame:
    """Days from order to shipment, early shipments as 0."""
    line = T(spark, folder, "lineitem").select("l_orderkey", "l_shipdate", "l_returnflag", "l_linestatus", "l_suppkey")
    order = T(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    days = F.datediff("l_shipdate", "o_orderdate")
    return line.join(order, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_returnflag").alias("vehicle"), "l_linestatus", "l_suppkey", "l_shipdate",
        F.greatest(F.lit(0), days).cast("double").alias("delay_minutes"),
    )


LINE_DELAYS_SQL = """
    SELECT l_returnflag AS vehicle, l_linestatus, l_suppkey, l_shipdate,
           CAST(greatest(0, date_diff('day', o_orderdate, l_shipdate)) AS DOUBLE) AS delay_minutes
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

DAILY_SQL = """
    SELECT CAST(dayofyear(ts) AS INTEGER) AS day, event_type, CAST(week(ts) AS INTEGER) AS week, count(*) AS "count"
    FROM events GROUP BY ALL
"""


def bin_sql(x: str) -> str:
    return f"list_sum([CAST({x} > e AS INTEGER) FOR e IN [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20, 30]])"


def words(spark: SparkSession, folder: str) -> DataFrame:
    """Every word of every document with the document's language."""
    docs = T(spark, folder, "documents")
    return docs.select("doc_id", "lang", F.explode(F.split(F.lower("text"), " ")).alias("token"))


def clock_text() -> Column:
    """A time of day per order line, zero-padded text."""
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(two(F.col("l_linenumber") * 3 + 2), F.lit(":"), two(F.col("l_quantity")), F.lit(":00"))
