"""Queries over sources, sinks and the catalog: tables make a round trip
through the format and are aggregated after it."""

from __future__ import annotations

from uuid import uuid4

from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from punctua.functions.draws import MODULUS, draw_sql
from punctua.operators.aggregates import top_n_with_shares
from punctua.operators.relational import null_census
from punctua.operators.trends import daily_counts
from punctua.plans.derived import LINE_EDGES_SQL, STOPS_SQL, T, clock_text, line_edges, stop_events, stops, words
from punctua.plans.registry import query
from punctua.session import cut_lineage, scratch_path
from punctua.sources import catalog, readers, schemas, writers

_EVENT_TOTALS = """
    SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, min(ts) AS first_ts, max(ts) AS last_ts
    FROM events GROUP BY event_type
"""


def _event_totals(events):
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")
    )


@query("src_1", """
    SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, min(ts) AS first_ts, max(ts) AS last_ts,
           count(DISTINCT props) AS props, min(props) AS first_props, max(props) AS last_props
    FROM events GROUP BY event_type
""")
def src_1(spark, sf):
    """All columns, the JSON one with its quotes and separators included."""
    path = writers.write_csv(T(spark, sf, "events"), scratch_path(spark, "tsv"), sep="\t")
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
    back = readers.read_delimited(spark, path, schema)
    props = back.groupBy("event_type").agg(
        F.count_distinct("props").alias("props"), F.min("props").alias("first_props"), F.max("props").alias("last_props")
    )
    return _event_totals(back).join(props, "event_type")


@query("src_2", """
    SELECT CAST(l_suppkey AS VARCHAR) AS stop_id, count(*) AS n,
           min(printf('%02d:%02d:00', 2 + CAST(l_linenumber AS INTEGER) * 3, CAST(l_quantity AS INTEGER))) AS first_arrival
    FROM lineitem GROUP BY l_suppkey
""")
def src_2(spark, sf):
    line = T(spark, sf, "lineitem")
    clock = clock_text()
    table = line.select(
        F.col("l_orderkey").cast("string").alias("trip_id"), clock.alias("arrival_time"), clock.alias("departure_time"),
        F.col("l_suppkey").cast("string").alias("stop_id"), F.col("l_linenumber").cast("string").alias("stop_sequence"),
        F.lit("0").alias("pickup_type"), F.lit("0").alias("drop_off_type"),
    )
    folder = scratch_path(spark, "timetable")
    table.write.option("header", True).option("quoteAll", True).csv(f"{folder}/stop_times")
    back = readers.read_gtfs(spark, folder, "stop_times")
    return back.groupBy("stop_id").agg(F.count(F.lit(1)).alias("n"), F.min("arrival_time").alias("first_arrival"))


_MONTHS = """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n
    FROM lineitem GROUP BY ALL
"""


def _full_events(spark, sf):
    """All columns of the declared schema; those the tables lack are empty."""
    german = {new: old for old, new in schemas.STOP_EVENT_NAMES.items()}
    rows = stop_events(spark, sf)
    known = {german.get(c, c): F.col(c) for c in rows.columns}
    names = [part.split()[0] for part in schemas.STOP_EVENTS.split(",")]
    return rows.select(*[known.get(n, F.lit("")).alias(n) for n in names])


@query("src_3", _MONTHS)
def src_3(spark, sf):
    path = writers.write_partitioned(_full_events(spark, sf), scratch_path(spark, "stop_events"))
    return readers.read_stop_events(spark, path).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"))


@query("src_4", f"""
    SELECT stop_id, stop_name, round(CAST(CAST(stop_lat AS FLOAT) AS DOUBLE), 4) AS lat, round(CAST(CAST(stop_lon AS FLOAT) AS DOUBLE), 4) AS lon
    FROM ({STOPS_SQL})
""")
def src_4(spark, sf):
    rows = stops(spark, sf).withColumns(
        {"stop_lat": F.col("stop_lat").cast("float"), "stop_lon": F.col("stop_lon").cast("float"), "location_type": F.lit(""), "parent_station": F.lit("")}
    )
    back = readers.read_stops(spark, writers.write_orc(rows, scratch_path(spark, "stops")))
    as_double = lambda c: F.round(F.col(c).cast("double"), 4)
    return back.select("stop_id", "stop_name", as_double("stop_lat").alias("lat"), as_double("stop_lon").alias("lon"))


@query("src_5", _EVENT_TOTALS)
def src_5(spark, sf):
    path = writers.write_orc(T(spark, sf, "events"), scratch_path(spark, "events"))
    return _event_totals(readers.read_orc(spark, path))


@query("src_6", """
    SELECT CASE WHEN event_type = 'error' THEN NULL ELSE 'en' END AS lang, count(*) AS n,
           coalesce(CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 2 END) AS BIGINT), 0) AS hashtags
    FROM events GROUP BY 1
""")
def src_6(spark, sf):
    events = T(spark, sf, "events")
    tag = lambda c: F.struct(c.alias("text"), F.array(F.lit(0), F.lit(5)).alias("indices"))
    tweet = F.struct(
        (F.unix_timestamp("ts") * 1000).cast("string").alias("timestamp_ms"),
        F.lit("en").alias("lang"),
        F.struct(F.array(tag(F.col("event_type")), tag(F.col("user_id").cast("string"))).alias("hashtags")).alias("entities"),
    )
    text = F.to_json(tweet)
    # Lines of one type are cut in the middle: the reader must survive them.
    lines = events.select(F.when(F.col("event_type") == "error", F.substring(text, 1, 30)).otherwise(text).alias("value"))
    path = scratch_path(spark, "tweets")
    lines.write.text(path, compression="bzip2")
    back = readers.read_hashtag_json(spark, path)
    return back.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.greatest(F.size("entities.hashtags"), F.lit(0))), F.lit(0)).alias("hashtags")
    )


@query("src_7", f"""
    SELECT vehicle, count(*) AS n, CAST(sum(duration) AS BIGINT) AS minutes, min(TIMESTAMP '1995-01-01' + to_days(src_departure)) AS first_departure,
           max(TIMESTAMP '1995-01-01' + to_days(dst_arrival)) AS last_arrival
    FROM ({LINE_EDGES_SQL}) GROUP BY vehicle
""")
def src_7(spark, sf):
    at = lambda c: F.date_format(F.date_add(F.lit("1995-01-01").cast("date"), F.col(c)), "yyyy-MM-dd HH:mm:ss")
    edges = line_edges(spark, sf)
    flags = [F.lit(1).alias(d) for d in schemas.BUSINESS_DAYS]
    rows = edges.select(
        "src_stop_id", "trip_id", at("src_departure").alias("src_departure_time"), "vehicle", *flags,
        "dst_stop_id", at("dst_arrival").alias("dst_arrival_time"), "duration",
    )
    back = readers.read_edges(spark, writers.write_csv(rows, scratch_path(spark, "edges")))
    return back.groupBy("vehicle").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration").alias("minutes"),
        F.min("src_departure_time").alias("first_departure"), F.max("dst_arrival_time").alias("last_arrival"),
    )


@query("src_8", """
    WITH names(event_type, label) AS (VALUES ('click', 'opened'), ('purchase', 'bought'), ('view', 'seen'))
    SELECT label, CAST(d.day AS BIGINT) AS day, count(event_id) AS n
    FROM names CROSS JOIN range(0, 31) d(day)
    LEFT JOIN events e ON e.event_type = names.event_type AND dayofyear(e.ts) = d.day + 1
    GROUP BY ALL HAVING count(event_id) > 0
""")
def src_8(spark, sf):
    names = readers.from_rows(spark, [("click", "opened"), ("purchase", "bought"), ("view", "seen")], "event_type STRING, label STRING")
    days = readers.from_range(spark, 31, "day")
    events = T(spark, sf, "events").withColumn("day", (F.dayofyear("ts") - 1).cast("bigint"))
    counts = events.groupBy("event_type", "day").agg(F.count("event_id").alias("n"))
    return counts.join(names, "event_type").join(days, "day").select("label", "day", "n")


_DRAWN = f"({draw_sql(7, 'event_id')})::DOUBLE / {MODULUS}.0::DOUBLE"


@query("src_9", f"SELECT * FROM events WHERE {_DRAWN} < 0.01")
def src_9(spark, sf):
    return catalog.sample_fraction(T(spark, sf, "events"), 0.01, seed=7, key=["event_id"])


@query("src_10", f"SELECT * FROM events ORDER BY {draw_sql(7, 'event_id')}, event_id LIMIT 1000")
def src_10(spark, sf):
    return catalog.sample_n(T(spark, sf, "events"), 1000, seed=7, key=["event_id"])


@query("snk_1", """
    WITH tokens AS (SELECT lang, unnest(string_split(lower(text), ' ')) AS token FROM documents),
    parts AS (SELECT token, lang, count(*) AS lang_count FROM tokens GROUP BY ALL),
    tot AS (SELECT token, CAST(sum(lang_count) AS BIGINT) AS total_count FROM parts GROUP BY token ORDER BY total_count DESC, token LIMIT 20)
    SELECT token, lang, lang_count, total_count FROM parts JOIN tot USING (token)
""")
def snk_1(spark, sf):
    path = scratch_path(spark, "top_tokens")
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    return writers.materialise(top_n_with_shares(words(spark, sf), "token", "lang", 20), name, path=path)


@query("snk_2", _EVENT_TOTALS.replace("FROM events", f"FROM events WHERE {_DRAWN} < 0.3"))
def snk_2(spark, sf):
    path = scratch_path(spark, "orc")
    for _ in range(2):  # the second write replaces the first
        writers.write_orc(catalog.sample_fraction(T(spark, sf, "events"), 0.3, seed=7, key=["event_id"]), path)
    return _event_totals(spark.read.orc(path))


@query("snk_3", """
    SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority
""")
def snk_3(spark, sf):
    path = writers.write_csv(T(spark, sf, "orders"), scratch_path(spark, "csv"))
    schema = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate STRING, o_orderpriority STRING"
    back = readers.read_delimited(spark, path, schema, sep=",")
    return back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("snk_4", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY ALL
""")
def snk_4(spark, sf):
    rows = T(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    back = spark.read.orc(writers.write_partitioned(rows, scratch_path(spark, "by_month")))
    return back.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("snk_5", """
    SELECT event_type, CAST(dayofyear(ts) AS INTEGER) AS day, round(count(*) / (SELECT count(*) FROM events), 8) AS share
    FROM events GROUP BY ALL
""")
def snk_5(spark, sf):
    with writers.kept(daily_counts(T(spark, sf, "events"), "ts", "event_type")) as counts:
        total = counts.agg(F.sum("count")).scalar()
        # Stored while the counts are still kept.
        return cut_lineage(counts.select("event_type", "day", F.round(F.col("count") / total, 8).alias("share")))


@query("snk_6", """
    WITH ranked AS (SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS type_index
                    FROM events GROUP BY event_type)
    SELECT event_type, type_index, count(*) AS n FROM events JOIN ranked USING (event_type) GROUP BY ALL
""")
def snk_6(spark, sf):
    events = T(spark, sf, "events")
    indexer = StringIndexer(inputCol="event_type", outputCol="type_index", stringOrderType="frequencyDesc")
    path = writers.save_model(Pipeline(stages=[indexer]).fit(events), scratch_path(spark, "model"))
    scored = writers.load_model(path).transform(events)
    return scored.groupBy("event_type", "type_index").agg(F.count(F.lit(1)).alias("n"))


@query("cat_1", """
    SELECT 'event_id' AS column_name, 'bigint' AS type, count(*) - count(event_id) AS nulls, count(event_id) AS known FROM events
    UNION ALL SELECT 'ts', 'timestamp_ntz', count(*) - count(ts), count(ts) FROM events
    UNION ALL SELECT 'user_id', 'bigint', count(*) - count(user_id), count(user_id) FROM events
    UNION ALL SELECT 'event_type', 'string', count(*) - count(event_type), count(event_type) FROM events
    UNION ALL SELECT 'value', 'double', count(*) - count(value), count(value) FROM events
    UNION ALL SELECT 'props', 'string', count(*) - count(props), count(props) FROM events
""")
def cat_1(spark, sf):
    events = T(spark, sf, "events")
    return catalog.describe(events).select("column_name", "type").join(null_census(events), "column_name")


@query("cat_1_tables", """
    SELECT event_type, CAST(day(ts) AS INTEGER) % 4 AS slot, count(*) AS n, round(sum(value), 4) AS total, 6 AS columns, TRUE AS listed, TRUE AS shown
    FROM events GROUP BY ALL
""")
def cat_1_tables(spark, sf):
    """A table over folders that were written without the catalog: created, recovered, listed, previewed and read."""
    events = T(spark, sf, "events").withColumn("slot", F.day("ts") % 4).drop("props")
    path, database = scratch_path(spark, "folders"), f"db_{uuid4().hex}"
    writers.write_partitioned(events, path, ("event_type", "slot"))
    catalog.create_database(spark, database, scratch_path(spark, "database"))
    name = f"{database}.events"
    try:
        table = catalog.external_table(spark, name, events.schema, path, ["event_type", "slot"], "orc")
        known = catalog.partitions(spark, name).select(
            F.col("values.event_type").alias("event_type"), F.col("values.slot").cast("int").alias("slot"),
            F.lit(catalog.describe(table).count()).cast("int").alias("columns"), F.lit("events" in catalog.tables(spark, database)).alias("listed"),
            F.lit(catalog.preview(table, 3).count() == 3).alias("shown"),
        )
        totals = table.groupBy("event_type", "slot").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
        return cut_lineage(known.join(totals, ["event_type", "slot"], "full"))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
