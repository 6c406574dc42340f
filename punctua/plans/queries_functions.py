"""Queries over the scalar functions and the user-defined functions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from punctua.functions import delays, geo, text, times
from punctua.functions.registry import register_aggregate, register_scalar
from punctua.operators.aggregates import distinct_values
from punctua.operators.trends import explode_hashtags
from punctua.plans.derived import STOPS_SQL, T, bin_sql, distance_sql, line_delays, LINE_DELAYS_SQL, stops, words
from punctua.plans.registry import query, row_count


@query("str_1", "SELECT lower(c_mktsegment) || '_' || CAST(c_nationkey AS VARCHAR) AS tag, count(*) AS n FROM customer GROUP BY 1")
def str_1(spark, sf):
    tag = F.concat(F.lower("c_mktsegment"), F.lit("_"), F.col("c_nationkey").cast("string"))
    return T(spark, sf, "customer").groupBy(tag.alias("tag")).agg(row_count())


@query("str_2", """
    SELECT page_id, CAST(length(html) AS INTEGER) AS size, starts_with(url, 'https') AS secure, contains(html, 'div') AS has_div FROM pages
""")
def str_2(spark, sf):
    return T(spark, sf, "pages").select(
        "page_id", F.length("html").alias("size"), text.starts_with("url", "https").alias("secure"), text.contains_text("html", "div").alias("has_div")
    )


@query("str_3", "SELECT substr(s_name, 1, 7) AS head, substr(s_name, 10, 4) AS middle, count(*) AS n FROM supplier GROUP BY ALL")
def str_3(spark, sf):
    return T(spark, sf, "supplier").groupBy(text.short_stop_id("s_name").alias("head"), F.substring("s_name", 10, 4).alias("middle")).agg(row_count())


@query("str_4", "SELECT trim(p_name, 'smaldre') AS stripped, count(*) AS n FROM part GROUP BY 1")
def str_4(spark, sf):
    return T(spark, sf, "part").groupBy(text.strip_letters("p_name", "smaldre").alias("stripped")).agg(row_count())


@query("str_5", r"SELECT c_custkey, regexp_replace(c_name, '\D', '', 'g') AS digits FROM customer")
def str_5(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", text.digits_only("c_name").alias("digits"))


@query("str_6", "SELECT c_custkey, printf('%.2f', c_acctbal) AS balance, round(c_acctbal, 1) AS rounded FROM customer")
def str_6(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", text.two_decimals("c_acctbal").alias("balance"), F.round("c_acctbal", 1).alias("rounded"))


@query("dat_1", """
    SELECT o_orderstatus, count(*) AS n, CAST(min(epoch(o_orderdate)) AS BIGINT) AS first_s, CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS last_day
    FROM orders WHERE day(o_orderdate) > 12 GROUP BY o_orderstatus
""")
def dat_1(spark, sf):
    """Month and day are swapped in the text: days above 12 only parse the right way."""
    shown = T(spark, sf, "orders").withColumn("shown", F.date_format("o_orderdate", "dd.MM.yyyy HH:mm"))
    wrong = shown.filter(times.safe_ts("shown", "MM.dd.yyyy HH:mm").isNull())
    return wrong.groupBy("o_orderstatus").agg(
        row_count(), F.min(times.epoch(times.safe_ts("shown", times.MINUTE_PATTERN))).alias("first_s"),
        F.max(times.safe_date(F.substring("shown", 1, 10))).cast("string").alias("last_day"),
    )


@query("dat_2", """
    SELECT event_type, max(date_trunc('second', ts) + INTERVAL 1 HOUR) AS last_local FROM events GROUP BY event_type
""")
def dat_2(spark, sf):
    local = times.local_time(F.unix_timestamp("ts"), "Europe/Zurich").cast("timestamp_ntz")  # January: one hour ahead
    return T(spark, sf, "events").groupBy("event_type").agg(F.max(local).alias("last_local"))


@query("dat_3", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(week(o_orderdate) AS INTEGER) AS week, CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, count(*) AS n,
           CAST(min(dayofyear(o_orderdate)) AS INTEGER) AS first_day, CAST(max(month(o_orderdate)) AS INTEGER) AS month,
           CAST(max(day(o_orderdate)) AS INTEGER) AS day, max(dayname(o_orderdate)) AS day_name
    FROM orders GROUP BY 1, 2, 3
""")
def dat_3(spark, sf):
    d = "o_orderdate"
    return T(spark, sf, "orders").groupBy(F.year(d).alias("year"), F.weekofyear(d).alias("week"), times.iso_year(d).cast("int").alias("iso_year")).agg(
        row_count(), F.min(F.dayofyear(d)).alias("first_day"), F.max(F.month(d)).alias("month"), F.max(F.day(d)).alias("day"), F.max(times.day_name(d)).alias("day_name")
    )


@query("dat_4", """
    SELECT CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, CAST(dayofweek(ts) + 1 AS INTEGER) AS sunday_first, CAST(hour(ts) AS INTEGER) AS hour,
           CAST(max(minute(ts)) AS INTEGER) AS minute, count(*) AS n FROM events GROUP BY 1, 2, 3
""")
def dat_4(spark, sf):
    fields = times.calendar_features("ts")
    return T(spark, sf, "events").groupBy(fields["day_of_week"].alias("day_of_week"), F.dayofweek("ts").alias("sunday_first"), fields["hour"].alias("hour")).agg(
        F.max(fields["minute"]).alias("minute"), row_count()
    )


@query("dat_5", """
    SELECT l_returnflag, CAST(sum(epoch(l_shipdate) - epoch(o_orderdate)) AS BIGINT) AS seconds, round(avg((epoch(l_shipdate) - epoch(o_orderdate)) / 60.0), 4) AS minutes,
           max(l_shipdate + to_minutes(CAST(l_linenumber AS INTEGER))) AS shifted
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_returnflag
""")
def dat_5(spark, sf):
    rows = T(spark, sf, "lineitem").join(T(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.groupBy("l_returnflag").agg(
        F.sum(times.epoch("l_shipdate") - times.epoch("o_orderdate")).alias("seconds"),
        F.round(F.avg(times.minutes_between("o_orderdate", "l_shipdate")), 4).alias("minutes"),
        F.max(F.timestamp_add("MINUTE", F.col("l_linenumber"), F.col("l_shipdate"))).alias("shifted"),
    )


@query("dat_6", """
    SELECT slot, count(event_id) AS n FROM (SELECT unnest(range(300, 1381)) AS slot) LEFT JOIN events ON CAST(hour(ts) * 60 + minute(ts) AS BIGINT) = slot GROUP BY slot
""")
def dat_6(spark, sf):
    slots = spark.range(1).select(F.explode(times.minute_slots().cast("array<bigint>")).alias("slot"))
    counts = T(spark, sf, "events").groupBy((F.hour("ts") * 60 + F.minute("ts")).cast("bigint").alias("slot")).agg(row_count())
    return slots.join(counts, "slot", "left").na.fill(0, ["n"])


@query("mth_1", f"""
    SELECT stop_id, round({distance_sql('stop_lat', 'stop_lon', '47.378177', '8.540192')}, 6) AS km, round(sin(radians(stop_lat)), 8) AS s, round(atan2(stop_lat, stop_lon), 8) AS a,
           round(2 * 6371.0 * asin(least(1.0, sqrt(cos(radians(52.2909264998)) * cos(radians(52.3773759354)) * pow(sin(radians((8.540192 - stop_lon) / 2)), 2) + pow(sin(radians((47.378177 - stop_lat) / 2)), 2)))), 6) AS fixed_km
    FROM ({STOPS_SQL})
""")
def mth_1(spark, sf):
    lat, lon = F.col("stop_lat"), F.col("stop_lon")
    centre = F.lit(geo.CENTRE_LAT), F.lit(geo.CENTRE_LON)
    return stops(spark, sf).select(
        "stop_id", F.round(geo.haversine_km(lat, lon, *centre), 6).alias("km"), F.round(F.sin(F.radians(lat)), 8).alias("s"),
        F.round(F.atan2(lat, lon), 8).alias("a"), F.round(geo.haversine_km(lat, lon, *centre, fixed_cos=True), 6).alias("fixed_km"),
    )


@query("mth_2", """
    SELECT c_nationkey, count(*) AS n, round(sum(greatest(0, c_acctbal)), 2) AS positive, round(sum(least(c_acctbal, 1)), 2) AS capped,
           CAST(sum(trunc(c_acctbal)) AS BIGINT) AS whole FROM customer GROUP BY c_nationkey
""")
def mth_2(spark, sf):
    balance = F.col("c_acctbal")
    return T(spark, sf, "customer").groupBy("c_nationkey").agg(
        row_count(), F.round(F.sum(delays.clamp_at_zero(balance)), 2).alias("positive"), F.round(F.sum(F.least(balance, F.lit(1.0))), 2).alias("capped"),
        F.sum(balance.cast("bigint")).alias("whole"),
    )


@query("mth_3", f"""
    SELECT delay_minutes, round(least(pow(0.99, 10 - delay_minutes), 1), 8) AS chance, count(*) AS n FROM ({LINE_DELAYS_SQL}) GROUP BY 1, 2
""")
def mth_3(spark, sf):
    rows = line_delays(spark, sf).groupBy("delay_minutes").agg(row_count())
    return rows.withColumn("chance", F.round(delays.fallback_chance(F.col("delay_minutes")), 8))


@query("arr_1", """
    SELECT doc_id, CAST(len(w) AS INTEGER) AS words, w[1] AS first_word, w[-1] AS last_word, CAST(len(list_distinct(w)) AS INTEGER) AS different
    FROM (SELECT doc_id, string_split(lower(text), ' ') AS w FROM documents)
""")
def arr_1(spark, sf):
    """A field of the structs in an array, taken as an array."""
    tags = F.transform(F.split(F.lower("text"), " "), lambda w: F.struct(w.alias("text"), F.length(w).alias("size")))
    texts = T(spark, sf, "documents").select("doc_id", tags.alias("tags")).select("doc_id", F.col("tags.text").alias("w"))
    return texts.select(
        "doc_id", F.size("w").alias("words"), F.element_at("w", 1).alias("first_word"), F.element_at("w", -1).alias("last_word"),
        F.size(F.array_distinct("w")).alias("different"),
    )


@query("arr_2", """
    SELECT lang, token AS hashtag, count(*) AS n FROM (SELECT lang, unnest(string_split(lower(text), ' ')) AS token FROM documents) GROUP BY ALL
""")
def arr_2(spark, sf):
    docs = T(spark, sf, "documents")
    tags = F.transform(F.split(F.lower("text"), " "), lambda w: F.struct(w.alias("text")))
    tweets = docs.select(F.col("doc_id").cast("string").alias("timestamp_ms"), "lang", F.struct(tags.alias("hashtags")).alias("entities"))
    return explode_hashtags(tweets).groupBy("lang", "hashtag").agg(row_count())


@query("jsn_1", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS total FROM events GROUP BY event_type")
def jsn_1(spark, sf):
    parsed = T(spark, sf, "events").withColumn("p", F.from_json("props", "k INT"))
    return parsed.groupBy("event_type").agg(row_count(), F.sum("p.k").alias("total"))


@query("udf_1", "SELECT lower(c_mktsegment) AS segment, count(*) AS n FROM customer GROUP BY 1")
def udf_1(spark, sf):
    lowercase = register_scalar(spark, "lowercase", lambda values: values.str.lower(), "string")
    return T(spark, sf, "customer").groupBy(lowercase("c_mktsegment").alias("segment")).agg(row_count())


@query("udf_2", """
    SELECT CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 ELSE 0 END AS code, count(*) AS n FROM events GROUP BY 1
""")
def udf_2(spark, sf):
    as_vehicle = F.when(F.col("event_type") == "click", "Zug").when(F.col("event_type") == "view", "BUS").when(F.col("event_type") == "signup", "tram").otherwise("ship")
    return T(spark, sf, "events").groupBy(delays.transport_code(as_vehicle).alias("code")).agg(row_count())


_BINS = f"SELECT CAST({bin_sql('delay_minutes')} AS INTEGER) AS delay_bin, count(*) AS n FROM ({LINE_DELAYS_SQL}) GROUP BY 1"


@query("udf_3", _BINS)
def udf_3(spark, sf):
    edges = np.array(delays.BIN_EDGES, float)
    bin_of = register_scalar(spark, "label_bin", lambda x: pd.Series(np.searchsorted(edges, x.to_numpy(float), side="left")), "int")
    return line_delays(spark, sf).groupBy(bin_of("delay_minutes").alias("delay_bin")).agg(row_count())


@query("bin_1", _BINS)
def bin_1(spark, sf):
    return line_delays(spark, sf).groupBy(delays.delay_bin(F.col("delay_minutes")).alias("delay_bin")).agg(row_count())


@query("udaf_1", """
    SELECT event_type, string_agg(DISTINCT CAST(user_id % 10 AS VARCHAR), ',' ORDER BY CAST(user_id % 10 AS VARCHAR)) AS members,
           (SELECT round(median(m), 6) FROM (SELECT avg(value) AS m FROM events e WHERE e.event_type = o.event_type GROUP BY CAST(ts AS DATE))) AS typical
    FROM events o GROUP BY event_type
""")
def udaf_1(spark, sf):
    """The groups are reduced to daily means before a Python aggregate sees them."""
    events = T(spark, sf, "events")
    middle = register_aggregate(spark, "middle", lambda values: float(values.median()), "double")
    daily = events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.avg("value").alias("m"))
    typical = daily.groupBy("event_type").agg(middle("m").alias("typical"))
    members = distinct_values(events.withColumn("last", (F.col("user_id") % 10).cast("string")), ["event_type"], "last", "members")
    return members.join(typical, "event_type").select("event_type", F.concat_ws(",", "members").alias("members"), F.round("typical", 6).alias("typical"))


@query("udtf_1", "SELECT token, count(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS token FROM documents) GROUP BY token")
def udtf_1(spark, sf):
    return words(spark, sf).groupBy("token").agg(row_count())
