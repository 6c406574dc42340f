"""Small tables with known results."""

import datetime as dt

from pyspark.sql import functions as F

from punctua.functions import delays, text, times
from punctua.operators import aggregates, mobility, relational, trends
from punctua.sources import readers, writers


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_rolling_sum(spark):
    counts = [171, 107, 183, 207, 163, 226, 149, 202, 330, 315]
    df = spark.createDataFrame([(122 + i, "brexit", c) for i, c in enumerate(counts)], "day INT, hashtag STRING, count BIGINT")
    got = trends.rolling_sum(df, "hashtag", "day", "count").orderBy("day")
    assert [r.rolling_sum for r in got.collect()] == [171, 278, 461, 668, 831, 1057, 1206, 1237, 1460, 1592]


def test_rolling_sum_by_calendar(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 7), (9, "a", 1)], "day INT, hashtag STRING, count BIGINT")
    by_row = trends.rolling_sum(df, "hashtag", "day", "count").orderBy("day")
    by_day = trends.rolling_sum(df, "hashtag", "day", "count", calendar=True).orderBy("day")
    assert [r.rolling_sum for r in by_row.collect()] == [5, 12, 13]
    assert [r.rolling_sum for r in by_day.collect()] == [5, 12, 1]


def test_local_time_and_calendar(spark):
    df = spark.createDataFrame([(1462084200, "en", "Science"), (1462084200, "fr", "x")], "timestamp_s BIGINT, lang STRING, hashtag STRING")
    got = trends.tweets_in(df, "en", "Europe/Zurich").withColumn("date", F.col("date").cast("string"))
    assert rows(got, "hashtag", "date") == [("science", "2016-05-01 08:30:00")]
    view = trends.calendar_view(trends.tweets_in(df, "en", "Europe/Zurich"), 2016)
    assert rows(view, "month", "week", "day", "hashtag") == [(5, 17, 122, "science")]


def test_explode_and_malformed_json(spark, tmp_path):
    lines = [
        '{"timestamp_ms": "1", "lang": "en", "entities": {"hashtags": []}}',
        '{"timestamp_ms": "2", "lang": "fr", "entities": {"hashtags": [{"text": "hashtag1", "indices": [10]}]}}',
        '{"timestamp_ms": "2", "lang": "jp", "entities": {"hashtags": [{"text": "hashtag1", "indices": [14, 23]}, {"text": "hashtag2", "indices": [45]}]}}',
        '{"timestamp_ms": "3", "lang": ',
    ]
    path = str(tmp_path / "tweets")
    spark.createDataFrame([(x,) for x in lines], "value STRING").write.text(path)
    tweets = readers.read_hashtag_json(spark, path)
    assert tweets.count() == 4 and tweets.filter("lang IS NULL").count() == 1
    assert sorted(rows(trends.explode_hashtags(tweets), "timestamp_ms", "lang", "hashtag")) == [
        ("2", "fr", "hashtag1"), ("2", "jp", "hashtag1"), ("2", "jp", "hashtag2"),
    ]


def test_shares(spark):
    data = [("hashtag_1", "en")] * 20 + [("hashtag_1", "fr")] * 10 + [("hashtag_1", "jp")] * 5 + [("hashtag_2", "te")] * 5 + [("rare", "en")]
    got = aggregates.top_n_with_shares(spark.createDataFrame(data, "hashtag STRING, lang STRING"), "hashtag", "lang", 2)
    assert rows(got, "hashtag", "lang", "lang_count", "total_count") == [
        ("hashtag_1", "en", 20, 35), ("hashtag_1", "fr", 10, 35), ("hashtag_1", "jp", 5, 35), ("hashtag_2", "te", 5, 5),
    ]


def test_bins_and_fallback(spark):
    xs = [-1.0, 0.0, 0.5, 1.0, 10.0, 10.5, 30.0, 31.0, None]
    df = spark.createDataFrame([(x,) for x in xs], "x DOUBLE")
    assert [r[0] for r in df.select(delays.delay_bin(F.col("x"))).collect()] == [0, 0, 1, 1, 10, 11, 13, 14, None]
    df = spark.createDataFrame([(x,) for x in [10.0, 11.0, 9.0, 0.0, None]], "x DOUBLE")
    got = [r[0] for r in df.select(delays.fallback_chance(F.col("x"))).collect()]
    assert got[:2] == [1.0, 1.0] and abs(got[2] - 0.99) < 1e-12 and abs(got[3] - 0.99**10) < 1e-12 and got[4] is None


def test_delay_clamp(spark):
    data = [("01.02.2022 10:00", a) for a in ("01.02.2022 09:59:10", "01.02.2022 10:00:00", "01.02.2022 10:01:30", "", "bad")]
    df = spark.createDataFrame(data, "s STRING, a STRING")
    late = delays.delay_seconds(times.safe_ts("s", times.MINUTE_PATTERN), times.safe_ts("a", times.SECOND_PATTERN))
    assert [r[0] for r in df.select(late).collect()] == [0, 0, 90, None, None]


def test_transport_codes(spark):
    df = spark.createDataFrame([(v,) for v in ("Zug", "BUS", "tram", "", "ship", None)], "v STRING")
    assert [r[0] for r in df.select(delays.transport_code(F.col("v"))).collect()] == [1, 2, 3, 0, 0, 0]


def test_minute_slots(spark):
    assert spark.range(1).select(F.size(times.minute_slots())).first()[0] == 1081


def test_text_helpers(spark):
    df = spark.createDataFrame([("8590275:0:A", "Parent8503000", "23.11.2022"), (None, "x", "2022-11-23")], "a STRING, b STRING, d STRING")
    got = df.select(text.short_stop_id("a"), text.strip_letters("b", "Parent"), text.date_shaped("d"), text.non_empty("a")).collect()
    assert tuple(got[0]) == ("8590275", "8503000", True, True)
    assert tuple(got[1]) == (None, "x", False, False)
    assert df.filter(text.lacks_text("a", "Z")).count() == 1  # NULL passes neither test nor its negation


def test_clock(spark):
    df = spark.createDataFrame([(t,) for t in ("04:59:00", "05:00:00", "23:00:00", "25:10:00", "bad")], "t STRING")
    assert [r[0] for r in df.select(times.clock_seconds("t")).collect()] == [17940, 18000, 82800, 90600, None]
    assert [r[0] for r in df.select(times.in_clock_window("t", "05:00:00", "23:00:00")).collect()] == [False, True, True, False, False]


def test_stops_within(spark):
    degree = 1 / 111.19492664455873  # per km, north
    at = [(f"s{km}", km, 47.378177 + km * degree, 8.540192) for km in (0.0, 14.9, 15.1)]
    df = spark.createDataFrame(at, "stop_id STRING, km DOUBLE, stop_lat DOUBLE, stop_lon DOUBLE")
    got = mobility.stops_within(df).orderBy("km").collect()
    assert [r.stop_id for r in got] == ["s0.0", "s14.9"]
    assert all(abs(r.distance_km - r.km) < 1e-6 for r in got)
    assert mobility.stops_within(df, fixed_cos=True).count() == 2


def test_walking_edges(spark):
    degree = 1 / 111.19492664455873
    at = [("8500000:0:A", 0.0), ("8500001", 0.04), ("8500002", 0.12), ("8500003", 0.499), ("8500004", 0.501), ("Parent8500000", 0.0)]
    df = spark.createDataFrame([(i, i, 47.0 + km * degree, 8.0) for i, km in at], "stop_id STRING, stop_name STRING, stop_lat DOUBLE, stop_lon DOUBLE")
    got = {(r.src_stop_id, r.dst_stop_id): r.duration for r in mobility.walking_edges(df).collect()}
    assert got[("8500000", "8500001")] == 0 and got[("8500000", "8500002")] == 2 and got[("8500000", "8500003")] == 9
    assert ("8500000", "8500004") not in got
    assert all(got[(b, a)] == d for (a, b), d in got.items())
    assert not any("Parent" in x for pair in got for x in pair)


def test_walking_pairs_everywhere(spark):
    """Cells next to the date line and near the poles, and split cells."""
    points = [("a", 0.0, 179.999), ("b", 0.0, -179.999), ("c", 89.9999, 10.0), ("d", 89.9999, -170.0), ("e", -60.0, 5.0), ("f", -60.0, 5.001)]
    points += [(f"m{i}", 10.0 + i * 1e-5, 20.0) for i in range(30)]
    df = spark.createDataFrame(points, "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE")
    near = {(r[0], r[1]) for r in mobility.walking_pairs(df, 0.5).collect()}
    expected = {(f"m{i}", f"m{j}") for i in range(30) for j in range(30) if i != j}
    expected |= {("a", "b"), ("b", "a"), ("c", "d"), ("d", "c"), ("e", "f"), ("f", "e")}
    assert near == expected
    split = mobility.walking_pairs(df, 0.5, hot_cell=4)
    assert {(r[0], r[1]) for r in split.collect()} == expected and split.count() == len(expected)


def test_od_schedule(spark):
    day = "23.11.2022"

    def stop(train, name, arr, dep, service="IC", passes="false"):
        at = lambda t: f"{day} {t}" if t else ""
        return (day, train, service, "false", passes, name, at(arr), at(dep))

    data = [
        stop("713", "Genève", "", "07:30"), stop("713", "Lausanne", "08:10", "08:12"),
        stop("720", "Lausanne", "", "09:00"), stop("720", "Genève", "09:40", ""),
        stop("999", "Genève", "", "06:00"), stop("999", "Lausanne", "20:00", ""),
        stop("800", "Genève", "", "10:00", "IR"), stop("800", "Lausanne", "10:40", "", "IR"),
        stop("801", "Genève", "", "11:00", passes="true"), stop("801", "Lausanne", "11:40", ""),
        stop("731", "Genève", "17:40", "17:45"), stop("731", "Lausanne", "18:25", ""),
    ]
    schema = "trip_day STRING, line_id STRING, service_type STRING, additional_trip STRING, passes_through STRING, stop_name STRING, sched_arr STRING, sched_dep STRING"
    got = mobility.od_schedule(spark.createDataFrame(data, schema), day, "Genève", "Lausanne")
    assert rows(got, "train_number", "departure", "arrival") == [
        ("713", f"{day} 07:30", f"{day} 08:10"), ("731", f"{day} 17:45", f"{day} 18:25"),
    ]
    # The same train of another day is no connection, and every day has its own rows.
    other = [tuple(x.replace("23.11", "24.11") if isinstance(x, str) else x for x in r) for r in data[:1] + data[10:]]
    both = mobility.od_schedule(spark.createDataFrame(data + other, schema), None, "Genève", "Lausanne")
    assert rows(both, "trip_day", "train_number") == [(day, "713"), (day, "731"), ("24.11.2022", "731")]


def test_trains_of_one_minute_are_sorted_once(spark):
    """Every pair of rows is a row of the schedule, but equal ones are counted until they are sorted."""
    day = "23.11.2022"
    schema = "trip_day STRING, line_id STRING, service_type STRING, additional_trip STRING, passes_through STRING, stop_name STRING, sched_arr STRING, sched_dep STRING"
    data = [(day, "1", "IC", "false", "false", "A", "", f"{day} 07:30")] * 30 + [(day, "1", "IC", "false", "false", "B", f"{day} 08:{m}", "") for m in ("10", "10", "20")]
    got = mobility.od_schedule(spark.createDataFrame(data + [(day, "1", "IC", "false", "false", "A", "", "bad")], schema), None, "A", "B")
    assert {(r.arrival, r["n"]) for r in got.groupBy("arrival").agg(F.count(F.lit(1)).alias("n")).collect()} == {(f"{day} 08:10", 60), (f"{day} 08:20", 30)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # The sort lies below the repetition.
    assert plan.index("Generate explode(sequence(1") < plan.index("Sort [departure_s")


def test_graph_table_and_edges(spark):
    stops = spark.createDataFrame([("1",), ("2",), ("3",)], "stop_id STRING")
    times_ = [
        ("t1", "04:59:00", "04:59:00", "1", "1"), ("t1", "05:00:00", "05:01:00", "2", "2"), ("t1", "05:09:59", "05:10:00", "3", "10"),
        ("t2", "25:10:00", "25:10:00", "1", "1"), ("t3", "10:00:00", "10:00:00", "1", "1"), ("t3", "10:05:00", "10:05:00", "2", "2"),
        ("t4", "10:00:00", "10:00:00", "9", "1"),
    ]
    st = spark.createDataFrame(times_, "trip_id STRING, arrival_time STRING, departure_time STRING, stop_id STRING, stop_sequence STRING")
    trips = spark.createDataFrame([(t, s, "r", "0") for t, s in (("t1", "week"), ("t2", "week"), ("t3", "weekend"), ("t4", "week"))], "trip_id STRING, service_id STRING, route_id STRING, direction_id STRING")
    days = "monday STRING, tuesday STRING, wednesday STRING, thursday STRING, friday STRING, saturday STRING, sunday STRING"
    calendar = spark.createDataFrame([("week", *"1111100"), ("weekend", *"0000011")], f"service_id STRING, {days}")
    routes = spark.createDataFrame([("r", "Tram")], "route_id STRING, route_desc STRING")
    table = mobility.graph_table(stops, st, trips, calendar, routes)
    assert sorted(rows(table, "trip_id", "stop_id", "arrival", "vehicle", "monday")) == [("t1", "2", 18000, "Tram", True), ("t1", "3", 18599, "Tram", True)]
    edges = mobility.trip_edges(table)
    assert rows(edges, "src_stop_id", "dst_stop_id", "duration", "trip_id", "friday") == [("2", "3", 8, "t1", True)]


def test_edges_drop_time_travel_and_single_stops(spark):
    data = [("a", "1", 10, 20, 1), ("a", "2", 15, 30, 2), ("a", "3", 90, 95, 3), ("b", "1", 5, 6, 1)]
    df = spark.createDataFrame(data, "trip_id STRING, stop_id STRING, arrival INT, departure INT, stop_sequence INT")
    assert rows(mobility.trip_edges(df), "src_stop_id", "dst_stop_id", "duration") == [("2", "3", 1)]


def test_expand_walks(spark):
    walks = spark.createDataFrame([("1", "2", 3)], "src_stop_id STRING, dst_stop_id STRING, duration INT")
    got = mobility.expand_walks(walks)
    assert got.count() == 1081
    assert got.filter("dst_arrival - src_departure <> 180 OR vehicle <> 'foot' OR NOT monday").count() == 0


def test_stop_events_partition_pruning(spark, tmp_path):
    from punctua.sources import schemas

    names = [p.split()[0] for p in schemas.STOP_EVENTS.split(",")][:-2]
    data = [tuple([d] + [""] * (len(names) - 1) + [y, m]) for d, y, m in (("23.11.2022", 2022, 11), ("24.11.2022", 2022, 11), ("01.12.2022", 2022, 12))]
    df = spark.createDataFrame(data, schemas.STOP_EVENTS)
    path = writers.write_partitioned(df, str(tmp_path / "events"))
    one = readers.read_stop_events(spark, path, dt.date(2022, 11, 23))
    assert one.count() == 1 and "sched_arr" in one.columns
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month" in plan


def test_null_census_and_union(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "k INT, v STRING")
    assert sorted(rows(relational.null_census(a), "column_name", "nulls", "known")) == [("k", 0, 2), ("v", 1, 1)]
    b = spark.createDataFrame([(3,)], "k INT")
    assert relational.union_edges(a, b).filter("v IS NULL").count() == 2


def test_trending_across_weeks(spark):
    data = [(7, "a", 1, 100), (8, "a", 2, 101), (8, "b", 2, 50)]
    df = spark.createDataFrame(data, "day INT, hashtag STRING, week INT, count BIGINT")
    plain = {(r.week, r.hashtag): r.next_day_increase for r in trends.trending(df, "hashtag").collect()}
    across = {(r.week, r.hashtag): r.next_day_increase for r in trends.trending(df, "hashtag", across_weeks=True).collect()}
    assert plain[(2, "a")] == 101 and across[(2, "a")] == 1 and across[(2, "b")] == 50
