"""Searches that must not stop early, and grids that one odd row must not spoil."""

from pyspark.sql import functions as F

from punctua.operators import mobility, routing
from punctua.sources import catalog

STOP_TIMES = "trip_id STRING, stop_sequence INT, stop_id STRING, arrival BIGINT, departure BIGINT, vehicle STRING"
REQUESTS = "req_id BIGINT, origin_id STRING, dest_id STRING, earliest_departure BIGINT, arrive_by BIGINT, min_confidence DOUBLE"


def test_a_chain_of_eight_rides_is_found(spark):
    rows = []
    for k in range(8):
        start = 1000 * (k + 1)
        rows += [(f"t{k}", 1, f"s{k}", start, start, "IC"), (f"t{k}", 2, f"s{k + 1}", start + 500, start + 500, "IC")]
    asked = [(r, "s0", "s8", 0, 10_000, 0.0) for r in (1, 2)] + [(3, "s5", "s8", 0, 10_000, 0.0)]
    requests = spark.createDataFrame(asked, REQUESTS)
    found = routing.recover(routing.route(requests, spark.createDataFrame(rows, STOP_TIMES)), requests).collect()
    assert {(r.req_id, r.dep, r.rides) for r in found} == {(1, 1000, 8), (2, 1000, 8), (3, 6000, 3)}
    capped = routing.route(requests, spark.createDataFrame(rows, STOP_TIMES), max_rides=5)
    assert {r.req_id for r in routing.recover(capped, requests).collect()} == {3}


def test_the_safe_earlier_departure_survives(spark):
    """Alone, the late train to the middle is too risky for the ride before it."""
    rows = [
        ("early", 1, "mid", 600, 600, "bus"), ("early", 2, "end", 1200, 1200, "bus"),
        ("late", 1, "mid", 3000, 3000, "bus"), ("late", 2, "end", 7190, 7190, "bus"),
        ("feeder", 1, "home", 0, 0, "bus"), ("feeder", 2, "mid", 300, 300, "bus"),
        ("feeder2", 1, "home", 100, 100, "bus"), ("feeder2", 2, "mid", 2870, 2870, "bus"),
    ]
    # Up to one minute of slack 60 %, beyond always in time.
    cdf = spark.createDataFrame([("bus", [0.6, 0.6] + [1.0] * 13)], "vehicle STRING, cdf ARRAY<DOUBLE>")
    requests = spark.createDataFrame([(1, "home", "end", 0, 7200, 0.7)], REQUESTS)
    several = routing.recover(routing.route(requests, spark.createDataFrame(rows, STOP_TIMES), cdf=cdf, cdf_keys=("vehicle",)), requests).collect()
    assert [(r.dep, round(r.p, 6)) for r in several] == [(0, 1.0)]


def test_one_stop_outside_the_globe_leaves_the_grid_fine(spark):
    rows = [(f"a{k}", 47.0 + k * 0.001, 8.0) for k in range(30)] + [("bad", 91.0, 8.0), ("pole", 89.9999, 170.0), ("pole2", 89.9999, -10.0), ("east", 10.0, 179.9999), ("west", 10.0, -179.9999)]
    stops = spark.createDataFrame(rows, "stop_id STRING, stop_lat DOUBLE, stop_lon DOUBLE")
    got = {(r.src_stop_id, r.dst_stop_id) for r in mobility.walking_pairs(stops, 0.5).collect()}
    near = {(a, b) for k in range(30) for m in range(30) for a, b in [(f"a{k}", f"a{m}")] if 0 < abs(k - m) <= 4}
    assert near <= got and {("pole", "pole2"), ("east", "west")} <= got
    assert not any("bad" in pair for pair in got - near)


def test_backward_edges_are_counted(spark):
    rows = [("t", 1, "a", 0, 100), ("t", 2, "b", 50, 60), ("t", 3, "c", 200, 210), ("u", 1, "a", 0, 1), ("u", 2, "b", 5, 6)]
    table = spark.createDataFrame(rows, "trip_id STRING, stop_sequence INT, stop_id STRING, arrival BIGINT, departure BIGINT")
    assert mobility.backward_edges(table).collect() == [("t", 1)]
    assert mobility.trip_edges(table).count() == 2


def test_samples_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).withColumn("x", F.col("id") * 2)
    for key in (["id"], None):
        one, two = (catalog.sample_fraction(r, 0.1, seed=3, key=key) for r in (rows.repartition(3), rows.repartition(11)))
        assert sorted(one.collect()) == sorted(two.collect()) and 350 < one.count() < 650
