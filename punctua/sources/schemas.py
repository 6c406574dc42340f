"""Declared schemas.

The names and types below are fixed values: they are the columns of the public
feeds (actual arrivals and departures, timetable, hashtags, sensors) and must
equal what the files hold.
"""

from __future__ import annotations

# Actual arrivals and departures, one row per stop of a journey; all text,
# partitioned by year and month.
STOP_EVENTS = """
    betriebstag STRING, fahrt_bezichner STRING, betreiber_id STRING, betreiber_abk STRING,
    betreiber_name STRING, produkt_id STRING, linien_id STRING, linien_text STRING,
    umlauf_id STRING, verkehrsmittel_text STRING, zusatzfahrt_tf STRING, faellt_aus_tf STRING,
    bpuic STRING, haltestellen_name STRING, ankunftszeit STRING, an_prognose STRING,
    an_prognose_status STRING, abfahrtszeit STRING, ab_prognose STRING,
    ab_prognose_status STRING, durchfahrt_tf STRING, year INT, month INT
"""

STOPS = """
    stop_id STRING, stop_name STRING, stop_lat FLOAT, stop_lon FLOAT,
    location_type STRING, parent_station STRING
"""

# Timetable tables, quoted CSV with a header line, all text.
TIMETABLE = {
    "stop_times": """
        trip_id STRING, arrival_time STRING, departure_time STRING, stop_id STRING,
        stop_sequence STRING, pickup_type STRING, drop_off_type STRING
    """,
    "trips": """
        route_id STRING, service_id STRING, trip_id STRING, trip_headsign STRING,
        trip_short_name STRING, direction_id STRING
    """,
    "calendar": """
        service_id STRING, monday STRING, tuesday STRING, wednesday STRING, thursday STRING,
        friday STRING, saturday STRING, sunday STRING, start_date STRING, end_date STRING
    """,
    "routes": """
        route_id STRING, agency_id STRING, route_short_name STRING, route_long_name STRING,
        route_desc STRING, route_type STRING
    """,
}

EDGES = """
    src_stop_id STRING, trip_id STRING, src_departure_time TIMESTAMP_NTZ, vehicle STRING,
    monday INT, tuesday INT, wednesday INT, thursday INT, friday INT,
    dst_stop_id STRING, dst_arrival_time TIMESTAMP_NTZ, duration BIGINT
"""

TWEETS = """
    timestamp_ms STRING, lang STRING,
    entities STRUCT<hashtags: ARRAY<STRUCT<text: STRING, indices: ARRAY<INT>>>>
"""

CO2 = "timestamp TIMESTAMP_NTZ, LocationName STRING, SensorUnit_ID INT, CO2 DOUBLE"

SENSOR_SITES = "index INT, LocationName STRING, zone STRING, altitude DOUBLE, LON DOUBLE, LAT DOUBLE"

# English names used by the operators for the columns of STOP_EVENTS.
STOP_EVENT_NAMES = {
    "betriebstag": "trip_day",
    "fahrt_bezichner": "trip_id",
    "betreiber_id": "operator_id",
    "betreiber_abk": "operator_short",
    "betreiber_name": "operator_name",
    "produkt_id": "vehicle",
    "linien_id": "line_id",
    "linien_text": "line_text",
    "umlauf_id": "circuit_id",
    "verkehrsmittel_text": "service_type",
    "zusatzfahrt_tf": "additional_trip",
    "faellt_aus_tf": "cancelled",
    "bpuic": "stop_number",
    "haltestellen_name": "stop_name",
    "ankunftszeit": "sched_arr",
    "an_prognose": "act_arr",
    "an_prognose_status": "arr_status",
    "abfahrtszeit": "sched_dep",
    "ab_prognose": "act_dep",
    "ab_prognose_status": "dep_status",
    "durchfahrt_tf": "passes_through",
}

BUSINESS_DAYS = ["monday", "tuesday", "wednesday", "thursday", "friday"]
