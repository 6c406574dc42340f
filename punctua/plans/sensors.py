"""Sensor curation: three files to one regular, gap-free table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from punctua.operators.aggregates import site_features, unpivot_sensor
from punctua.operators.joins import merge_outer
from punctua.operators.relational import similar_sites
from punctua.operators.series import interpolate_linear, resample

# Fixed value: bin width of the curated series, in seconds.
STEP = 1800


def curate(co2: DataFrame, climate: DataFrame, sites: DataFrame) -> DataFrame:
    """Half-hourly CO2, temperature and humidity per sensor with its site's place.

    ``co2`` is long, ``climate`` wide (a column per sensor and measure), both
    with a ``timestamp``; sensors without a site are left out.
    """
    gas = resample(co2, ["LocationName", "SensorUnit_ID"], "timestamp", STEP, {"CO2": F.avg("CO2")})
    gas = interpolate_linear(gas, ["LocationName", "SensorUnit_ID"], "timestamp", ["CO2"])
    air = unpivot_sensor(climate, "timestamp").withColumnRenamed("sensor_id", "SensorUnit_ID")
    air = resample(
        air, ["SensorUnit_ID"], "timestamp", STEP, {"temperature": F.avg("temperature"), "humidity": F.avg("humidity")}
    )
    air = interpolate_linear(air, ["SensorUnit_ID"], "timestamp", ["temperature", "humidity"])
    places = sites.select("LocationName", "zone", "altitude", F.col("LON").alias("lon"), F.col("LAT").alias("lat"))
    merged = merge_outer(gas, air, ["timestamp", "SensorUnit_ID"]).join(places, "LocationName")
    return merged.select(
        "timestamp", "LocationName", "SensorUnit_ID", "CO2", "temperature", "humidity", "zone", "altitude", "lon", "lat"
    )


def peer_features(merged: DataFrame, site: str, target: str = "CO2") -> tuple[DataFrame, list[str]]:
    """One row per time: the target of ``site`` and everything its similar sites
    measure.  Returns the table and the names of the features."""
    peers = similar_sites(merged, site)
    # Sites are a dimension of the network, so their names fit a column list.
    names = sorted(r[0] for r in peers.select("LocationName").distinct().collect())
    wide = site_features(
        peers, "timestamp", "LocationName", names, [target, "humidity", "temperature", "altitude", "lon", "lat"]
    )
    wide = wide.withColumnRenamed(f"{target}_{site}", target)
    return wide, [c for c in wide.columns if c not in ("timestamp", target)]
