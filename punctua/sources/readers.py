"""Readers.  All of them take a schema, so no file is read to guess one."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from punctua.sources import schemas


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Parquet table ``name`` of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_delimited(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = "\t") -> DataFrame:
    """Delimited text with a header line."""
    return spark.read.schema(schema).csv(path, sep=sep, header=True)


def read_gtfs(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """Timetable table ``table``: quoted CSV, all columns text."""
    reader = spark.read.schema(schemas.TIMETABLE[table]).option("quote", '"').option("escape", '"')
    return reader.csv(f"{folder}/{table}", header=True)


def read_stop_events(
    spark: SparkSession, base: str, day: dt.date | None = None, english: bool = True
) -> DataFrame:
    """Actual arrivals and departures, partitioned by ``year`` and ``month``.

    ``day`` keeps one operating day.  The day is text in the files, so the
    partition predicate that goes with it is added here: without it a one-day
    query would scan all months.
    """
    events = spark.read.schema(schemas.STOP_EVENTS).orc(base)
    if day is not None:
        events = events.filter(
            (F.col("year") == day.year)
            & (F.col("month") == day.month)
            & (F.col("betriebstag") == day.strftime("%d.%m.%Y"))
        )
    return events.withColumnsRenamed(schemas.STOP_EVENT_NAMES) if english else events


def read_stops(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.STOPS).orc(path)


def read_orc(spark: SparkSession, path: str) -> DataFrame:
    """ORC files or one partition directory, schema from the file footers."""
    return spark.read.orc(path)


def read_hashtag_json(spark: SparkSession, path: str, schema: str = schemas.TWEETS) -> DataFrame:
    """JSON lines (plain or bz2); a malformed line becomes a row of NULLs."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """Edge table in CSV, one declared type per column."""
    reader = spark.read.schema(schemas.EDGES).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    return reader.csv(path, header=True)


def from_rows(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """Small table from local rows."""
    return spark.createDataFrame(rows, schema)


def from_range(spark: SparkSession, n: int, name: str = "id") -> DataFrame:
    return spark.range(n).withColumnRenamed("id", name)
