"""What is there: tables, columns, first rows, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from punctua.functions.draws import draw_int, draw_unit
from punctua.operators.selection import first_rows, number_parts


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Make ``name`` the current database; it is created, at ``location`` if given, where it is missing."""
    create_database(spark, name, location)
    spark.catalog.setCurrentDatabase(name)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = "" if location is None else f" LOCATION '{_text(location)}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def tables(spark: SparkSession, database: str | None = None) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database)]


def external_table(spark: SparkSession, name: str, schema: StructType, path: str, partitions: Sequence[str], source: str = "parquet") -> DataFrame:
    """Table over the existing folders ``path/<partition>=<value>/..``, all of them known to the catalog.

    No data is read or moved.  The catalog lists the partitions, so a filter on
    their columns leaves out folders before any file is listed.  ``name`` may hold a
    database; a table of that name stays as it is, and folders added since are
    found by calling this again.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{c}`" for c in partitions)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING {source} PARTITIONED BY ({by}) LOCATION '{_text(path)}'")
    spark.sql(f"MSCK REPAIR TABLE {_quoted(name)} SYNC PARTITIONS")
    return spark.table(_quoted(name))


def partitions(spark: SparkSession, name: str) -> DataFrame:
    """One row per partition the catalog knows: its column values as a map."""
    listed = spark.sql(f"SHOW PARTITIONS {_quoted(name)}")
    pairs = F.transform(F.split("partition", "/"), lambda p: F.struct(F.substring_index(p, "=", 1), F.url_decode(F.replace(F.substr(p, F.instr(p, "=") + 1, F.length(p)), F.lit("+"), F.lit("%2B")))))
    return listed.select(F.map_from_entries(pairs).alias("values"))


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def describe(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position INT, column_name STRING, type STRING, nullable BOOLEAN")


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)


def sample_fraction(df: DataFrame, fraction: float, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """Each row with probability ``fraction``; no shuffle.

    The draw depends on the ``key`` (integer columns), or on all columns, and
    not on partitions; rows that agree in it stay or go together.
    """
    drawn = draw_unit(seed, *map(F.col, key)) if key else F.shiftrightunsigned(_draw(df, seed, None), 11) / float(1 << 53)
    return df.filter(drawn < fraction)


def sample_n(df: DataFrame, n: int, seed: int = 0, key: list[str] | None = None) -> DataFrame:
    """Exactly ``n`` random rows (all rows if there are fewer).

    Rows are drawn by a number made from integer ``key`` columns, or from all
    columns, so a retried task draws the same.  The number of the n-th row is found
    by counting; the rest is a filter in place, without a shuffle or an order.
    """
    drawn = df.withColumn("__draw", _number(df, seed, key))
    return first_rows(drawn, ["__draw", *(key or [])], n).drop("__draw")


def holdout(df: DataFrame, n: int, key: list[str], seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split off ``n`` random rows: (rest, held out), both filters on one number per row.

    ``key`` are integer columns that identify a row.
    """
    drawn = number_parts(df.withColumn("__draw", _number(df, seed, key)), ["__draw", *key], lambda total: [min(n, total)], "__part")
    return tuple(drawn.filter(F.col("__part") == part).drop("__draw", "__part") for part in (1, 0))


def _number(df: DataFrame, seed: int, key: list[str] | None) -> Column:
    """A number per row: from the key, or else from all columns."""
    return draw_int(seed, *map(F.col, key)) if key else _draw(df, seed, None)


def _draw(df: DataFrame, seed: int, key: list[str] | None) -> Column:
    return F.xxhash64(F.lit(seed), *(key or df.columns))
