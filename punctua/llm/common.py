"""Helpers the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from punctua.session import scratch_path

#: Fixed value of the contracts: white space is the space and \t \n \v \f \r,
#: the bytes at which ``bytes.split`` splits.
SPACES = " \t\n\x0b\x0c\r"

#: Rows of a key that meet in one ranking window.
RANK_CHUNK = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage like a checkpoint, but as compressed columns; what is read
    afterwards survives the loss of any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also inside
    lambdas, where the optimizer may otherwise copy the expression."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def place(order: list[Column], many: Column) -> Column:
    """A row's place in the keyed order of its key: (chunk, hash).

    ``many`` is the row count of the key; it sets the number of chunks.
    """
    chunks = F.floor(many / F.lit(RANK_CHUNK)) + 1
    return F.struct(F.pmod(F.xxhash64(*order, F.lit(7)), chunks).alias("chunk"), F.xxhash64(*order).alias("at"))


def ranked(df: DataFrame, keys: list[str], order: list[Column], name: str, per_key: str) -> DataFrame:
    """0-based rank within ``keys`` along :func:`place`, no key in one task.

    A key's rows are dealt to chunks by a hash of their order values; only
    chunks are sorted, and the counts of the chunks before one give its offset.
    ``per_key`` names a column with the key's row count.  Keys compare
    null-safe.  Rows equal in all of ``order`` are interchangeable.
    """
    key = F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"s{i}") for i, k in enumerate(keys)], *[F.col(k).isNull().alias(f"n{i}") for i, k in enumerate(keys)])
    rows = df.withColumns({"__key": key, "__place": place(order, F.col(per_key))}).withColumn("__chunk", F.col("__place.chunk"))
    counts = rows.groupBy("__key", "__chunk").agg(F.count(F.lit(1)).alias("__c"))
    before = Window.partitionBy("__key").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__key", "__chunk", F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__key", "__chunk").orderBy("__place", *order))
    rows = rows.withColumn("__inside", inside).join(offsets, ["__key", "__chunk"])
    return rows.withColumn(name, F.col("__before") + F.col("__inside") - 1).drop("__key", "__chunk", "__inside", "__before", "__place")
