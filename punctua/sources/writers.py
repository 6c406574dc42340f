"""Writers, model persistence and caching of reused intermediates."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame


# The default pattern would cut times to milliseconds.
CSV_TIME = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def materialise(df: DataFrame, name: str, mode: str = "overwrite", path: str | None = None) -> DataFrame:
    """Store a query result as the ORC table ``name``, in the warehouse or under
    ``path``, and return the table."""
    df.write.format("orc").mode(mode).saveAsTable(name, path=path)
    return df.sparkSession.table(name)


def write_orc(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").orc(path)
    return path


def write_csv(df: DataFrame, path: str, sep: str = ",") -> str:
    """Directory of CSV parts, each with a header line."""
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    writer.option("timestampNTZFormat", CSV_TIME).csv(path)
    return path


def write_json(df: DataFrame, path: str, codec: str | None = None) -> str:
    df.write.mode("overwrite").json(path, compression=codec)
    return path


def write_partitioned(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "month")) -> str:
    """ORC partitioned by ``by``.

    Rows meet their partition before the write, which avoids one file per task
    and partition.  The hint leaves the sizes to AQE: a partition with most of
    the rows is split over several tasks, small ones share a task.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).orc(path)
    return path


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Persist ``df`` for the length of a ``with`` block; blocks that do not fit
    in memory go to disk.  What an outer block keeps already stays with that."""
    if df.storageLevel != StorageLevel.NONE:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def save_model(model: MLWritable, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
