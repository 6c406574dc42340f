"""Spark session, the shared scratch folder and lineage cutting."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every job of this library assumes.  AQE sizes the shuffles, splits
#: skewed join partitions and turns a join into a broadcast once the measured
#: side is below the threshold; UTC keeps calendar fields machine independent.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Scratch folders of this driver.
_SCRATCH: list[str] = []


def build_session(name: str = "punctua", master: str | None = None, **extra: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``extra`` holds further ``spark.*`` settings."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: ``spark.checkpoint.dir`` of the session.

    A temporary folder stands in only for a local master, where driver and
    executors are one process; on a cluster the setting is required.
    """
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        known = spark.sparkContext.getCheckpointDir()
    if not known:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        known = tempfile.mkdtemp(prefix="punctua-")
        atexit.register(shutil.rmtree, known, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", known)
    return known


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other job uses."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this driver has put under the shared folder so far.

    To be called once the results are written: frames may still read from it.
    """
    context = spark.sparkContext
    while _SCRATCH:
        path = context._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor costs
    one re-read instead of the whole chain of rounds behind it."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)
