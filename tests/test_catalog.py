"""Tables over existing folders, known to the catalog."""

from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from punctua.session import scratch_path
from punctua.sources import catalog, writers


@pytest.fixture
def database(spark):
    name = f"db_{uuid4().hex}"
    catalog.create_database(spark, name, scratch_path(spark, "it's a database"))
    yield name
    spark.sql(f"DROP DATABASE `{name}` CASCADE")


def test_external_table_finds_prunes_and_refreshes(spark, database):
    rows = spark.range(60).select("id", F.concat(F.lit("a b/"), F.col("id") % 3).alias("kind"), (F.col("id") % 2).cast("int").alias("part"))
    path = writers.write_partitioned(rows.filter("part = 0"), scratch_path(spark, "folders"), ("kind", "part"))
    name = f"{database}.things"
    table = catalog.external_table(spark, name, rows.schema, path, ["kind", "part"], "orc")
    assert table.count() == 30 and catalog.tables(spark, database) == ["things"] and catalog.preview(table, 4).count() == 4
    values = sorted(tuple(sorted(r["values"].items())) for r in catalog.partitions(spark, name).collect())
    assert values == [(("kind", f"a b/{k}"), ("part", "0")) for k in range(3)]
    # Folders that appear later are unknown until the partitions are recovered again.
    rows.filter("part = 1").write.mode("append").partitionBy("kind", "part").orc(path)
    assert catalog.external_table(spark, name, rows.schema, path, ["kind", "part"], "orc").count() == 60
    one = spark.table(name).filter((F.col("kind") == "a b/1") & (F.col("part") == 1))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and "InMemoryFileIndex(1 paths)" in plan
    assert sorted(r.id for r in one.collect()) == [k for k in range(60) if k % 3 == 1 and k % 2]


def test_use_database_and_empty_folder(spark, database):
    before = spark.catalog.currentDatabase()
    try:
        catalog.use_database(spark, database)
        path = scratch_path(spark, "folders")
        spark.range(0).write.parquet(path)
        schema = spark.range(1).withColumn("part", F.lit(1)).schema
        assert catalog.external_table(spark, "nothing", schema, path, ["part"]).count() == 0
        assert "nothing" in catalog.tables(spark) and catalog.partitions(spark, "nothing").count() == 0
    finally:
        spark.catalog.setCurrentDatabase(before)
