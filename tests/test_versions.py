"""Whole-table refresh: readers never see half of one, failed writes change nothing."""

import os

import pytest
from pyspark.sql import functions as F

from paneloom.sources import readers, versions, writers


def test_failed_refresh_leaves_the_old_table(spark, fresh):
    path = fresh("table")
    writers.full_refresh(spark.range(5), path)
    planned = readers.read_table(spark, path)
    broken = spark.range(100).select(F.when(F.col("id") == 99, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="killed"):
        writers.full_refresh(broken, path)
    assert readers.read_table(spark, path).count() == 5 and len(versions.versions(spark, path)) == 1
    writers.full_refresh(spark.range(8), path)
    assert readers.read_table(spark, path).count() == 8
    assert planned.count() == 5  # planned before the refresh


def test_refresh_from_its_own_table(spark, fresh):
    path = fresh("table")
    writers.full_refresh(spark.range(3), path)
    writers.full_refresh(readers.read_table(spark, path).select((F.col("id") + 10).alias("id")), path)
    assert sorted(r["id"] for r in readers.read_table(spark, path).collect()) == [10, 11, 12]


def test_graph_tables_change_together(spark, fresh, rows):
    path = fresh("graph")
    graph = lambda n: (spark.range(n), spark.range(n).select("id", F.lit("T").alias("type")))
    writers.write_graph(*graph(2), path)
    vertices, edges = graph(4)
    with pytest.raises(Exception, match="killed"):
        writers.write_graph(vertices, edges.withColumn("x", F.raise_error(F.lit("killed")).cast("int")), path)
    assert [t.count() for t in readers.read_graph(spark, path)] == [2, 2]
    writers.write_graph(vertices, edges, path)
    assert [t.count() for t in readers.read_graph(spark, path)] == [4, 4]


def test_prune(spark, fresh):
    path = fresh("table")
    for n in (1, 2, 3):
        writers.full_refresh(spark.range(n), path)
    os.makedirs(os.path.join(path, versions.FOLDER + "dead"))
    assert len(versions.prune(spark, path)) == 2  # the folder of a running refresh stays
    assert versions.prune(spark, path, idle_hours=-1) == [versions.FOLDER + "dead"]
    assert readers.read_table(spark, path).count() == 3
    with pytest.raises(ValueError):
        versions.prune(spark, path, keep=0)


def test_plain_folder_is_read_as_it_is(spark, fresh):
    path = fresh("plain")
    spark.range(2).write.parquet(path)
    assert readers.read_table(spark, path).count() == 2
