"""Session helpers: configuration, shared scratch space and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: str = "*", app: str = "paneloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    local = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g"}
    for key, value in {**SESSION_CONF, **local, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    It is the one named by ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder of its own; on a cluster the absence is an error, never a machine-local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fresh = tempfile.mkdtemp(prefix="paneloom-")
    spark.conf.set("spark.checkpoint.dir", fresh)
    return fresh


def run_dir(spark: SparkSession) -> str:
    """The folder below the shared one that holds everything this application writes for itself."""
    return os.path.join(shared_dir(spark), f"run-{spark.sparkContext.applicationId}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in this application's folder; never reused, so nothing is overwritten."""
    return os.path.join(run_dir(spark), f"{name}-{uuid.uuid4().hex}")


def drop_scratch(spark: SparkSession, path: str | None = None) -> bool:
    """Delete this application's folder, or one path in it, once no result that reads it is needed any more.

    Nothing is deleted by itself: frames that were cut go on reading what was written.
    """
    own = run_dir(spark)
    if path is not None and not path.startswith(own + os.sep):
        raise ValueError(f"{path} is not in {own}")
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path or own)
    return place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the rows to the shared folder and go on from the written table.

    Everything upstream runs once, the plan behind the result is a scan, and the loss of executors
    costs at most the tasks they were running.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
