"""Intermediate tables that several later passes read.

They are written as parquet below the folder that the session names in
spark.checkpoint.dir, which all executors share, so a lost executor costs a re-read
and later passes load only the columns they need.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def staging_root(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    Without one, a local session gets a fresh folder for its lifetime; a cluster has to
    name a folder that all executors share.
    """
    context = spark.sparkContext
    configured = spark.conf.get(_SETTING, None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="corpuswright-"))
        configured = context.getCheckpointDir()
    return configured.rstrip("/")


def new_location(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write the frame once and return a frame that reads the written table."""
    spark = frame.sparkSession
    location = new_location(spark, name)
    frame.write.parquet(location)
    return spark.read.schema(frame.schema).parquet(location)


def remove(frame: DataFrame) -> None:
    """Delete the table that a frame of stage() reads, once nothing reads it any more."""
    spark = frame.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(staging_root(spark)).toUri().getPath()
    for file in frame.inputFiles()[:1]:
        folder = hadoop.Path(file).getParent()
        if folder.getParent().toUri().getPath() != root:
            raise ValueError(f"{folder} is no staged table")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
