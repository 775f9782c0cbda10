"""Readers. Locations are any URI the Hadoop file systems of the cluster understand."""

from __future__ import annotations

import os
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from corpuswright.schema import MANIFEST_SCHEMA, RAW_SCHEMA, SPLIT_ROW_SCHEMA


def data_location(path: str) -> str:
    """Place a relative path below the folder or URI named by DATA_ROOT, if it is set."""
    root = os.environ.get("DATA_ROOT")
    return path if not root or "://" in path or path.startswith("/") else f"{root.rstrip('/')}/{path}"


def spread(scan: DataFrame) -> DataFrame:
    """Divide a scan of a few large files or row groups over all cores before costly
    per-row work. A scan with at least one partition per core stays as it is."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def read_json_array(
    spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, pattern: str = "*.json"
) -> DataFrame:
    """Files that hold one array of records or one record. Such a file is read by a single
    task; use JSON lines for large inputs. Malformed files fail."""
    return spread(
        spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST")
        .option("pathGlobFilter", pattern).json(path)
    )


def read_jsonl(
    spark: SparkSession, path: str, schema: StructType = RAW_SCHEMA, pattern: str = "*.jsonl"
) -> DataFrame:
    """One record per line, blank lines skipped, malformed lines fail."""
    return (
        spark.read.schema(schema).option("mode", "FAILFAST").option("pathGlobFilter", pattern).json(path)
    )


def _has_files(spark: SparkSession, path: str, pattern: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs
    location = hadoop.Path(path)
    system = location.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(system.globStatus(hadoop.Path(location, pattern)))


def read_raw_dir(spark: SparkSession, path: str) -> DataFrame:
    """All *.json and *.jsonl files directly below a folder; warns when there are none."""
    frames = []
    if _has_files(spark, path, "*.json"):
        frames.append(read_json_array(spark, path))
    if _has_files(spark, path, "*.jsonl"):
        frames.append(read_jsonl(spark, path))
    if not frames:
        warnings.warn(f"no JSON or JSONL files in {path}", stacklevel=2)
        return spark.createDataFrame([], RAW_SCHEMA)
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def load_splits(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """The processed corpus with its split column; filters on split prune folders."""
    return spark.read.schema(SPLIT_ROW_SCHEMA).format(file_format).load(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", True).json(path)
