"""Sinks. Corpus-sized tables are written in parallel; single files are kept for results
of a known small number of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuswright.schema import ROW_FIELDS


def write_splits(rows: DataFrame, path: str, file_format: str = "json", mode: str = "errorifexists") -> None:
    """One folder per split; JSON keeps the field order, nulls and non-ASCII characters."""
    (
        rows.select(*ROW_FIELDS, "split").write.partitionBy("split").mode(mode)
        .option("ignoreNullFields", False).format(file_format).save(path)
    )


def write_record(record: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Nested one-row results such as a manifest or a run record, as one JSON file."""
    record.coalesce(1).write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(result: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Aggregated results (run tables, confusion matrices) as one CSV file with a header."""
    result.coalesce(1).write.mode(mode).option("header", True).csv(path)


def write_report(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Report lines (line_no, line) as one text file."""
    ordered = lines.orderBy("line_no").select("line")
    ordered.coalesce(1).write.mode(mode).text(path)


def write_predictions(predictions: DataFrame, path: str, mode: str = "errorifexists") -> None:
    predictions.write.partitionBy("model_name").mode(mode).parquet(path)


def artifact_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files and megabytes below a saved model, from file metadata only."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    )
    return files.agg(
        F.count("*").alias("files"), F.round(F.sum("length") / F.lit(float(1 << 20)), 3).alias("size_mb")
    )
