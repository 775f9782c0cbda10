"""Run registered queries against their DuckDB SQL: python -m checks.compare SF_DIR [names]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("corpuswright")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str):
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or value is pd.NA or (isinstance(value, float) and value != value):
        return None
    return tuple(value) if hasattr(value, "__len__") and not isinstance(value, str) else value


def canonical(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [tuple(_plain(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=repr)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when both hold the same rows in any order, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(canonical(got), canonical(want)):
        if a != b:
            return f"{str(a)[:300]} / {str(b)[:300]}"
    return None


def main(sf: str, names: list[str]) -> int:
    from checks.queries import ORACLE, QUERIES

    spark, connection, bad = session(), duck(sf), 0
    for name in names or list(QUERIES):
        started = time.time()
        try:
            got = QUERIES[name](spark, sf).toPandas()
            took = time.time() - started
            if name not in ORACLE:
                print(f"rows  {name} {len(got)} rows {took:.1f}s", flush=True)
                continue
            want = connection.execute(ORACLE[name]).df()
            problem = difference(got, want)
            total = time.time() - started - took
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, took, total, got = f"{type(error).__name__}: {str(error)[:600]}", 0.0, 0.0, []
        bad += problem is not None
        print(f"{'FAIL ' if problem else 'ok   '} {name} {len(got)} rows {took:.1f}s duckdb {total:.1f}s {problem or ''}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
