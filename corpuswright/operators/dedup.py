"""Exact duplicate removal.

Copies are told apart by a 256-bit digest of the text. The rank-one filter is applied
inside every map task before the shuffle, so a text that makes up a large part of the
corpus sends at most one row per task to its reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

_FIRST = ("family_id", "id", "source")


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str] = _FIRST) -> DataFrame:
    """The first row, by order, of every group of rows with equal keys."""
    digest = [F.sha2(F.col("text"), 256) if k == "text" else F.col(k) for k in keys]
    firsts = Window.partitionBy(*digest).orderBy(*order)
    return (
        rows.withColumn("_nth", F.row_number().over(firsts)).filter(F.col("_nth") == 1).drop("_nth")
    )


def dedup_within_split(rows: DataFrame) -> DataFrame:
    """One row per (split, text, label)."""
    return keep_first(rows, ["split", "text", "label"])


def dedup_global(rows: DataFrame, key_columns: Sequence[str] = ("text",)) -> DataFrame:
    """One row per key over the whole corpus; run before a split it leaves no exact
    text in two splits."""
    return keep_first(rows, list(key_columns))


def dedup_counts(rows: DataFrame) -> DataFrame:
    """Rows per split before and after the within-split duplicate removal."""
    copies = rows.groupBy("split", "label", F.sha2("text", 256).alias("digest")).agg(
        F.count("*").alias("n")
    )
    return copies.groupBy("split").agg(
        F.sum("n").alias("rows_before"),
        F.count("*").alias("rows_after"),
        (F.sum("n") - F.count("*")).alias("removed"),
    )
