"""Families and texts that occur in more than one split.

One aggregation per key collects the splits as a bit mask; a single further pass
counts the masks of all split pairs. Texts travel as 256-bit digests only.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.functions import text as tx
from corpuswright.schema import SPLITS


def _split_bit(splits: Sequence[str]) -> Column:
    bit = F.lit(0)
    for i, name in enumerate(splits):
        bit = F.when(F.col("split") == name, 1 << i).otherwise(bit)
    return bit


def split_masks(rows: DataFrame, key: Column, splits: Sequence[str] = SPLITS) -> DataFrame:
    """(key, mask): bit i is set when the key occurs in splits[i]."""
    return rows.groupBy(key.alias("key")).agg(F.bit_or(_split_bit(splits)).alias("mask"))


def _pairs(splits: Sequence[str]):
    for (i, a), (j, b) in combinations(enumerate(splits), 2):
        yield a, b, (1 << i) | (1 << j)


def overlap_counts(rows: DataFrame, key: Column, splits: Sequence[str] = SPLITS) -> DataFrame:
    """Number of distinct keys shared by every pair of splits."""
    masks = split_masks(rows, key, splits)
    pairs = list(_pairs(splits))
    counts = masks.agg(*[
        F.count_if(F.col("mask").bitwiseAND(bits) == bits).alias(f"{a}_{b}") for a, b, bits in pairs
    ])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left_split"), F.lit(b).alias("right_split"), F.col(f"{a}_{b}").alias("shared"))
        for a, b, _ in pairs
    ])))


def family_overlap(rows: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    return overlap_counts(rows, F.col("family_id"), splits)


def exact_text_overlap(rows: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    return overlap_counts(rows, F.sha2("text", 256), splits)


def caseless_text_overlap(rows: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    return overlap_counts(rows, F.sha2(F.lower("text"), 256), splits)


def overlap_examples(
    rows: DataFrame, key: Column, limit: int, splits: Sequence[str] = SPLITS
) -> DataFrame:
    """The first limit shared keys, in key order, of every pair of splits."""
    shared = split_masks(rows, key, splits).select("key", F.inline(F.array(*[
        F.struct(
            F.lit(a).alias("left_split"), F.lit(b).alias("right_split"),
            (F.col("mask").bitwiseAND(bits) == bits).alias("hit"),
        )
        for a, b, bits in _pairs(splits)
    ]))).filter("hit")
    nth = F.row_number().over(Window.partitionBy("left_split", "right_split").orderBy("key"))
    return shared.withColumn("rank", nth).filter(F.col("rank") <= limit).drop("hit")


def text_overlap_examples(
    rows: DataFrame, limit: int = 3, preview: int = 80, splits: Sequence[str] = SPLITS
) -> DataFrame:
    """Previews of up to limit shared texts per pair of splits."""
    digest = F.md5("text")
    examples = overlap_examples(rows, digest, limit, splits)
    # limit rows per pair of splits: a fixed handful, whatever the corpus size.
    hits = rows.withColumn("key", digest).join(F.broadcast(examples), "key")
    return hits.groupBy("left_split", "right_split", "rank").agg(
        F.min(tx.preview(F.col("text"), preview)).alias("preview"), F.count("*").alias("copies")
    )


def duplicate_texts(rows: DataFrame) -> DataFrame:
    """Rows per split whose text repeats an earlier row of the split."""
    copies = rows.groupBy("split", F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"))
    return copies.groupBy("split").agg(
        F.sum("n").alias("rows"), F.count("*").alias("distinct_texts"),
        (F.sum("n") - F.count("*")).alias("duplicates"),
    )
