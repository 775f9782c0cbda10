"""Seeded samples and heads.

Every choice depends on a hash of the row id, so it does not change with the
partitioning of the input. Spark applies small row limits per group inside the map tasks
before the shuffle; where it does not, the cut is found on digit counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.functions import text as tx
from corpuswright.functions.scalar import hash_fraction, order_key
from corpuswright.operators.selection import first_per_group, hex_digits, text_digits, with_rank
from corpuswright.schema import DEFAULT_SEED


def _first_per_group(
    rows: DataFrame, group: str | None, n: int, order: Sequence[Column], digits: Sequence[Column]
) -> DataFrame:
    limit = int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > limit:
        return with_rank(first_per_group(rows, group, n, order, digits), group, order, digits[0], "rank")
    parts = [] if group is None else [group]
    nth = F.row_number().over(Window.partitionBy(*parts).orderBy(*order))
    return rows.withColumn("rank", nth).filter(F.col("rank") <= n)


def _shuffled(seed: int, key: str) -> tuple[list[Column], list[Column]]:
    """Order of the deterministic shuffle, and its digits."""
    digest = order_key(seed, F.col(key))
    return [digest, F.col(key)], hex_digits(digest)


def sample_per_group(
    rows: DataFrame, group: str = "label", n: int = 5, seed: int = DEFAULT_SEED, key: str = "id"
) -> DataFrame:
    """Up to n rows of every group, with their rank in the sample."""
    return _first_per_group(rows, group, n, *_shuffled(seed, key))


def example_rows(rows: DataFrame, n: int = 5, seed: int = DEFAULT_SEED) -> DataFrame:
    """Short previews of sampled rows per label."""
    return sample_per_group(rows, "label", n, seed).select(
        "label", "rank", tx.preview(F.col("text"), 100).alias("preview"),
        "source", "family_id", "text_len_word",
    )


def head_per_group(rows: DataFrame, group: str = "split", n: int = 3, key: str = "id") -> DataFrame:
    """The first n rows of every group by key."""
    return _first_per_group(rows, group, n, [F.col(key)], text_digits(F.col(key).cast("string")))


def sample_rows(
    rows: DataFrame, n: int, seed: int = DEFAULT_SEED, key: str = "id"
) -> DataFrame:
    """A uniform sample of n rows."""
    return _first_per_group(rows, None, n, *_shuffled(seed, key)).drop("rank")


def sample_splits(
    rows: DataFrame, sizes: Mapping[str, int], seed: int = DEFAULT_SEED, key: str = "id"
) -> DataFrame:
    """A uniform sample of the given number of rows from every named split."""
    limit = None
    for split, n in sizes.items():
        chosen = F.when(F.col("split") == split, n)
        limit = chosen if limit is None else limit.when(F.col("split") == split, n)
    named = rows.filter(F.col("split").isin(*sizes))
    ranked = _first_per_group(named, "split", max(sizes.values()), *_shuffled(seed, key))
    return ranked.filter(F.col("rank") <= limit)


def sample_fraction(
    rows: DataFrame, fraction: float, seed: int = DEFAULT_SEED, key: str = "id"
) -> DataFrame:
    """Rows whose hash falls below the fraction."""
    return rows.filter(hash_fraction(seed, F.col(key)) < fraction)


def sample_stratified(
    rows: DataFrame, fractions: Mapping[str, float], column: str = "label",
    seed: int = DEFAULT_SEED, key: str = "id",
) -> DataFrame:
    """Rows whose hash falls below the fraction of their stratum; strata without a
    fraction are left out."""
    table = F.create_map(*[x for k, v in fractions.items() for x in (F.lit(k), F.lit(float(v)))])
    limit = F.coalesce(F.try_element_at(table, F.col(column)), F.lit(0.0))
    return rows.filter(hash_fraction(seed, F.col(key)) < limit)
