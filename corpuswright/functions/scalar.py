"""Small column functions that are not about text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def order_key(seed: int | str, key: Column) -> Column:
    """Seeded pseudo-random key: sorting by it is the deterministic shuffle used everywhere."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def hash_fraction(seed: int | str, key: Column) -> Column:
    """Seeded uniform number in [0, 1) that depends on the key alone."""
    digits = F.substring(order_key(seed, key), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(2.0**32)


def argmax(scores: Column) -> Column:
    """Index of the largest score, the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double, 0 when whole is 0 or null."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(0.0)


def throughput(rows: Column, seconds: Column) -> Column:
    return ratio(rows, seconds)


def megabytes(size_bytes: Column) -> Column:
    return F.round(size_bytes / F.lit(float(1 << 20)), 3)


def utc_now() -> Column:
    zone = F.current_timezone()
    return F.date_format(
        F.to_utc_timestamp(F.current_timestamp(), zone), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    )


def literal_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple]) -> DataFrame:
    """Inline table for small fixed domains."""
    structs = [
        F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, row)]) for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs)))
