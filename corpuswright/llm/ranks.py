"""Row numbers over all rows of a table, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpuswright.sources.staging import stage

_RUN = "__run"


def number_within(rows: DataFrame, groups: list[str], output: str, buckets: int = 256) -> DataFrame:
    """Add a gapless number from 0 within each group, in no particular order.

    rows: a narrow table. A group may hold any share of the rows, so its rows are dealt
    over buckets by their place at the scan. The table is written with that place, which
    fixes the numbers whatever is computed again later; the rows of a bucket are numbered
    by a window, and the bucket counts (groups x buckets rows) say where each begins.
    """
    place = F.monotonically_increasing_id()
    keyed = stage(rows.withColumn("__place", place), "numbered")
    keyed = keyed.withColumn(_RUN, F.pmod(F.xxhash64("__place"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(*groups).orderBy(_RUN).rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy(*groups, _RUN).agg(F.count("*").alias("__n")).select(
        *groups, _RUN, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start")
    )
    within = Window.partitionBy(*groups, _RUN).orderBy("__place")
    numbered = keyed.withColumn("__row", F.row_number().over(within) - 1)
    return numbered.join(starts, [*groups, _RUN]).select(
        *rows.columns, (F.col("__start") + F.col("__row")).cast("long").alias(output)
    )
