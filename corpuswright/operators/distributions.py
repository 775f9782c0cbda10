"""Class, source and length distributions.

Length statistics start from a length census: row counts per distinct length. It is
combined inside the map tasks and has at most as many rows per group as there are
different lengths, so medians, quartiles, histograms and cumulative curves are exact
without sorting or regrouping the rows themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.functions.scalar import literal_rows, ratio
from corpuswright.schema import LABELS, MIN_CLASS_SHARE, SPLITS


def _zero_filled_shares(
    counts: DataFrame, column: str, domain: Sequence[str], splits: Sequence[str]
) -> DataFrame:
    cells = literal_rows(
        counts.sparkSession, ["split", column], [(s, v) for s in splits for v in domain]
    )
    total = F.sum("n").over(Window.partitionBy("split"))
    return (
        cells.join(counts, ["split", column], "left")
        .withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))
        .select("split", column, "n", (ratio(F.col("n"), total) * 100).alias("pct"))
    )


def class_distribution(
    rows: DataFrame, labels: Sequence[str] = LABELS, splits: Sequence[str] = SPLITS
) -> DataFrame:
    """Count and percentage of every label per split, absent labels as 0.

    Percentages refer to rows with a label of the domain.
    """
    counts = rows.groupBy("split", "label").agg(F.count("*").alias("n"))
    return _zero_filled_shares(counts, "label", labels, splits)


def source_distribution(
    rows: DataFrame, sources: Sequence[str], splits: Sequence[str] = SPLITS
) -> DataFrame:
    """Count and percentage (of all rows of the split) of the listed sources."""
    counts = rows.groupBy("split", "source").agg(F.count("*").alias("n"))
    totals = counts.groupBy("split").agg(F.sum("n").alias("total"))
    cells = literal_rows(
        rows.sparkSession, ["split", "source"], [(s, v) for s in splits for v in sources]
    )
    n = F.coalesce("n", F.lit(0)).cast("long")
    return (
        cells.join(counts, ["split", "source"], "left").join(totals, "split", "left")
        .select("split", "source", n.alias("n"), (ratio(n, F.col("total")) * 100).alias("pct"))
    )


def imbalance_check(
    rows: DataFrame, labels: Sequence[str] = LABELS, threshold: float = MIN_CLASS_SHARE
) -> DataFrame:
    """Label shares over all rows, flagged when strictly below the threshold."""
    counts = rows.agg(
        F.count("*").alias("total"), *[F.count_if(F.col("label") == l).alias(l) for l in labels]
    )
    cells = counts.select("total", F.inline(F.array(*[
        F.struct(F.lit(l).alias("label"), F.col(l).alias("n")) for l in labels
    ])))
    share = ratio(F.col("n"), F.col("total"))
    return cells.select("label", "n", share.alias("share"), (share < threshold).alias("imbalanced"))


def crosstab(rows: DataFrame, row: str, column: str, domain: Sequence[str]) -> DataFrame:
    """Counts of row values by the column values of the domain, 0 where absent."""
    return rows.groupBy(row).agg(
        *[F.count_if(F.col(column) == value).alias(value) for value in domain]
    )


def length_census(rows: DataFrame, length: str, by: Sequence[str]) -> DataFrame:
    """Row counts n per group and distinct length value."""
    return rows.groupBy(*by, F.col(length).cast("long").alias("value")).agg(F.count("*").alias("n"))


def _stddev(count: Column, total: Column, squares: Column) -> Column:
    variance = (squares - total * total / count) / (count - 1)
    return F.when(count > 1, F.sqrt(F.greatest(variance, F.lit(0.0))))


def length_stats(
    rows: DataFrame, lengths: Sequence[str] = ("text_len_word", "text_len_char"),
    by: Sequence[str] = ("split",),
) -> DataFrame:
    """Mean, median, sample standard deviation, minimum and maximum per group."""
    measured = rows.select(*by, F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), F.col(name).cast("long").alias("value"))
        for name in lengths
    ])))
    keys = [*by, "metric"]
    census = measured.groupBy(*keys, "value").agg(F.count("*").alias("n"))
    # Decimal products keep the sums of squares exact at any corpus size.
    value, n = F.col("value").cast("decimal(10,0)"), F.col("n").cast("decimal(14,0)")
    sums = census.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.sum(value * n).cast("double").alias("total"),
        F.sum((value * value).cast("decimal(20,0)") * n).cast("double").alias("squares"),
        F.percentile("value", 0.5, F.col("n")).alias("median"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    count = F.col("n").cast("double")
    return sums.select(
        *keys, "n", (F.col("total") / count).alias("mean"), "median",
        _stddev(count, F.col("total"), F.col("squares")).alias("std"), "min", "max",
    )


def histogram(
    rows: DataFrame, length: str = "text_len_word", by: Sequence[str] = ("split",), bins: int = 50,
    shared_range: bool = False,
) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last bin closed, with the group's
    mean and median. Bins without rows are left out.

    All groups use the same bins when shared_range is on.
    """
    census = length_census(rows, length, by)
    group = Window.partitionBy(*by)
    span = census.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")))
    if shared_range:
        bounds = span.scalar()
        lo, hi = bounds["lo"], bounds["hi"]
    else:
        lo, hi = F.min("value").over(group), F.max("value").over(group)
    ranged = census.select(*by, "value", "n", lo.cast("double").alias("lo"), hi.cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.when(F.col("hi") == F.col("lo"), 0).otherwise(
        F.least(F.floor((F.col("value") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    )
    centre = census.groupBy(*by).agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.percentile("value", 0.5, F.col("n")).alias("median"),
    )
    counted = ranged.groupBy(
        *by, position.cast("int").alias("bin"), "lo", width.alias("width")
    ).agg(F.sum("n").alias("n"))
    return counted.join(centre, list(by)).select(
        *by, "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
        "n", "mean", "median",
    )


def boxplot(
    rows: DataFrame, length: str = "text_len_word", by: Sequence[str] = ("label",), reach: float = 1.5
) -> DataFrame:
    """Quartiles, whiskers (furthest value within reach x IQR of the box) and outliers."""
    census = length_census(rows, length, by)
    quartiles = census.groupBy(*by).agg(
        F.percentile("value", [0.25, 0.5, 0.75], F.col("n")).alias("q")
    ).select(
        *by, F.get("q", F.lit(0)).alias("q1"), F.get("q", F.lit(1)).alias("median"),
        F.get("q", F.lit(2)).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - reach * iqr, F.col("q3") + reach * iqr)
    return census.join(quartiles, list(by)).groupBy(*by, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        F.sum("n").alias("n"),
    )


def ecdf(
    rows: DataFrame, length: str = "text_len_word", by: Sequence[str] = ("label",)
) -> DataFrame:
    """Share of rows at or below every distinct value, per group."""
    census = length_census(rows, length, by)
    group = Window.partitionBy(*by)
    upto = group.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return census.select(
        *by, "value", "n",
        (F.sum("n").over(upto) / F.sum("n").over(group)).alias("ecdf"),
    )


def length_coverage(
    rows: DataFrame, limits: Sequence[int] = (128, 256), length: str = "text_len_word",
    by: Sequence[str] = ("split", "label"),
) -> DataFrame:
    """Share of rows whose length is at most each limit."""
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(length) <= limit).alias(f"within_{limit}") for limit in limits],
    )
    return sums.select(*by, "rows", F.inline(F.array(*[
        F.struct(
            F.lit(limit).alias("limit"),
            (F.col(f"within_{limit}") / F.col("rows")).alias("coverage"),
        )
        for limit in limits
    ])))


def length_outliers(rows: DataFrame, shortest: int = 10, longest: int = 2000) -> DataFrame:
    """Rows per split with fewer than shortest or more than longest characters."""
    return rows.groupBy("split").agg(
        F.count_if(F.col("text_len_char") < shortest).alias("too_short"),
        F.count_if(F.col("text_len_char") > longest).alias("too_long"),
        F.count("*").alias("rows"),
    )


def length_buckets(rows: DataFrame, bucket: Column, by: Sequence[str] = ("split",)) -> DataFrame:
    return rows.groupBy(*by, bucket.alias("bucket")).agg(F.count("*").alias("n"))


def class_pair_comparison(
    rows: DataFrame, first: str, second: str, feature: str = "text_len_word", bins: int = 50
) -> DataFrame:
    """Histogram of one feature for two labels side by side, over shared bins."""
    pair = rows.filter(F.col("label").isin(first, second))
    binned = histogram(pair, feature, ["label"], bins, shared_range=True)

    def of(label: str, column: str) -> Column:
        return F.max(F.when(F.col("label") == label, F.col(column)))

    return binned.groupBy("bin", "bin_start", "bin_end").agg(
        F.coalesce(of(first, "n"), F.lit(0)).cast("long").alias("n_first"),
        F.coalesce(of(second, "n"), F.lit(0)).cast("long").alias("n_second"),
    )


def families_per_split(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct families per split and, under split 'all', over the whole corpus."""
    if approximate:
        both = rows.select("family_id", F.explode(F.array("split", F.lit("all"))).alias("split"))
        return both.groupBy("split").agg(F.approx_count_distinct("family_id").alias("families"))
    masks = rows.select("split", "family_id").distinct()
    per_family = masks.groupBy("family_id").agg(F.collect_set("split").alias("splits"))
    each = per_family.select(F.explode(F.array_append("splits", F.lit("all"))).alias("split"))
    return each.groupBy("split").agg(F.count("*").alias("families"))


def drop_rate_check(drops: DataFrame, kept: DataFrame, threshold: float = 0.05) -> DataFrame:
    """Dropped share of all texts, flagged when above the threshold.

    drops holds (drop_reason, n); null or blank texts are no drops.
    """
    dropped = drops.agg(
        F.sum(F.when(F.col("drop_reason") != "null_or_blank", F.col("n")).otherwise(0)).alias("dropped")
    )
    totals = dropped.select("dropped", kept.agg(F.count("*")).scalar().alias("kept"))
    share = ratio(F.col("dropped"), F.col("dropped") + F.col("kept"))
    return totals.select("dropped", "kept", share.alias("drop_rate"), (share > threshold).alias("alert"))


def class_weights(rows: DataFrame, label: str = "label_id") -> DataFrame:
    """Balanced weights n / (k * n_c) over the labels that occur."""
    counts = rows.groupBy(label).agg(F.count("*").alias("n"))
    # One row per label.
    everything = Window.partitionBy(F.lit(0))
    total, classes = F.sum("n").over(everything), F.count("*").over(everything)
    return counts.select(label, "n", (total.cast("double") / (classes * F.col("n"))).alias("weight"))


def with_class_weights(rows: DataFrame, label: str = "label_id", column: str = "weight") -> DataFrame:
    """Add the balanced weight of its label to every row."""
    weights = class_weights(rows, label).agg(
        F.map_from_entries(F.collect_list(F.struct(label, "weight")))
    )
    return rows.withColumn(column, F.try_element_at(weights.scalar(), F.col(label)))

