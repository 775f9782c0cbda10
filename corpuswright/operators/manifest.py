"""Corpus manifest: totals, counts and mean lengths, fingerprint and reconciliation.

All counts come from one aggregation pass with a partial row per family; the fixed
split and label domains make absent cells zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.functions.scalar import literal_rows, utc_now
from corpuswright.schema import DEFAULT_RATIOS, DEFAULT_SEED, DROP_REASONS, LABELS, SPLITS

# Leading hex digits of a family's digest that name its bucket.
_BUCKET_DIGITS = 4
_LIMBS = 6
_MEANS = ("avg_len_char_per_split", "avg_len_word_per_split")
_LENGTHS = ("text_len_char", "text_len_word")


def _distinct_families(rows: DataFrame) -> DataFrame:
    return rows.select("family_id").distinct()


def fingerprint(rows: DataFrame) -> DataFrame:
    """One row with the family count and two order-independent fingerprints.

    families_hash_sha1: families are put into 65,536 buckets by the sha1 of their id, a
    bucket's digest is the sha1 of its sorted digests, and the fingerprint is the sha1
    of the bucket digests in order; null without a family. families_hash_sum adds the
    sha1 digests limb by limb (an additive multiset hash), in constant memory.
    """
    digests = _distinct_families(rows).select(F.sha1("family_id").alias("digest"))
    limbs = [
        F.sum(F.conv(F.substring("digest", 1 + 6 * i, 6), 16, 10).cast("long")).alias(f"limb{i}")
        for i in range(_LIMBS)
    ]
    # One row per bucket from here on.
    buckets = digests.groupBy(F.substring("digest", 1, _BUCKET_DIGITS).alias("bucket")).agg(
        F.count("*").alias("n"), F.sha1(F.array_join(F.array_sort(F.collect_list("digest")), "")).alias("digest"), *limbs
    )
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "digest")))["digest"]
    sums = [F.sum(f"limb{i}").alias(f"limb{i}") for i in range(_LIMBS)]
    total = buckets.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_families"), F.array_join(ordered, "").alias("all"), *sums)
    return total.select(
        "total_families", F.when(F.col("total_families") > 0, F.sha1("all")).alias("families_hash_sha1"),
        F.sha1(F.concat_ws(":", *[f"limb{i}" for i in range(_LIMBS)])).alias("families_hash_sum"),
    )


def _quoted(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _cell(split: str, label: str | None = None) -> str:
    return f"rows_{split}" + (f"_{label}" if label else "")


def manifest_wide(
    rows: DataFrame,
    classified: DataFrame | None = None,
    splits: Sequence[str] = SPLITS,
    labels: Sequence[str] = LABELS,
    wide: DataFrame | None = None,
    counted: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row with every count and mean of the manifest as a column of its own.

    Mean lengths of an empty split are 0. Rows are the final rows with a split,
    classified the rows before dropping and wide the families before that (for the drop
    counters; families without an id are only in wide). counted holds drop counters that
    are known already, so that neither is read.
    """
    # Written as SQL text: one call per cell instead of a dozen keeps planning short.
    cells = ["count(*) AS total_rows", "count(DISTINCT family_id) AS total_families"]
    for s in splits:
        inside = f"split = {_quoted(s)}"
        cells.append(f"count_if({inside}) AS `{_cell(s)}`")
        cells += [f"count_if({inside} AND label = {_quoted(l)}) AS `{_cell(s, l)}`" for l in labels]
        cells += [
            f"coalesce(round(avg(CASE WHEN {inside} THEN {length} END), 2), 0D) AS `{mean}_{s}`"
            for mean, length in zip(_MEANS, _LENGTHS)
        ]
    counts = rows.agg(*map(F.expr, cells))
    if counted is not None:
        dropped = {r: F.lit(counted.get(r, 0)).cast("long") for r in DROP_REASONS}
        classified = wide = None
    elif classified is None:
        dropped = {r: F.lit(0).cast("long") for r in DROP_REASONS}
    else:
        reasons = ", ".join(f"'{r}', count_if(drop_reason = '{r}')" for r in DROP_REASONS)
        found = classified.agg(F.expr(f"named_struct({reasons})")).scalar()
        dropped = {r: found[r] for r in DROP_REASONS}
    if wide is not None:
        dropped["missing_family_id"] = wide.agg(F.expr("count_if(family_id = '')")).scalar()
    return counts.select("*", *[dropped[r].alias(f"dropped_{r}") for r in DROP_REASONS])


def manifest_tidy(
    wide: DataFrame, splits: Sequence[str] = SPLITS, labels: Sequence[str] = LABELS
) -> DataFrame:
    """The manifest as (metric, split, label, value) rows."""

    def row(metric, split, label, column):
        key = ", ".join(map(_quoted, (metric, split, label)))
        return f"{key}, CAST(`{column}` AS DOUBLE)"

    cells = [row("total_rows", "", "", "total_rows"), row("total_families", "", "", "total_families")]
    for s in splits:
        cells.append(row("rows_per_split", s, "", _cell(s)))
        cells += [row("rows_per_label_per_split", s, l, _cell(s, l)) for l in labels]
        cells += [row(mean, s, "", f"{mean}_{s}") for mean in _MEANS]
    cells += [row("num_dropped_rows", "", r, f"dropped_{r}") for r in DROP_REASONS]
    return wide.selectExpr(f"stack({len(cells)}, {', '.join(cells)}) AS (metric, split, label, value)")


def manifest_cells(
    rows: DataFrame, dropped: Mapping[str, int] | None = None, splits: Sequence[str] = SPLITS,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """The rows of manifest_tidy by grouping sets, for domains of any size.

    One aggregation per (split, label) with families told apart by the same pass; totals
    and splits are grouping sets over its few rows. The plan does not grow with the
    domains. dropped holds the drop counters of the build.
    """
    spark = rows.sparkSession
    # One row per family in a cell first, so that distinct families need no second pass.
    per_family = rows.groupBy("family_id", "split", "label").agg(
        F.count("*").alias("n"), F.sum(F.col(_LENGTHS[0]).cast("long")).alias("chars"), F.sum(F.col(_LENGTHS[1]).cast("long")).alias("words"))
    smallest = F.min(F.struct("split", "label")).over(Window.partitionBy("family_id"))
    marked = per_family.withColumn(
        "first", F.col("family_id").isNotNull() & F.struct("split", "label").eqNullSafe(smallest))
    census = marked.groupBy("split", "label").agg(
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("words").alias("words"), F.count_if("first").alias("families"))
    sets = census.groupingSets([[], ["split"], ["split", "label"]], "split", "label").agg(
        F.grouping_id().alias("level"), F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("words").alias("words"),
        F.sum("families").alias("families"))

    def mean(total: str) -> Column:
        return F.round(F.col(total) / F.col("n"), 2)

    def cell(metric: str, value: Column | str) -> Column:
        return F.struct(F.lit(metric).alias("metric"), F.col(value).cast("double").alias("value") if isinstance(value, str) else value.cast("double").alias("value"))

    total, split, label = 3, 1, 0
    metrics = (
        F.when(F.col("level") == total, F.array(cell("total_rows", "n"), cell("total_families", "families")))
        .when(F.col("level") == split, F.array(
            cell("rows_per_split", "n"), cell(_MEANS[0], mean("chars")), cell(_MEANS[1], mean("words"))))
        .when(F.col("level") == label, F.array(cell("rows_per_label_per_split", "n"))))
    found = sets.select("split", "label", F.inline(metrics)).select(
        "metric", F.coalesce("split", F.lit("")).alias("split"), F.coalesce("label", F.lit("")).alias("label"), "value")
    domain = [("total_rows", "", ""), ("total_families", "", "")]
    domain += [(m, s, "") for s in splits for m in ("rows_per_split", *_MEANS)]
    domain += [("rows_per_label_per_split", s, l) for s in splits for l in labels]
    counters = [("num_dropped_rows", "", r, float((dropped or {}).get(r, 0))) for r in DROP_REASONS]
    expected = literal_rows(spark, ["metric", "split", "label"], domain)
    cells = expected.join(found, ["metric", "split", "label"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))
    return cells.unionByName(literal_rows(spark, ["metric", "split", "label", "value"], counters))


def _map(entries: Mapping[str, Column]) -> Column:
    return F.create_map(*[x for key, value in entries.items() for x in (F.lit(key), value)])


def manifest_record(
    wide: DataFrame,
    families_hash: Column,
    seed: int = DEFAULT_SEED,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    splits: Sequence[str] = SPLITS,
    labels: Sequence[str] = LABELS,
) -> DataFrame:
    """The manifest as one nested row, ready for the JSON sink."""
    return wide.select(
        utc_now().alias("created_at_utc"),
        F.lit(seed).cast("long").alias("seed"),
        _map({s: F.lit(float(r)) for s, r in ratios.items()}).alias("split_ratios"),
        "total_rows",
        "total_families",
        _map({s: F.col(_cell(s)) for s in splits}).alias("rows_per_split"),
        _map({s: _map({l: F.col(_cell(s, l)) for l in labels}) for s in splits}).alias(
            "rows_per_label_per_split"
        ),
        *[_map({s: F.col(f"{mean}_{s}") for s in splits}).alias(mean) for mean in _MEANS],
        _map({r: F.col(f"dropped_{r}") for r in DROP_REASONS}).alias("num_dropped_rows"),
        families_hash.alias("families_hash_sha1"),
    )


def tidy_from_record(record: DataFrame) -> DataFrame:
    """(metric, split, label, value) rows of nested manifest rows."""

    def tidy(metric, split, label, value):
        return [
            F.lit(metric).alias("metric"), split.alias("split"),
            label.alias("label"), value.cast("double").alias("value"),
        ]

    none = F.lit("")
    parts = [
        record.select(*tidy(metric, none, none, F.col(metric)))
        for metric in ("total_rows", "total_families")
    ]
    for metric in ("rows_per_split", *_MEANS):
        cells = record.select(F.explode(metric).alias("k", "v"))
        parts.append(cells.select(*tidy(metric, F.col("k"), none, F.col("v"))))
    nested = record.select(F.explode("rows_per_label_per_split").alias("s", "m")).select(
        "s", F.explode("m").alias("k", "v")
    )
    parts.append(nested.select(*tidy("rows_per_label_per_split", F.col("s"), F.col("k"), F.col("v"))))
    drops = record.select(F.explode("num_dropped_rows").alias("k", "v"))
    parts.append(drops.select(*tidy("num_dropped_rows", none, F.col("k"), F.col("v"))))
    return reduce(DataFrame.unionByName, parts)


def reconcile(
    actual: DataFrame,
    declared: DataFrame,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    length_tolerance: float = 0.1,
    ratio_tolerance: float = 0.02,
) -> DataFrame:
    """Compare tidy manifests: counts must agree exactly (error), mean lengths and split
    ratios within a tolerance (warning)."""
    exact = ("total_rows", "rows_per_split", "rows_per_label_per_split")
    key = ["metric", "split", "label"]
    left = actual.filter(F.col("metric").isin(*exact, *_MEANS)).withColumnRenamed("value", "actual")
    right = declared.filter(F.col("metric").isin(*exact, *_MEANS)).withColumnRenamed("value", "declared")
    is_mean = F.col("metric").isin(*_MEANS)
    close = F.abs(F.col("actual") - F.col("declared")) < length_tolerance
    matched = F.when(is_mean, F.coalesce(close, F.lit(False))).otherwise(
        F.col("actual").eqNullSafe(F.col("declared"))
    )
    metrics = left.join(right, key, "full_outer").select(
        *key, "actual", "declared",
        F.when(is_mean, "warning").otherwise("error").alias("severity"), matched.alias("matched"),
    )
    total = F.max(F.when(F.col("metric") == "total_rows", F.col("value")))
    per_split = [
        F.max(F.when((F.col("metric") == "rows_per_split") & (F.col("split") == s), F.col("value")))
        for s in ratios
    ]
    shares = actual.agg(*[(n / F.nullif(total, F.lit(0.0))).alias(s) for n, s in zip(per_split, ratios)])
    ratio_rows = shares.select(F.inline(F.array(*[
        F.struct(
            F.lit("split_ratio").alias("metric"), F.lit(s).alias("split"), F.lit("").alias("label"),
            F.col(s).alias("actual"), F.lit(float(r)).alias("declared"),
        )
        for s, r in ratios.items()
    ]))).select(
        "*", F.lit("warning").alias("severity"),
        F.coalesce(F.abs(F.col("actual") - F.col("declared")) < ratio_tolerance, F.lit(False)).alias("matched"),
    )
    return metrics.unionByName(ratio_rows).select(
        *key, "actual", "declared", "severity",
        F.when(F.col("matched"), "ok").otherwise(F.col("severity")).alias("status"),
    )
