"""The corpus audit: all statistics and leakage checks as one Markdown report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.operators import distributions, leakage, manifest, similarity
from corpuswright.schema import LABELS, SOURCES, SPLITS
from corpuswright.sources.staging import stage


def _section(number: int, title: str, header: Sequence[str], body: DataFrame, order: Sequence, cells: Sequence[Column]):
    """Report lines of one table: heading, column heads, then a line per row of body.

    Bodies are aggregates with a fixed small number of rows.
    """
    spark = body.sparkSession
    fixed = [f"## {title}", "", "| " + " | ".join(header) + " |", "|" + "---|" * len(header)]
    head = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.array(F.lit("0"), F.lit(f"{i:04d}")).alias("position"), F.lit(line).alias("line"))
        for i, line in enumerate(fixed)
    ])))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    table = body.select(F.array(F.lit("1"), *[F.col(c).cast("string") for c in order]).alias("position"), line.alias("line"))
    return head.unionByName(table).withColumn("section", F.lit(number))


def _number(column: str, decimals: int = 0) -> Column:
    return F.format_number(F.col(column), decimals)


def audit_report(
    rows: DataFrame, sources: Sequence[str] = SOURCES, labels: Sequence[str] = LABELS,
    splits: Sequence[str] = SPLITS, near_duplicates: DataFrame | None = None, reconciled: DataFrame | None = None,
) -> DataFrame:
    """(line_no, line) of the Markdown report. Every table holds measured values.

    near_duplicates are pairs of a similarity join, reported by their number and the most
    similar ones; reconciled are the checks of manifest.reconcile.
    """
    place = reduce(lambda c, s: c.when(F.col("split") == s[1], s[0]), enumerate(splits), F).otherwise(len(splits))
    families = distributions.families_per_split(rows)
    counts = rows.groupBy("split").agg(F.count("*").alias("rows"))
    everything = counts.unionByName(rows.agg(F.lit("all").alias("split"), F.count("*").alias("rows")))
    sizes = everything.join(families, "split").withColumn("place", place)
    classes = distributions.class_distribution(rows, labels, splits).withColumn("place", place)
    lengths = distributions.length_stats(rows).withColumn("place", place)
    origins = distributions.source_distribution(rows, sources, splits).withColumn("place", place)
    overlaps = (
        leakage.family_overlap(rows, splits).withColumn("check", F.lit("family"))
        .unionByName(leakage.exact_text_overlap(rows, splits).withColumn("check", F.lit("exact text")))
        .unionByName(leakage.caseless_text_overlap(rows, splits).withColumn("check", F.lit("text, any case")))
    )
    digest = manifest.fingerprint(rows)
    sections = [
        _section(1, "Splits", ["Split", "Rows", "Families"], sizes, ["place"],
                 [F.col("split"), _number("rows"), _number("families")]),
        _section(2, "Classes", ["Split", "Label", "Rows", "Share %"], classes, ["place", "label"],
                 [F.col("split"), F.col("label"), _number("n"), _number("pct", 2)]),
        _section(3, "Lengths", ["Split", "Measure", "Mean", "Median", "Std", "Min", "Max"], lengths,
                 ["metric", "place"],
                 [F.col("split"), F.col("metric"), _number("mean", 2), _number("median", 2),
                  _number("std", 2), _number("min"), _number("max")]),
        _section(4, "Sources", ["Split", "Source", "Rows", "Share %"], origins, ["place", "source"],
                 [F.col("split"), F.col("source"), _number("n"), _number("pct", 2)]),
        _section(5, "Overlap between splits", ["Check", "Splits", "Shared"], overlaps,
                 ["check", "left_split", "right_split"],
                 [F.col("check"), F.concat_ws("-", "left_split", "right_split"), _number("shared")]),
        _section(6, "Fingerprint", ["sha1", "sum"], digest, ["families_hash_sum"],
                 [F.coalesce("families_hash_sha1", F.lit("no family")), F.col("families_hash_sum")]),
    ]
    if near_duplicates is not None:
        pairs = stage(near_duplicates, "near-duplicates")
        cell = lambda column: F.translate(column, "|\n", "  ")
        sections += [
            _section(7, "Near duplicates between splits", ["Distinct pairs", "Row pairs"], similarity.pair_summary(pairs),
                     ["distinct_pairs"], [_number("distinct_pairs"), _number("row_pairs")]),
            _section(8, "Most similar pairs", ["Rank", "Similarity", "Left", "Right"],
                     similarity.pair_previews(pairs, rows).withColumn("place", F.format_string("%04d", "rank")), ["place"],
                     [F.col("rank").cast("string"), _number("similarity", 4),
                      F.concat_ws(": ", "left_id", cell("left_preview")), F.concat_ws(": ", "right_id", cell("right_preview"))]),
        ]
    if reconciled is not None:
        sections.append(_section(
            9, "Manifest", ["Metric", "Split", "Label", "Actual", "Declared", "Status"], reconciled, ["metric", "split", "label"],
            [F.col("metric"), F.col("split"), F.col("label"), _number("actual", 2), _number("declared", 2), F.col("status")]))
    return number_lines(reduce(DataFrame.unionByName, sections))


def number_lines(lines: DataFrame) -> DataFrame:
    """(line_no, line) in section order. A report has a few hundred lines."""
    everything = Window.partitionBy(F.lit(0)).orderBy("section", "position")
    return lines.select(F.row_number().over(everything).alias("line_no"), "line")


def run_report(results: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """(line_no, line) of a plain-text report per run record."""

    def fixed(column: Column, pattern: str = "%.4f") -> Column:
        return F.format_string(pattern, column)

    lines = [
        F.concat(F.lit("Run: "), F.col("model_name"), F.lit(" seed "), F.col("seed").cast("string")),
        F.concat(F.lit("share of right predictions "), fixed(F.col("accuracy"))),
        F.concat(F.lit("F1, mean over labels "), fixed(F.col("macro_f1"))),
        *[F.concat(F.lit(f"F1 {l}: "), fixed(F.try_element_at("per_class_f1", F.lit(l)))) for l in labels],
        *[
            F.concat(F.lit(f"Confusion {l}: "), F.array_join(
                F.transform(F.get("confusion_matrix", F.lit(i)), lambda n: F.format_string("%5d", n)), " "))
            for i, l in enumerate(labels)
        ],
        F.concat(F.lit("fitted in "), fixed(F.col("train_time_sec"), "%.2f"), F.lit(" s")),
        F.concat(F.lit("predicted "), fixed(F.col("rows_per_sec"), "%.1f"), F.lit(" rows/s")),
    ]
    exploded = results.select(
        F.concat_ws("/", "model_name", F.col("seed").cast("string")).alias("section"),
        F.posexplode(F.array(*lines)).alias("n", "line"),
    )
    return number_lines(exploded.select("section", F.array(F.format_string("%04d", "n")).alias("position"), "line"))
