"""Classification metrics over prediction tables (y_true, y_pred as class numbers).

The confusion matrix is one aggregation with a fixed set of cells, so each task sends
one row per run and absent cells are zero; every other metric derives from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.functions import text as tx
from corpuswright.functions.scalar import ratio, utc_now
from corpuswright.schema import LABELS, LENGTH_BUCKETS, RESULTS_COLUMNS

RUN = ("model_name", "seed")


def confusion_matrix(
    predictions: DataFrame, by: Sequence[str] = RUN, classes: int = len(LABELS), weight: str | None = None
) -> DataFrame:
    """(by, y_true, y_pred, n) with every cell of the matrix, rows are true classes."""
    n = F.lit(1) if weight is None else F.col(weight)

    def cell(t: int, p: int) -> Column:
        return F.sum(F.when((F.col("y_true") == t) & (F.col("y_pred") == p), n).otherwise(0)).cast("long")

    pairs = [(t, p) for t in range(classes) for p in range(classes)]
    counted = predictions.groupBy(*by).agg(*[cell(t, p).alias(f"c{t}_{p}") for t, p in pairs])
    return counted.select(*by, F.inline(F.array(*[
        F.struct(F.lit(t).alias("y_true"), F.lit(p).alias("y_pred"), F.col(f"c{t}_{p}").alias("n"))
        for t, p in pairs
    ])))


def confusion_wide(confusion: DataFrame, by: Sequence[str] = RUN, labels: Sequence[str] = LABELS) -> DataFrame:
    """The matrix with a column per predicted label and the true label as text."""
    return confusion.groupBy(*by, tx.decode_label(F.col("y_true"), labels).alias("label")).agg(
        *[F.sum(F.when(F.col("y_pred") == i, F.col("n")).otherwise(0)).alias(l) for i, l in enumerate(labels)]
    )


def per_class_metrics(
    confusion: DataFrame, by: Sequence[str] = RUN, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Precision, recall, F1 and support for every label; undefined ratios are 0."""
    t, p, n = F.col("y_true"), F.col("y_pred"), F.col("n")
    none = F.lit(0).cast("long")

    def role(of: Column, support: Column, predicted: Column, tp: Column) -> Column:
        return F.struct(
            of.alias("class"), support.alias("support"), predicted.alias("predicted"), tp.alias("tp")
        )

    roles = confusion.select(*by, F.inline(F.array(
        role(t, n, none, F.when(t == p, n).otherwise(none)), role(p, none, n, none),
    )))
    sums = roles.groupBy(*by, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp")
    )
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    return sums.select(
        *by, tx.decode_label(F.col("class"), labels).alias("label"),
        ratio(tp, predicted).alias("precision"), ratio(tp, support).alias("recall"),
        ratio(2 * tp, support + predicted).alias("f1"), "support", "predicted", "tp",
    )


def summary(per_class: DataFrame, by: Sequence[str] = RUN, labels: Sequence[str] = LABELS) -> DataFrame:
    """Accuracy, macro averages over the labels that occur, and F1 per label."""
    occurs = F.col("support") + F.col("predicted") > 0

    def macro(column: str) -> Column:
        return F.coalesce(F.avg(F.when(occurs, F.col(column))), F.lit(0.0))

    return per_class.groupBy(*by).agg(
        F.sum("support").alias("n"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        macro("f1").alias("macro_f1"),
        macro("precision").alias("precision_macro"),
        macro("recall").alias("recall_macro"),
        *[F.max(F.when(F.col("label") == l, F.col("f1"))).alias(f"f1_{l}") for l in labels],
    )


def evaluate(
    predictions: DataFrame, by: Sequence[str] = RUN, labels: Sequence[str] = LABELS,
    weight: str | None = None,
) -> DataFrame:
    """Summary metrics straight from predictions."""
    confusion = confusion_matrix(predictions, by, len(labels), weight)
    return summary(per_class_metrics(confusion, by, labels), by, labels)


def classification_report(
    per_class: DataFrame, by: Sequence[str] = RUN, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Rows per label, then accuracy, macro and weighted averages."""
    columns = ["precision", "recall", "f1"]
    occurs = F.col("support") + F.col("predicted") > 0
    support = F.col("support")
    totals = per_class.groupBy(*by).agg(
        F.sum("support").alias("support"),
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.coalesce(F.avg(F.when(occurs, F.col(c))), F.lit(0.0)).alias(f"macro_{c}") for c in columns],
        *[ratio(F.sum(F.col(c) * support), F.sum("support")).alias(f"weighted_{c}") for c in columns],
    )

    def line(name: str, values: Sequence[Column]) -> Column:
        return F.struct(
            F.lit(name).alias("row"), *[v.alias(c) for v, c in zip(values, columns)], support.alias("support")
        )

    averages = totals.select(*by, F.inline(F.array(
        line("accuracy", [F.col("accuracy")] * 3),
        line("macro avg", [F.col(f"macro_{c}") for c in columns]),
        line("weighted avg", [F.col(f"weighted_{c}") for c in columns]),
    )))
    return per_class.select(*by, F.col("label").alias("row"), *columns, "support").unionByName(averages)


def length_stratified(
    predictions: DataFrame, by: Sequence[str] = RUN, buckets=LENGTH_BUCKETS, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Summary metrics per word-count bucket."""
    bucketed = predictions.withColumn("bucket", tx.length_bucket(F.col("text_len_word"), buckets))
    return evaluate(bucketed, [*by, "bucket"], labels)


def confused_pairs(
    confusion: DataFrame, by: Sequence[str] = RUN, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Wrong (true, predicted) pairs that occur, most frequent first, with their share of
    the errors of the run."""
    wrong = confusion.filter((F.col("y_true") != F.col("y_pred")) & (F.col("n") > 0))
    errors = F.sum("n").over(Window.partitionBy(*by))
    ordered = Window.partitionBy(*by).orderBy(F.desc("n"), "y_true", "y_pred")
    return wrong.select(
        *by, F.row_number().over(ordered).alias("rank"),
        tx.decode_label(F.col("y_true"), labels).alias("true_label"),
        tx.decode_label(F.col("y_pred"), labels).alias("pred_label"),
        "n", (F.col("n") / errors).alias("error_share"),
    )


def misclassified(
    predictions: DataFrame, limit: int = 100, key: str = "id", by: Sequence[str] = RUN
) -> DataFrame:
    """The first limit wrong predictions of each run by key."""
    wrong = predictions.filter(F.col("y_true") != F.col("y_pred"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(key, "y_true", "y_pred"))
    return wrong.withColumn("__place", place).filter(F.col("__place") <= limit).drop("__place")


def _buckets_of(score: Column) -> tuple[Column, Column]:
    """Two order-preserving bucket numbers of a score: its exponent with the leading 10
    bits of the mantissa, then the next 21 bits. The 21 bits left tell apart the scores of
    a narrow bucket, so whatever the scores a window sees a few million rows at most."""
    size = F.abs(score)
    exponent = F.when(size > 0, F.floor(F.log2(size))).otherwise(-2000)
    # Scaling by powers of two and taking off whole numbers are exact.
    scaled = F.when(size > 0, (size / F.pow(F.lit(2.0), exponent) - 1) * 2**10).otherwise(0.0)
    leading = F.floor(scaled)
    sign = F.signum(score)
    # Offsets make exponents positive, so that larger negative numbers sort lower.
    wide = (exponent + 2000) * 2**10 + leading
    return (sign * wide).cast("int"), (sign * F.floor((scaled - leading) * 2**21)).cast("int")


def auroc_one_vs_rest(
    predictions: DataFrame, by: Sequence[str] = RUN, classes: int = len(LABELS), scores: str = "scores"
) -> DataFrame:
    """AUROC of every class against the rest, ties counting half; null when a class has
    no rows or all of them.

    Wins are counted bottom-up: among equal scores, within narrow score buckets, within
    wide ones, then between the wide ones. Scores crowded near 1 still fall into many
    buckets, and no window spans the rows of a whole class.
    """
    per_class = predictions.select(*by, "y_true", F.posexplode(scores).alias("class", "score")).filter(
        F.col("class") < classes
    )
    wide, narrow = _buckets_of(F.col("score").cast("double"))
    keys = [*by, "class"]
    hit = F.col("y_true") == F.col("class")
    # -0.0 and 0.0 are one score.
    level = per_class.groupBy(*keys, (F.col("score").cast("double") + 0.0).alias("score")).agg(
        F.count_if(hit).alias("pos"), F.count_if(~hit).alias("neg")
    ).withColumn("wins", F.col("pos").cast("double") * F.col("neg") / 2).select(
        *keys, wide.alias("wide"), narrow.alias("narrow"), "score", "pos", "neg", "wins"
    )
    for group, order in (([*keys, "wide", "narrow"], "score"), ([*keys, "wide"], "narrow"), (keys, "wide")):
        before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        below = F.coalesce(F.sum("neg").over(before), F.lit(0))
        level = (
            level.withColumn("wins", F.col("wins") + F.col("pos").cast("double") * below)
            .groupBy(*group)
            .agg(F.sum("wins").alias("wins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        )
    possible = F.col("pos").cast("double") * F.col("neg")
    return level.select(*keys, (F.col("wins") / F.nullif(possible, F.lit(0.0))).alias("auroc"))


def auroc_macro(predictions: DataFrame, by: Sequence[str] = RUN, classes: int = len(LABELS)) -> DataFrame:
    """Mean one-versus-rest AUROC over the classes where it is defined."""
    return auroc_one_vs_rest(predictions, by, classes).groupBy(*by).agg(F.avg("auroc").alias("auroc_ovr"))


def run_result(
    predictions: DataFrame, timings: DataFrame, labels: Sequence[str] = LABELS
) -> DataFrame:
    """The standard record of every run: metrics, confusion matrix and efficiency.

    timings holds model_name, seed, train_time_sec, eval_time_sec, num_params, size_bytes.
    """
    run = list(RUN)
    confusion = confusion_matrix(predictions, run, len(labels))
    per_class = per_class_metrics(confusion, run, labels)

    def by_label(column: str) -> Column:
        entries = F.array_sort(F.collect_list(F.struct("label", column)))
        return F.map_from_entries(entries)

    maps = per_class.groupBy(*run).agg(
        by_label("f1").alias("per_class_f1"), by_label("precision").alias("per_class_precision"),
        by_label("recall").alias("per_class_recall"),
    )
    rows = confusion.groupBy(*run, "y_true").agg(
        F.array_sort(F.collect_list(F.struct("y_pred", "n"))).alias("cells")
    ).groupBy(*run).agg(F.array_sort(F.collect_list(F.struct("y_true", "cells"))).alias("lines"))
    matrix = rows.select(*run, F.transform(
        "lines", lambda line: F.transform(line["cells"], lambda cell: cell["n"])
    ).alias("confusion_matrix"))
    n, seconds = F.col("n"), F.col("eval_time_sec")
    return (
        summary(per_class, run, labels).join(maps, run).join(matrix, run)
        .join(auroc_macro(predictions, run, len(labels)), run).join(timings, run)
        .select(
            tx.slug(F.col("model_name")).alias("model_name"), "seed", n.alias("test_samples"),
            "accuracy", "macro_f1", "precision_macro", "recall_macro", "auroc_ovr",
            "per_class_f1", "per_class_precision", "per_class_recall", "confusion_matrix",
            "train_time_sec", (ratio(seconds, n) * 1000).alias("latency_ms"),
            ratio(n, seconds).alias("rows_per_sec"), "num_params",
            F.round(F.col("size_bytes") / F.lit(float(1 << 20)), 3).alias("model_size_mb"),
            utc_now().alias("timestamp_utc"),
        )
    )


def results_flat(results: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Run records as one flat row each, in the fixed column order of the results table."""
    flat = results.select("*", *[
        F.try_element_at("per_class_f1", F.lit(l)).alias(f"f1_{l}") for l in labels
    ])
    return flat.select(*RESULTS_COLUMNS)


def multi_seed(metrics: DataFrame, columns: Sequence[str], by: str = "model_name") -> DataFrame:
    """Mean, sample standard deviation and number of runs of every metric over seeds."""
    tidy = metrics.select(by, "seed", *[F.col(c).cast("double") for c in columns]).unpivot(
        [by, "seed"], list(columns), "metric", "value"
    )
    return tidy.groupBy(by, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.count("value").alias("runs")
    )


def pareto_frontier(results: DataFrame, cost: str, gain: str, key: str = "model_name") -> DataFrame:
    """Flag the rows that no other row beats on both a cost and a gain. The input is a
    table of model results, one row per model."""
    best = results.groupBy(cost).agg(F.max(gain).alias("best"))
    cheaper = Window.partitionBy(F.lit(0)).orderBy(cost).rowsBetween(Window.unboundedPreceding, -1)
    limits = best.withColumn("beaten_by", F.max("best").over(cheaper))
    on_top = (F.col(gain) == F.col("best")) & (F.col("beaten_by").isNull() | (F.col(gain) > F.col("beaten_by")))
    return results.join(limits, cost).select(key, cost, gain, on_top.alias("on_frontier"))


def per_class_by_model(
    per_class: DataFrame, metric: str = "f1", labels: Sequence[str] = LABELS, by: str = "model_name"
) -> DataFrame:
    """One metric per label and model, averaged over seeds, a column per label."""
    return per_class.groupBy(by).agg(
        *[F.avg(F.when(F.col("label") == l, F.col(metric))).alias(l) for l in labels]
    )


def perturbation_delta(
    baseline: DataFrame, perturbed: DataFrame, metric: str = "accuracy", key: str = "model_name"
) -> DataFrame:
    """Drop of a metric against the unperturbed run, per model and perturbation."""
    base = baseline.select(key, F.col(metric).alias("baseline"))
    return perturbed.select(key, "perturbation", F.col(metric).alias("perturbed")).join(base, key).select(
        key, "perturbation", "baseline", "perturbed", (F.col("perturbed") - F.col("baseline")).alias("delta")
    )


def best_epoch(history: DataFrame, metric: str = "macro_f1", by: str = "model_name") -> DataFrame:
    """The epoch with the best metric per model, the earliest on ties."""
    best = F.max(F.struct(F.col(metric).alias("value"), (-F.col("epoch")).alias("late")))
    return history.groupBy(by).agg(best.alias("best")).select(
        by, (-F.col("best.late")).alias("epoch"), F.col("best.value").alias(metric)
    )


def perturbations(text: Column, lexicon: dict[str, str]) -> dict[str, Column]:
    """The robustness perturbations of a text by name."""
    return {
        "lowercase": F.lower(text),
        "remove_punctuation": tx.remove_punctuation(text),
        "synonym_swap": tx.swap_synonyms(text, lexicon),
    }


def perturbed_rows(rows: DataFrame, lexicon: dict[str, str], column: str = "text") -> DataFrame:
    """Every row once per perturbation, with the name of the perturbation."""
    variants = perturbations(F.col(column), lexicon)
    return rows.withColumn("variant", F.explode(F.array(*[
        F.struct(F.lit(name).alias("perturbation"), value.alias("text")) for name, value in variants.items()
    ]))).withColumns({"perturbation": F.col("variant.perturbation"), column: F.col("variant.text")}).drop("variant")


