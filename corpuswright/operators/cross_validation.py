"""Grid search over folds, without letting a fold's terms into its own vocabulary.

Every term is counted once, over all rows and within each fold; what a fold trains on is
the difference, so the vocabularies of all folds come from one pass over the texts. The
folds are fitted side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from corpuswright.operators import models, tfidf
from corpuswright.operators.selection import first_per_group, number_digits, text_digits
from corpuswright.operators.split import assign_folds
from corpuswright.schema import DEFAULT_SEED
from corpuswright.sources.staging import remove, stage


def complement_statistics(
    rows: DataFrame, folds: int, config: tfidf.TfidfConfig = tfidf.TfidfConfig(), least: int = 1,
) -> DataFrame:
    """(fold, term, tf, df, n): term statistics of the rows outside each fold.

    rows: text and fold, a number below folds. n counts the rows outside the fold. Terms
    that occur in one fold alone have no row for it, and terms with a df below least none at all.
    """
    parts = tfidf.grouped_statistics(rows.select("fold", "text"), config, "fold").withColumnRenamed("group", "fold")

    def outside(column: str, fold: int):
        return F.sum(F.when(F.col("fold") == fold, 0).otherwise(F.col(column)))

    wide = parts.groupBy("term").agg(*[outside(c, f).alias(f"{c}{f}") for f in range(folds) for c in ("tf", "df")])
    # Terms that are rare outside every fold, most of them all, are not written.
    common = F.greatest(*[F.col(f"df{f}") for f in range(folds)]) if folds > 1 else F.col("df0")
    staged = stage(wide.filter(F.col("term").isNull() | (common >= least)), "folds")
    sizes = staged.filter("term IS NULL").first()
    entries = F.array(*[
        F.struct(F.lit(f).alias("fold"), F.col(f"tf{f}").alias("tf"), F.col(f"df{f}").alias("df"),
                 F.lit(sizes[f"df{f}"] if sizes else 0).alias("n")) for f in range(folds)])
    return staged.filter("term IS NOT NULL").select("term", F.inline(entries)).filter(F.col("df") >= max(1, least)).select(
        "fold", "term", "tf", "df", "n")


def fold_vocabularies(rows: DataFrame, folds: int, config: tfidf.TfidfConfig = tfidf.TfidfConfig()) -> DataFrame:
    """(fold, term, tf, df, idf): the vocabulary of each fold's training rows, staged."""
    stats = complement_statistics(rows, folds, config, config.min_df)
    kept = stats.filter((F.col("df") >= config.min_df) & (F.col("df") <= F.col("n") * config.max_df))
    if config.max_features is not None:
        largest = kept.agg(F.max("tf").alias("tf")).first()["tf"] or 0
        digits = [*number_digits(F.lit(largest) - F.col("tf"), largest), *text_digits(F.col("term"))]
        kept = first_per_group(kept, "fold", config.max_features, [F.desc("tf"), F.col("term")], digits)
    known = stage(kept.select("fold", "term", "tf", "df", (F.log((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf")),
                  "vocabularies")
    remove(stats)
    return known


def cross_validate(
    rows: DataFrame, candidates: Mapping[str, Callable], folds: int = 5, config: tfidf.TfidfConfig = tfidf.TfidfConfig(),
    balanced: bool = True, seed: int = DEFAULT_SEED, parallelism: int = 2,
) -> DataFrame:
    """(candidate, fold, train_rows, terms, macro_f1), one row for each candidate and fold.

    candidates: by name, a function from the sum of training weights to an estimator.
    Folds never divide a family, and vectors, weights and models of a fold see nothing of
    its held-out rows. A fold without training or held-out rows is left out. parallelism
    folds are fitted at a time.
    """
    spark = rows.sparkSession
    folded = stage(assign_folds(rows, folds, seed).select("fold", "text", "label_id"), "folded")
    known = fold_vocabularies(folded, folds, config)
    sizes = {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}

    def run(fold: int) -> list[tuple]:
        vectors = models.vectors_of(known.filter(F.col("fold") == fold), config)
        train = models.weighted(vectors.transform(folded.filter(F.col("fold") != fold)), balanced)
        features = stage(train.select("features", "label_id", "weight").hint("rebalance"), "features")
        total = sum(sizes.values()) - sizes[fold]
        held_out = vectors.transform(folded.filter(F.col("fold") == fold))
        found = []
        for name, make in candidates.items():
            model = models.fit_classifier(make(float(total)), features)
            score = models.MacroF1().evaluate(model.transform(held_out))
            found.append((name, fold, total, len(vectors.terms), score))
        remove(features)
        return found

    usable = [f for f in sorted(sizes) if sum(sizes.values()) > sizes[f]]
    with ThreadPoolExecutor(max(1, parallelism)) as pool:
        scores = [row for found in pool.map(inheritable_thread_target(spark)(run), usable) for row in found]
    remove(folded)
    return spark.createDataFrame(scores, "candidate string, fold int, train_rows long, terms long, macro_f1 double")


def grid_scores(scores: DataFrame) -> DataFrame:
    """(candidate, folds, mean_macro_f1, std_macro_f1) of each grid point, best first."""
    return scores.groupBy("candidate").agg(
        F.count("*").alias("folds"), F.avg("macro_f1").alias("mean_macro_f1"), F.stddev("macro_f1").alias("std_macro_f1"),
    ).orderBy(F.desc("mean_macro_f1"), "candidate")
