"""Adapters from the provided tables to the schemas of the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpuswright.functions import text as tx
from corpuswright.operators.dedup import dedup_within_split
from corpuswright.operators.families import classify_rows, families, materialize_rows
from corpuswright.operators.split import split_by_group
from corpuswright.schema import LABELS, RAW_TEXT_FIELDS, SOURCES
from corpuswright.sources.readers import spread

RAW_FIELDS = list(RAW_TEXT_FIELDS)
ALL_SOURCES = (*SOURCES, *(f"src{i}" for i in range(20)))

# (model_name, seed, noise): predictions are wrong on about noise/256 of the rows.
RUNS = (
    ("linear/base", 1, 64), ("linear/base", 2, 80), ("forest", 1, 128), ("forest", 2, 120),
    ("centroid", 1, 200),
)
LEXICON = {"the": "that", "of": "from", "la": "una", "und": "oder", "de": "du"}
STOP_WORDS = ("the", "and", "of", "to", "in", "la", "de", "et", "und", "der", "die", "el", "que")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def chat_records(spark, sf) -> DataFrame:
    """One raw record per four turns of a conversation: they are the four texts."""
    turns = table(spark, sf, "conversations")
    part = F.floor(F.col("turn") / 4)
    return turns.groupBy("conv_id", part.alias("part")).agg(
        *[F.max(F.when(F.col("turn") % 4 == i, F.col("text"))).alias(f) for i, f in enumerate(RAW_FIELDS)]
    ).select(
        F.concat_ws(".", F.col("conv_id").cast("string"), F.col("part").cast("string")).alias("idx"),
        F.get(F.array(*map(F.lit, SOURCES)), (F.col("conv_id") % 3).cast("int")).alias("dataset_source"),
        *[f"`{f}`" for f in RAW_FIELDS],
    )


def document_records(spark, sf, idx: str = "doc_id") -> DataFrame:
    """One raw record per document: its text stands under field number doc_id % 4."""
    documents = spread(table(spark, sf, "documents").select("doc_id", "source", "text"))
    return documents.select(
        F.col(idx).cast("string").alias("idx"),
        F.col("source").alias("dataset_source"),
        *[F.when(F.col("doc_id") % 4 == i, F.col("text")).alias(f) for i, f in enumerate(RAW_FIELDS)],
    )


def raw_records(spark, sf) -> DataFrame:
    return chat_records(spark, sf).unionByName(document_records(spark, sf))


def wide(spark, sf) -> DataFrame:
    return families(raw_records(spark, sf))


def classified(spark, sf) -> DataFrame:
    return classify_rows(wide(spark, sf))


def rows(spark, sf) -> DataFrame:
    return materialize_rows(wide(spark, sf))


def all_rows(spark, sf) -> DataFrame:
    """Rows of any length."""
    return materialize_rows(wide(spark, sf), max_chars=None)


def split_rows(spark, sf) -> DataFrame:
    return split_by_group(rows(spark, sf))


def corpus(spark, sf) -> DataFrame:
    """The built corpus: split, then duplicates removed within each split."""
    return dedup_within_split(split_rows(spark, sf))


def leaky(spark, sf) -> DataFrame:
    """Rows split one by one instead of by family, which leaks families."""
    quarter = _byte(F.md5("id"), 0) % 4
    return rows(spark, sf).withColumn(
        "split", F.when(quarter < 2, "train").when(quarter == 2, "val").otherwise("test")
    )


def labelled(spark, sf) -> DataFrame:
    """Documents with the four classes of their quality and toxicity labels, split."""
    documents = spread(table(spark, sf, "documents").select("doc_id", "source", "text"))
    label_id = (F.col("quality") * 2 + F.col("toxic")).cast("int")
    joined = documents.join(table(spark, sf, "labels"), "doc_id").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("family_id"), "source",
        tx.decode_label(label_id, LABELS).alias("label"), label_id.alias("label_id"),
        tx.evaluate_once(tx.normalize_text(F.col("text"))).alias("text"),
    )
    groups = table(spark, sf, "labels").select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("family_id"))
    return split_by_group(joined.select(
        F.concat_ws("__", "family_id", "label").alias("id"), "family_id", "source", "text", "label",
        "label_id", F.char_length("text").cast("int").alias("text_len_char"),
        tx.word_count(F.col("text")).cast("int").alias("text_len_word"),
    ), groups=groups)


def _byte(digest: Column, position: int) -> Column:
    return F.conv(F.substring(digest, 2 * position + 1, 2), 16, 10).cast("int")


def noisy_class(key: Column, noise: Column | int) -> Column:
    """label_id, replaced by a hash-derived class on about noise/256 of the keys."""
    digest = F.md5(key)
    return F.when(_byte(digest, 0) < noise, _byte(digest, 1) % 4).otherwise(F.col("label_id")).cast("int")


def predictions(spark, sf) -> DataFrame:
    """Predictions of several runs for all rows, derived from row ids by hashing."""
    runs = F.inline(F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.lit(s).cast("long").alias("seed"), F.lit(n).alias("noise"))
        for m, s, n in RUNS
    ]))
    each = rows(spark, sf).select("id", "label", "label_id", "text_len_word", "text_len_char", runs)
    key = F.concat_ws(":", F.lit("p"), "model_name", F.col("seed").cast("string"), "id")
    digest = F.md5(key)
    bonus = [F.when(F.col("label_id") == c, 100).otherwise(0) for c in range(4)]
    return each.select(
        "model_name", "seed", "id", F.col("label_id").alias("y_true"),
        noisy_class(key, F.col("noise")).alias("y_pred"),
        F.array(*[(_byte(digest, 2 + c) + bonus[c]) / F.lit(256.0) for c in range(4)]).alias("scores"),
        "text_len_word", "text_len_char",
    )


def timings(predictions: DataFrame) -> DataFrame:
    """Run timings and sizes derived from the predicted rows."""
    return predictions.groupBy("model_name", "seed").agg(
        (F.sum("text_len_word") / 1000.0).alias("train_time_sec"),
        (F.count("*") / 500.0).alias("eval_time_sec"),
        (F.count_distinct("y_true") * 1001).alias("num_params"),
        F.sum("text_len_char").alias("size_bytes"),
    )
