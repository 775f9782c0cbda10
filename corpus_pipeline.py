"""From raw documents to packed training sequences.

Each stage applies one operator to all documents that the stage before it kept. Stages
take (spark, docs, sf_dir); all but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpuswright.llm import decontamination, language, packing, simhash, toxicity
from corpuswright.llm.queries import table, tokenizer_file
from corpuswright.sources.staging import stage

# A language is rejected below this probability; with few languages chance alone gives as much.
MIN_LANGUAGE_SCORE = 0.35


def _aside(docs: DataFrame) -> DataFrame:
    """docs with names by place for all columns but text, which no operator's own names can meet."""
    return docs.toDF(*[c if c == "text" else f"__{i}" for i, c in enumerate(docs.columns)])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents of a language that the model names with some certainty.

    A null text and one without a letter have none and go. Without any labelled document
    there is no model to reject by, and all stay.
    """
    model = language.fit(docs)
    if model is None:
        return docs
    plain = _aside(docs)
    scored = language.identify(plain, model)
    kept = scored.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= MIN_LANGUAGE_SCORE))
    return kept.select(*plain.columns).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that are not predicted toxic; all of them where no label exists."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    plain = _aside(docs)
    return toxicity.score(plain, model).filter("predicted = 0").select(*plain.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest doc_id of each group of near duplicates.

    Rows that repeat a doc_id, or have none, are judged one by one like others.
    """
    return simhash.distinct_rows(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that contain no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 4096 tokens."""
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language), ("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated), ("best_fit_packing", pack_sequences),
]

# Trained models and XXH64 fingerprints are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
