"""TF-IDF with document-frequency limits and a capped vocabulary.

Term statistics need one shuffle keyed by the term. Tokens are put together and counted as
numbers inside the map tasks (grams.py), so a term leaves its task once for many texts.
Statistics are staged, as is the vocabulary, which later passes read. Where a vocabulary is
small, rows are weighed by themselves, without a shuffle; otherwise terms meet it in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.functions import text as tx
from corpuswright.operators import grams
from corpuswright.operators.selection import first_per_group, number_digits, text_digits
from corpuswright.sources.staging import remove, stage

# A vocabulary is broadcast up to this many rows, a few tens of megabytes.
_BROADCAST_TERMS = 200_000
# Bytes of the terms that a task looks up by itself, and rows of a batch that it sends.
_LOOKUP_BYTES, _BATCH_ROWS = 64 << 20, 65_536


@dataclass(frozen=True)
class TfidfConfig:
    ngram_range: tuple[int, int] = (1, 2)
    max_features: int | None = 20_000
    min_df: int = 2
    max_df: float = 0.95
    sublinear_tf: bool = True
    strip_accents: bool = True
    stop_words: tuple[str, ...] = ()


def tokens(text: Column, config: TfidfConfig) -> Column:
    return tx.remove_words(tx.analyzer_tokens(text, accents=not config.strip_accents), config.stop_words)


def terms(text: Column, config: TfidfConfig) -> Column:
    return tx.ngrams(tokens(text, config), *config.ngram_range)


def with_terms(rows: DataFrame, config: TfidfConfig = TfidfConfig()) -> DataFrame:
    """Add the terms column, which the functions below use instead of splitting the text
    again; worth it for rows that are staged and read more than once."""
    return rows.select("*", tx.evaluate_once(terms(F.col("text"), config)).alias("terms"))


def _terms_of(rows: DataFrame, config: TfidfConfig) -> Column:
    return F.col("terms") if "terms" in rows.columns else terms(F.col("text"), config)


def counted_terms(terms: Column) -> Column:
    """(term, tf) of each distinct term of a row, so that a row sends no term twice."""

    @F.arrow_udf("array<struct<term:string,tf:bigint>>")
    def count(rows):
        import pyarrow as pa

        names, times, offsets, null = [], [], [0], []
        for row in rows.to_pylist():
            null.append(row is None)
            found = Counter(row or ())
            names.extend(found.keys())
            times.extend(found.values())
            offsets.append(len(names))
        entries = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(times, pa.int64())], ["term", "tf"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), entries, mask=pa.array(null, pa.bool_()))

    return count(terms)


def compact_term(term: Column) -> Column:
    """The term itself, or a prefix and digest of a very long one: at most 81 characters,
    which gives vocabularies a size bound. Terms contain no '#'."""
    return F.when(F.char_length(term) <= 80, term).otherwise(
        F.concat(F.substring(term, 1, 16), F.lit("#"), F.sha2(term, 256))
    )


def term_statistics(
    rows: DataFrame, config: TfidfConfig = TfidfConfig(), copies: str | None = None
) -> DataFrame:
    """(term, tf, df): occurrences and number of rows holding the term. A row counts as
    often as its copies column says."""
    return _statistics(rows, config, copies).filter("term IS NOT NULL")


def _statistics(rows: DataFrame, config: TfidfConfig, copies: str | None) -> DataFrame:
    """Term statistics; the null term counts the rows, so that one pass gives both."""
    counted = grouped_statistics(rows, config, copies=copies)
    return counted.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def grouped_statistics(
    rows: DataFrame, config: TfidfConfig, group: str | None = None, copies: str | None = None
) -> DataFrame:
    """(term, group, tf, df) of some rows each, to be summed up; the null term counts the rows.

    group names a column of numbers; a null one becomes -1.
    """
    known = "terms" in rows.columns
    low, high = (1, 1) if known else config.ngram_range
    units = F.col("terms") if known else tokens(F.col("text"), config)
    of_row = [F.lit(0) if group is None else F.coalesce(F.col(group), F.lit(-1)), F.lit(1) if copies is None else F.col(copies)]
    given = rows.select(units.alias("units"), of_row[0].cast("long").alias("group"),
                        F.coalesce(of_row[1].cast("long"), F.lit(0)).alias("times"))
    once = copies is None

    def count(batches):
        import pyarrow as pa

        def sent(names, own, tf, df):
            made = pa.RecordBatch.from_arrays(
                [names, pa.array(own, pa.int64()), pa.array(tf, pa.int64()), pa.array(df, pa.int64())], ["term", "group", "tf", "df"])
            return [made.slice(at, _BATCH_ROWS) for at in range(0, made.num_rows, _BATCH_ROWS)]

        for batch in batches:
            lists, own, times = batch.column(0), *(batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            groups, at = np.unique(own, return_inverse=True)
            yield from sent(pa.nulls(len(groups), pa.string()), groups, np.zeros(len(groups)), _whole(np.bincount(at, times)))
            for low_row, high_row in grams.slices(lists):
                part = slice(low_row, high_row)
                for found in grams.gram_counts(
                        lists.slice(low_row, high_row - low_row), low, high, own[part], None if once else times[part]):
                    yield from sent(*found)

    return given.mapInArrow(count, "term string, group long, tf long, df long")


def _whole(numbers: np.ndarray) -> np.ndarray:
    return np.rint(numbers).astype(np.int64)


def vocabulary(
    rows: DataFrame, config: TfidfConfig = TfidfConfig(), copies: str | None = None
) -> DataFrame:
    """(term, tf, df, idf) of the kept terms, as a staged table.

    Kept are terms within the document-frequency limits, the max_features most frequent
    of them by occurrences, ties by term. The rows are read once; the cut is found on
    counts of the frequencies, so no task sees all terms.
    """
    # Terms of too few rows, most of them all, are not written.
    counted = _statistics(rows, config, copies).filter(F.col("term").isNull() | (F.col("df") >= config.min_df))
    stats = stage(counted, "terms")
    known = stage(_kept_terms(stats, config), "vocabulary")
    remove(stats)
    return known


def _kept_terms(stats: DataFrame, config: TfidfConfig) -> DataFrame:
    counted = stats.filter("term IS NULL").agg(F.sum("df").alias("n")).first()["n"]
    n = F.lit(float(counted or 0))
    kept = stats.filter(F.col("term").isNotNull() & (F.col("df") >= config.min_df) & (F.col("df") <= n * config.max_df))
    if config.max_features is not None:
        largest = kept.agg(F.max("tf").alias("tf")).first()["tf"] or 0
        digits = [*number_digits(F.lit(largest) - F.col("tf"), largest), *text_digits(F.col("term"))]
        kept = first_per_group(kept, None, config.max_features, [F.desc("tf"), F.col("term")], digits)
    return kept.select("term", "tf", "df", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))


def lookup(occurrences: DataFrame, known: DataFrame, how: str = "inner") -> DataFrame:
    """Join occurrences (with a term column) to a vocabulary. A vocabulary of few rows,
    counted here, has keys of bounded length and is broadcast; otherwise both sides shuffle."""
    if known.limit(_BROADCAST_TERMS + 1).count() > _BROADCAST_TERMS:
        return occurrences.join(known, "term", how)
    keyed = known.withColumn("_term", compact_term(F.col("term"))).drop("term")
    return (
        occurrences.withColumn("_term", compact_term(F.col("term")))
        .join(F.broadcast(keyed), "_term", how).drop("_term")
    )


def weight_arrays(
    rows: DataFrame, known: DataFrame, config: TfidfConfig = TfidfConfig(), keys: Sequence[str] = ("id",), named: str = "term"
) -> DataFrame:
    """(*keys, entries): an array of (df, term, weight) per row, L2-normalised, in order of df and term.

    named is the column of known that stands for the term, for example a number of it.

    Rows without a known term are left out; rows that repeat the keys are weighed apart.
    Terms are counted within their row and meet it again in one shuffle by row.
    """
    placed = rows.withColumn("_row", F.monotonically_increasing_id())
    counted = placed.select("_row", *keys, F.inline(counted_terms(_terms_of(rows, config))))
    matched = lookup(counted, known.select("term", "df", "idf", F.col(named).alias("_name")))
    tf = F.col("tf").cast("double")
    raw = matched.select("_row", *keys, "df", F.col("_name").alias("term"), ((F.log(tf) + 1 if config.sublinear_tf else tf) * F.col("idf")).alias("raw"))
    gathered = raw.groupBy("_row", *keys).agg(F.sort_array(F.collect_list(F.struct("df", "term", "raw"))).alias("raw"))
    norm = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda total, e: total + e["raw"] * e["raw"]))
    # Once per row: in a plain column the norm would be summed up again for every term.
    normed = gathered.select(*keys, "raw", tx.evaluate_once(norm).alias("norm"))
    weighed = F.transform(
        "raw", lambda e: F.struct(e["df"].alias("df"), e["term"].alias("term"), (e["raw"] / F.col("norm")).alias("weight")))
    return normed.select(*keys, tx.evaluate_once(weighed).alias("entries"))


def term_weights(
    rows: DataFrame, known: DataFrame, config: TfidfConfig = TfidfConfig(), key: str = "id"
) -> DataFrame:
    """(id, term, df, weight): L2-normalised weights of the known terms of every row.

    Rows without a known term have no weights; rows that repeat an id are weighed apart.
    A small vocabulary is sent to the tasks, which weigh every row by itself.
    """
    held = None if "terms" in rows.columns else _held(known)
    if held is None:
        weighed = weight_arrays(rows, known, config, (key,)).select(key, F.inline("entries"))
    else:
        weighed = rows.select(key, F.inline(_weighing(rows, held, config)(tokens(F.col("text"), config))))
    return weighed.select(key, "term", "df", "weight")


def _held(known: DataFrame):
    """The vocabulary (df, term, idf) in that order as an Arrow table, None if it is large."""
    size = known.limit(_BROADCAST_TERMS + 1).agg(F.count("*").alias("n"), F.sum(F.octet_length("term")).alias("bytes")).first()
    if size["n"] > _BROADCAST_TERMS or (size["bytes"] or 0) > _LOOKUP_BYTES:
        return None
    return known.select("df", "term", "idf").toArrow().combine_chunks().sort_by([("df", "ascending"), ("term", "ascending")])


def _weighing(rows: DataFrame, held, config: TfidfConfig):
    words = held.column("term").to_pylist()
    shared = rows.sparkSession.sparkContext.broadcast((
        grams.Vocabulary(words), words, held.column("df").to_numpy(), held.column("idf").to_numpy()))

    @F.arrow_udf("array<struct<df:bigint,term:string,weight:double>>")
    def weigh(lists):
        import pyarrow as pa

        vocabulary, words, dfs, idf = shared.value
        names, made = pa.array(words, pa.string()), []
        for low, high in grams.slices(lists) if len(lists) else [(0, 0)]:
            part = lists.slice(low, high - low)
            at, terms, times = vocabulary.counts(part, *config.ngram_range)
            weights = grams.unit_weights(at, times, idf[terms], len(part), config.sublinear_tf)
            entries = pa.StructArray.from_arrays(
                [pa.array(dfs[terms], pa.int64()), names.take(pa.array(terms)), pa.array(weights)], ["df", "term", "weight"])
            made.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(at, np.arange(len(part) + 1)), pa.int32()), entries))
        return pa.concat_arrays(made)

    return weigh
