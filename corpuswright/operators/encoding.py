"""Fixed-length integer encodings of texts over a corpus vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from corpuswright.functions import text as tx
from corpuswright.operators import tfidf

PAD, UNKNOWN, START, END = 0, 1, 2, 3
_FIRST_ID = 4


def token_ids(rows: DataFrame, max_tokens: int = 20_000, min_count: int = 1) -> DataFrame:
    """(term, token_id) of the most frequent tokens, numbered by frequency, ties by term."""
    config = tfidf.TfidfConfig(
        ngram_range=(1, 1), max_features=max_tokens, min_df=min_count, max_df=1.0, strip_accents=False
    )
    frequent = tfidf.vocabulary(rows, config)
    by_frequency = Window.partitionBy(F.lit(0)).orderBy(F.desc("tf"), "term")
    return frequent.select(
        "term", (F.row_number().over(by_frequency) + (_FIRST_ID - 1)).alias("token_id")
    )


def encode_fixed(
    rows: DataFrame, vocabulary: DataFrame, max_length: int = 256, max_tokens: int = 20_000,
    key: str = "id",
) -> DataFrame:
    """(id, input_ids, attention_mask) of exactly max_length entries each, over a
    vocabulary of at most max_tokens rows, which is broadcast. Every row is encoded by
    itself, rows that repeat an id too.

    Start and end marks enclose at most max_length - 2 tokens, padding follows; tokens
    outside the vocabulary become the unknown id.
    """
    known = {r.term: r.token_id for r in vocabulary.select("term", "token_id").limit(max_tokens + 1).collect()}
    if len(known) > max_tokens:
        raise ValueError(f"the vocabulary has more than {max_tokens} terms")
    shared = rows.sparkSession.sparkContext.broadcast(known)

    @F.arrow_udf("array<int>")
    def ids_of(tokens):
        import pyarrow as pa
        import pyarrow.compute as pc

        terms, numbers = pa.array(shared.value.keys(), pa.string()), pa.array(shared.value.values(), pa.int32())
        found = pc.index_in(tokens.flatten(), value_set=terms)
        ids = pc.fill_null(numbers.take(found), UNKNOWN)
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        offsets = pa.array([0, *lengths.cumsum().tolist()], pa.int32())
        return pa.ListArray.from_arrays(offsets, ids)

    tokens = tx.analyzer_tokens(F.col("text"), accents=True)
    encoded = rows.select(key, ids_of(F.slice(tokens, 1, max_length - 2)).alias("ids"))
    marked = F.concat(F.array(F.lit(START)), F.col("ids"), F.array(F.lit(END)))
    missing = F.lit(max_length) - F.size("ids") - 2
    return encoded.select(
        key,
        F.concat(marked, F.array_repeat(F.lit(PAD), missing)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size("ids") + 2), F.array_repeat(F.lit(0), missing)).alias(
            "attention_mask"
        ),
    )
