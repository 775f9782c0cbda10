"""Raw records to families, families to one row per text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from corpuswright.functions import text as tx
from corpuswright.functions.scalar import literal_rows
from corpuswright.schema import DROP_REASONS, LABELS, MAX_TEXT_CHARS, RAW_TEXT_FIELDS, ROW_FIELDS


def families(raw: DataFrame, text_fields: Mapping[str, str] = RAW_TEXT_FIELDS) -> DataFrame:
    """One wide row per usable raw record: family_id, source and a text column per label.

    Records without idx or source are left out; idx 0 is a valid id.
    """
    source = F.lower(F.coalesce(F.col("dataset_source"), F.lit("")))
    return (
        raw.filter(F.col("idx").isNotNull() & (source != ""))
        .select(
            F.concat_ws("_", source, F.col("idx")).alias("family_id"),
            source.alias("source"),
            *[F.col(f"`{field}`").alias(label) for field, label in text_fields.items()],
        )
    )


def unpivot_families(wide: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """One row per family and label, absent texts included."""
    return wide.unpivot(["family_id", "source"], list(labels), "label", "raw_text")


def classify_rows(
    wide: DataFrame,
    labels: Sequence[str] = LABELS,
    max_chars: int | None = MAX_TEXT_CHARS,
    keep_blank: bool = True,
    keep_missing: bool = False,
) -> DataFrame:
    """Normalised rows with a drop_reason, null for rows that stay.

    Null and blank texts carry the reason null_or_blank, or are filtered before the
    normalisation when keep_blank is off. Families without an id have no rows, or with
    keep_missing one row each, under the first label, with the reason missing_family_id.
    """
    if keep_missing:
        long = unpivot_families(wide, labels).filter((F.col("family_id") != "") | (F.col("label") == labels[0]))
    else:
        long = unpivot_families(wide.filter(F.col("family_id") != ""), labels)
    if not keep_blank:
        long = long.filter(~tx.is_blank(F.col("raw_text")))
    length = F.char_length("text")
    reason = F.when(F.col("family_id") == "", "missing_family_id") if keep_missing else F
    if keep_blank:
        reason = reason.when(tx.is_blank(F.col("raw_text")), "null_or_blank")
    reason = reason.when(F.col("text") == "", "empty_text")
    if max_chars is not None:
        reason = reason.when(length > max_chars, "too_long")
    return (
        long.select("*", tx.evaluate_once(tx.normalize_text(F.col("raw_text"))).alias("text"))
        .select(
            F.concat(F.col("family_id"), F.lit("__"), F.col("label")).alias("id"),
            "family_id",
            "source",
            "text",
            "label",
            tx.encode_label(F.col("label"), labels).alias("label_id"),
            length.cast("int").alias("text_len_char"),
            tx.word_count(F.col("text")).cast("int").alias("text_len_word"),
            reason.alias("drop_reason"),
        )
    )


def materialize_rows(
    wide: DataFrame, labels: Sequence[str] = LABELS, max_chars: int | None = MAX_TEXT_CHARS
) -> DataFrame:
    """The rows that survive normalisation and the length limit."""
    return (
        classify_rows(wide, labels, max_chars, keep_blank=False)
        .filter(F.col("drop_reason").isNull())
        .select(*ROW_FIELDS)
    )


def drop_counts(wide: DataFrame, classified: DataFrame) -> DataFrame:
    """Dropped rows by reason, reasons without drops included.

    missing_family_id counts families, the other reasons count texts.
    """
    reasons = (*DROP_REASONS, "null_or_blank")
    counts = classified.groupBy("drop_reason").agg(F.count("*").alias("n"))
    missing = wide.select(
        F.lit(DROP_REASONS[0]).alias("drop_reason"),
        F.when(F.col("family_id") == "", 1).otherwise(0).alias("m"),
    ).groupBy("drop_reason").agg(F.sum("m").alias("n"))
    domain = literal_rows(wide.sparkSession, ["drop_reason"], [(r,) for r in reasons])
    found = counts.filter(F.col("drop_reason").isNotNull()).unionByName(missing)
    return domain.join(found, "drop_reason", "left").select(
        "drop_reason", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def apply_length_policy(rows: DataFrame, policy: str, max_chars: int = MAX_TEXT_CHARS) -> DataFrame:
    """Treat texts over the limit: flag them, truncate them or remove them."""
    over = F.char_length("text") > max_chars
    if policy == "remove":
        return rows.filter(~over)
    flagged = rows.withColumn("over_length", over)
    if policy == "flag":
        return flagged
    if policy == "truncate":
        cut = flagged.withColumn("text", F.trim(F.substring("text", 1, max_chars)))
        return cut.withColumn("text_len_char", F.char_length("text").cast("int")).withColumn(
            "text_len_word", tx.word_count(F.col("text")).cast("int")
        )
    raise ValueError(f"unknown length policy {policy!r}")


def cap_rows(rows: DataFrame, max_rows: int | None, key: str = "id") -> DataFrame:
    """The first max_rows rows by key, all of them for None (a debugging aid)."""
    return rows if max_rows is None else rows.orderBy(key).limit(max_rows)
