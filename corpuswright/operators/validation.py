"""Data-quality checks as rows (check, severity, split, actual, expected, status)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from corpuswright.functions import text as tx
from corpuswright.functions.scalar import literal_rows
from corpuswright.operators import distributions, leakage
from corpuswright.schema import (
    LABELS, MAX_TEXT_CHARS, MIN_CLASS_SHARE, RAW_TEXT_FIELDS, SOURCES, SPLITS,
)


class CorpusInvalid(ValueError):
    """Raised by strict plans when a check of severity error fails."""


def _in_domain(column: str, domain: Sequence[str]) -> Column:
    return F.coalesce(F.col(column).isin(*domain), F.lit(False))


def row_rules(
    labels: Sequence[str] = LABELS, sources: Sequence[str] = SOURCES
) -> dict[str, Column]:
    """Conditions every final row must meet."""
    return {
        "text_not_blank": ~tx.is_blank(F.col("text")),
        "source_known": _in_domain("source", sources),
        "label_known": _in_domain("label", labels),
        "label_id_matches": tx.encode_label(F.col("label"), labels).eqNullSafe(F.col("label_id")),
    }


def contract_rules(
    labels: Sequence[str] = LABELS, max_chars: int = MAX_TEXT_CHARS
) -> dict[str, Column]:
    """Conditions of the per-row contract: ids present, text stripped and not too long,
    label given by name or by number."""
    named = [*labels, *[str(i) for i in range(len(labels))]]
    edge = f"^[{tx.ANY_SPACE}]|[{tx.ANY_SPACE}]$"
    return {
        "id_present": F.coalesce(F.col("id") != "", F.lit(False)),
        "family_present": F.coalesce(F.col("family_id") != "", F.lit(False)),
        "text_stripped": ~tx.is_blank(F.col("text")) & ~F.coalesce(F.col("text").rlike(edge), F.lit(True)),
        "label_known": _in_domain("label", named),
        "length_allowed": F.coalesce(F.char_length("text") <= max_chars, F.lit(False)),
    }


def _checks(counts: DataFrame, names: Sequence[str], severity: str) -> DataFrame:
    """One check row per column of a one-row frame of violation counts; expected is 0."""
    rows = counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("actual")) for n in names
    ])))
    return rows.select(
        "check", F.lit(severity).alias("severity"), F.lit("").alias("split"), "actual",
        F.lit(0).cast("long").alias("expected"),
        F.when(F.col("actual") == 0, "ok").otherwise("fail").alias("status"),
    )


def rule_violations(rows: DataFrame, rules: dict[str, Column], severity: str = "error") -> DataFrame:
    """Number of rows breaking each rule."""
    counts = rows.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return _checks(counts, list(rules), severity)


def with_failures(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add rule_failures: the names of the rules each row breaks."""
    broken = F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()])
    return rows.withColumn("rule_failures", F.array_compact(broken))


def quarantine(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Only the rows that break a rule."""
    return with_failures(rows, rules).filter(F.size("rule_failures") > 0)


def row_contract(
    rows: DataFrame, labels: Sequence[str] = LABELS, max_chars: int = MAX_TEXT_CHARS
) -> DataFrame:
    """Verdict of the per-row contract for every row."""
    checked = with_failures(rows, contract_rules(labels, max_chars))
    return checked.select("id", "split", "rule_failures", (F.size("rule_failures") == 0).alias("valid"))


def missing_labels(
    rows: DataFrame, labels: Sequence[str] = LABELS, splits: Sequence[str] = SPLITS
) -> DataFrame:
    """Labels of the domain without rows in a split: an error for train, else a warning."""
    domain = literal_rows(
        rows.sparkSession, ["split", "label"], [(s, l) for s in splits for l in labels]
    )
    present = rows.select("split", "label").distinct()
    return domain.join(present, ["split", "label"], "left_anti").select(
        "split", "label", F.when(F.col("split") == "train", "error").otherwise("warn").alias("severity")
    )


def family_leakage(rows: DataFrame, splits: Sequence[str] = SPLITS) -> DataFrame:
    """Families shared by split pairs, as check rows."""
    return leakage.family_overlap(rows, splits).select(
        F.lit("family_leakage").alias("check"), F.lit("error").alias("severity"),
        F.concat_ws("-", "left_split", "right_split").alias("split"), F.col("shared").alias("actual"),
        F.lit(0).cast("long").alias("expected"),
        F.when(F.col("shared") == 0, "ok").otherwise("fail").alias("status"),
    )


def label_coverage(
    rows: DataFrame, labels: Sequence[str] = LABELS, splits: Sequence[str] = SPLITS
) -> DataFrame:
    """Labels present per split, as check rows."""
    counts = rows.agg(*[
        F.count_if((F.col("split") == s) & (F.col("label") == l)).alias(f"{s}_{l}")
        for s in splits for l in labels
    ])
    found = counts.select(F.inline(F.array(*[
        F.struct(
            F.lit(s).alias("split"),
            sum(((F.col(f"{s}_{l}") > 0).cast("long") for l in labels), F.lit(0).cast("long")).alias("actual"),
        )
        for s in splits
    ])))
    return found.select(
        F.lit("label_coverage").alias("check"),
        F.when(F.col("split") == "train", "error").otherwise("warn").alias("severity"),
        "split", "actual", F.lit(len(labels)).cast("long").alias("expected"),
        F.when(F.col("actual") == len(labels), "ok").otherwise("fail").alias("status"),
    )


def split_integrity(
    rows: DataFrame, labels: Sequence[str] = LABELS, sources: Sequence[str] = SOURCES,
    splits: Sequence[str] = SPLITS, min_share: float = MIN_CLASS_SHARE,
) -> DataFrame:
    """Families, labels, class balance and repeated texts in one list of checks."""
    imbalance = distributions.imbalance_check(rows, labels, min_share).agg(
        F.count_if("imbalanced").alias("class_imbalance")
    )
    repeats = leakage.duplicate_texts(rows).agg(
        F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicate_texts")
    )
    return (
        family_leakage(rows, splits)
        .unionByName(rule_violations(rows, row_rules(labels, sources)))
        .unionByName(label_coverage(rows, labels, splits))
        .unionByName(_checks(imbalance, ["class_imbalance"], "warn"))
        .unionByName(_checks(repeats, ["duplicate_texts"], "warn"))
    )


def validate_build(
    rows: DataFrame, labels: Sequence[str] = LABELS, sources: Sequence[str] = SOURCES,
    splits: Sequence[str] = SPLITS,
) -> DataFrame:
    """The checks a build must pass: family leakage, row validity and label coverage."""
    return (
        family_leakage(rows, splits)
        .unionByName(rule_violations(rows, row_rules(labels, sources)))
        .unionByName(label_coverage(rows, labels, splits))
    )


def duplicate_ids(rows: DataFrame) -> DataFrame:
    """Ids that occur more than once."""
    return rows.groupBy("id").agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def duplicate_family_keys(wide: DataFrame, labels: Sequence[str] = tuple(RAW_TEXT_FIELDS.values())) -> DataFrame:
    """Families built from several raw records, and whether the records disagree."""
    texts = F.sha2(F.to_json(F.struct(*labels), {"ignoreNullFields": "false"}), 256)
    records = wide.groupBy("family_id", texts.alias("texts")).agg(F.count("*").alias("n"))
    return (
        records.groupBy("family_id")
        .agg(F.sum("n").alias("records"), F.count("*").alias("versions"))
        .filter(F.col("records") > 1)
        .select("family_id", "records", (F.col("versions") > 1).alias("conflicting"))
    )
