"""The corpus build as one job: raw records to split, deduplicated rows and a manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from corpuswright.operators import dedup, families, manifest, split, validation
from corpuswright.schema import (
    DEFAULT_RATIOS, DEFAULT_SEED, DROP_REASONS, LABELS, MAX_TEXT_CHARS, ROW_FIELDS, SOURCES,
)
from corpuswright.sources import writers
from corpuswright.sources.staging import stage


@dataclass(frozen=True)
class Corpus:
    rows: DataFrame
    classified: DataFrame
    wide: DataFrame
    # Dropped rows by reason, where the rows were staged.
    dropped: Mapping[str, int] | None = None

    def manifest_wide(self, labels: Sequence[str] = LABELS) -> DataFrame:
        return manifest.manifest_wide(self.rows, self.classified, labels=labels, wide=self.wide, counted=self.dropped)


def _counted_stage(wide: DataFrame, max_chars: int | None) -> tuple[DataFrame, dict[str, int]]:
    """Classify and stage the rows; the drop counters are read from one column of what was written.

    Families without an id leave a row with their reason in the staged table, so the input
    is not read again for them.
    """
    staged = stage(families.classify_rows(wide, max_chars=max_chars, keep_missing=True), "classified")
    found = {r["drop_reason"]: r["count"] for r in staged.groupBy("drop_reason").count().collect()}
    dropped = {r: found.get(r, 0) for r in (*DROP_REASONS, "null_or_blank")}
    dropped["classified"] = sum(found.values()) - dropped["missing_family_id"]
    return staged.filter("drop_reason IS DISTINCT FROM 'missing_family_id'"), dropped


def build_corpus(
    raw: DataFrame,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    seed: int = DEFAULT_SEED,
    max_chars: int | None = MAX_TEXT_CHARS,
    deduplicate: str = "within_split",
    staged: bool = False,
) -> Corpus:
    """Normalise, drop, split by family and remove duplicates.

    staged writes the normalised rows once, so that the split reads only their family
    ids and nothing is normalised twice; use it on large inputs.
    deduplicate is within_split, global (before the split) or none.
    """
    wide = families.families(raw)
    classified = families.classify_rows(wide, max_chars=max_chars)
    dropped = None
    if staged:
        classified, dropped = _counted_stage(wide, max_chars)
        kept = classified.filter(F.col("drop_reason").isNull()).select(*ROW_FIELDS)
    else:
        kept = families.materialize_rows(wide, max_chars=max_chars)
    if deduplicate == "global":
        kept = dedup.dedup_global(kept)
    rows = split.split_by_group(kept, ratios, seed)
    if deduplicate == "within_split":
        rows = dedup.dedup_within_split(rows)
    return Corpus(rows, classified, wide, dropped)


def require_valid(checks: DataFrame) -> None:
    """Raise when a check of severity error fails. There are a few dozen check rows."""
    failed = checks.filter((F.col("severity") == "error") & (F.col("status") != "ok")).collect()
    if failed:
        names = ", ".join(f"{c['check']}[{c['split']}]={c['actual']}" for c in failed)
        raise validation.CorpusInvalid(names)


def write_corpus(
    raw: DataFrame,
    path: str,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    seed: int = DEFAULT_SEED,
    sources: Sequence[str] = SOURCES,
    file_format: str = "json",
    strict: bool = True,
) -> DataFrame:
    """Build, validate and write a corpus and its manifest below path; returns the rows.

    The input is read once: drop reasons and row rules are counted on the staged rows. Leakage and invalid rows stop a strict build before anything is written.
    """
    corpus = build_corpus(raw, ratios, seed, staged=True)
    rows = stage(corpus.rows, "corpus")
    if strict:
        require_valid(validation.validate_build(rows, sources=sources))
    writers.write_splits(rows, f"{path}/rows", file_format)
    counts = manifest.manifest_wide(rows, counted=corpus.dropped)
    digest = manifest.fingerprint(rows).select("families_hash_sha1").scalar()
    writers.write_record(manifest.manifest_record(counts, digest, seed, ratios), f"{path}/manifest")
    return rows
