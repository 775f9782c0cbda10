import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpuswright.operators import distributions as dist, leakage, sampling, validation as val
from corpuswright.plans import audit
from corpuswright.sources import writers


def measured(spark, values, group="g"):
    return spark.createDataFrame([(group, "train", "T1", int(v)) for v in values],
                                 "g string, split string, label string, text_len_word int")


@pytest.mark.parametrize("values", [[3], [1, 1, 1], [1, 2, 3, 4, 100], list(range(1, 52)), [5, 5, 9, 9, 9, 30]])
def test_length_statistics(spark, values):
    rows = measured(spark, values)
    s = pd.Series(values)
    got = dist.length_stats(rows, ["text_len_word"], ["g"]).first()
    assert (got.n, got.min, got.max) == (len(values), s.min(), s.max())
    assert got.mean == pytest.approx(s.mean()) and got.median == s.median()
    assert got["std"] is None if len(values) == 1 else got["std"] == pytest.approx(s.std())

    bins = dist.histogram(rows, by=["g"]).collect()
    counts, edges = np.histogram(values, bins=50) if s.min() < s.max() else ([len(values)], None)
    assert [b.n for b in sorted(bins, key=lambda b: b.bin)] == [c for c in counts if c]

    box = dist.boxplot(rows, by=["g"]).first()
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    inside = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
    assert (box.q1, box.q3, box.whisker_low, box.whisker_high, box.outliers) == (
        q1, q3, inside.min(), inside.max(), len(s) - len(inside))

    curve = {r.value: r.ecdf for r in dist.ecdf(rows, by=["g"]).collect()}
    assert curve == {v: pytest.approx((s <= v).mean()) for v in set(values)}


def test_distributions_zero_fill(make_rows):
    rows = make_rows([("train", "f1", "T1", "a"), ("train", "f2", "T1", "b"), ("test", "f3", "T2", "c")])
    classes = {(r.split, r.label): (r.n, r.pct) for r in dist.class_distribution(rows).collect()}
    assert len(classes) == 12 and classes["train", "T1"] == (2, 100.0) and classes["val", "T3"] == (0, 0.0)
    sources = {(r.split, r.source): r.n for r in dist.source_distribution(rows, ["mrpc", "paws"]).collect()}
    assert sources["train", "mrpc"] == 2 and sources["val", "paws"] == 0
    flagged = {r.label: r.imbalanced for r in dist.imbalance_check(rows).collect()}
    assert flagged == {"T1": False, "T2": False, "T3": True, "T4": True}
    table = {r.label: (r.mrpc, r.paws) for r in dist.crosstab(rows, "label", "source", ["mrpc", "paws"]).collect()}
    assert table == {"T1": (2, 0), "T2": (1, 0)}
    assert {r.split: r.families for r in dist.families_per_split(rows).collect()} == {"train": 2, "test": 1, "all": 3}
    assert {r.split: r.families for r in dist.families_per_split(rows, True).collect()} == {"train": 2, "test": 1, "all": 3}
    weights = {r.label_id: r.weight for r in dist.class_weights(rows).collect()}
    assert weights == {0: pytest.approx(3 / 4), 1: pytest.approx(3 / 2)}
    assert dist.with_class_weights(rows).agg(F.sum("weight")).first()[0] == pytest.approx(3.0)


def test_leakage_counts(make_rows):
    rows = make_rows([
        ("train", "f1", "T1", "Same"), ("val", "f1", "T2", "same"), ("test", "f2", "T1", "Same"),
        ("train", "f3", "T1", "x"), ("test", "f3", "T2", "y"),
    ])
    pairs = lambda frame: {(r.left_split, r.right_split): r.shared for r in frame.collect()}
    assert pairs(leakage.family_overlap(rows)) == {("train", "val"): 1, ("train", "test"): 1, ("val", "test"): 0}
    assert pairs(leakage.exact_text_overlap(rows)) == {("train", "val"): 0, ("train", "test"): 1, ("val", "test"): 0}
    assert pairs(leakage.caseless_text_overlap(rows)) == {("train", "val"): 1, ("train", "test"): 1, ("val", "test"): 1}
    example = leakage.text_overlap_examples(rows).first()
    assert (example.left_split, example.right_split, example.preview, example["copies"]) == ("train", "test", "Same", 2)
    checks = {(c.check, c.split): c for c in val.split_integrity(rows).collect()}
    assert checks["family_leakage", "train-val"].status == "fail"
    assert checks["label_coverage", "train"].actual == 1 and checks["label_coverage", "train"].severity == "error"
    assert checks["label_coverage", "val"].severity == "warn"


def test_row_rules(spark, make_rows):
    rows = make_rows([("train", "f1", "T1", "ok"), ("train", "f2", "T9", "bad label"), ("train", "f3", "T1", " spaced ")])
    broken = {c.check: c.actual for c in val.rule_violations(rows, val.row_rules()).collect()}
    assert broken == {"text_not_blank": 0, "source_known": 0, "label_known": 1, "label_id_matches": 0}
    verdict = {r.id: list(r.rule_failures) for r in val.row_contract(rows).collect()}
    assert verdict == {"f1__T1": [], "f2__T9": ["label_known"], "f3__T1": ["text_stripped"]}
    assert [r.id for r in val.quarantine(rows, val.row_rules()).collect()] == ["f2__T9"]
    missing = {(r.split, r.label): r.severity for r in val.missing_labels(rows).collect()}
    assert missing["train", "T2"] == "error" and missing["val", "T1"] == "warn" and ("train", "T1") not in missing


def test_samples_do_not_depend_on_partitioning(make_rows):
    rows = make_rows([(s, f"f{i}", f"T{i % 4 + 1}", f"text {i}") for i in range(60) for s in [("train", "val", "test")[i % 3]]])
    for take in (
        lambda d: sampling.sample_per_group(d, "label", 5).select("id", "rank"),
        lambda d: sampling.sample_rows(d, 7).select("id"),
        lambda d: sampling.sample_splits(d, {"train": 4, "val": 2}).select("id"),
        lambda d: sampling.head_per_group(d).select("id", "rank"),
        lambda d: sampling.sample_fraction(d, 0.3).select("id"),
        lambda d: sampling.sample_stratified(d, {"T1": 1.0, "T2": 0.5}).select("id"),
    ):
        assert sorted(take(rows.repartition(1)).collect()) == sorted(take(rows.repartition(7)).collect())
    assert sampling.sample_per_group(rows, "label", 5).count() == 20
    assert sampling.sample_splits(rows, {"train": 4, "val": 2}).count() == 6
    assert sampling.sample_stratified(rows, {"T1": 1.0}).count() == 15


def test_report(spark, sf, make_rows, tmp_path):
    rows = make_rows([("train", "f1", "T1", "a b"), ("val", "f2", "T2", "a b")])
    report = audit.audit_report(rows)
    lines = [r.line for r in report.orderBy("line_no").collect()]
    assert lines[0] == "## Splits" and "| exact text | train-val | 1 |" in lines
    assert lines.index("| train | 1 | 1 |") < lines.index("| val | 1 | 1 |") < lines.index("| all | 2 | 2 |")
    writers.write_report(report, str(tmp_path / "r"))
    assert [r.value for r in spark.read.text(str(tmp_path / "r")).collect()] == lines


def test_report_of_near_duplicates_and_manifest(make_rows):
    from corpuswright.operators import manifest, similarity

    shared = " ".join(f"w{i}" for i in range(40))
    rows = make_rows([("train", "f1", "T1", shared + " a|b"), ("val", "f2", "T1", shared + " c"), ("test", "f3", "T1", "x")])
    cells = manifest.manifest_cells(rows)
    report = audit.audit_report(
        rows, near_duplicates=similarity.jaccard_pairs(rows), reconciled=manifest.reconcile(cells, cells))
    lines = [r.line for r in report.orderBy("line_no").collect()]
    at = lines.index("## Near duplicates between splits")
    assert lines[at + 4] == "| 1 | 1 |" and lines[at + 5] == "## Most similar pairs"
    assert lines[at + 9].startswith("| 1 | 0.9524 | f1__T1: w0 w1") and lines[at + 9].count(" | ") == 3
    assert "## Manifest" in lines and sum(line.endswith("| ok |") for line in lines) >= 20
    previews = similarity.pair_previews(similarity.jaccard_pairs(rows), rows).collect()
    assert [(p.rank, p.left_id, p.right_preview[-3:]) for p in previews] == [(1, "f1__T1", "...")]
