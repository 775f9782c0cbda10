import random
from collections import Counter
from statistics import mean, stdev

import pytest
from pyspark.sql import functions as F

from corpuswright.operators import metrics as met

# Published confusion matrices with accuracy, macro-F1 and F1 per class.
GOLDEN = {
    "tfidf_logreg": ([[292, 93, 269, 96], [78, 489, 70, 113], [284, 93, 288, 82], [61, 130, 93, 466]],
                     0.5121788455121788, 0.5096647505083474,
                     [0.3986348122866894, 0.6289389067524116, 0.39263803680981596, 0.6184472461844724]),
    "distilbert": ([[397, 72, 191, 90], [48, 631, 12, 59], [396, 85, 198, 68], [69, 117, 31, 533]],
                   0.5869202535869202, 0.571848886656147, None),
    "bert": ([[394, 77, 196, 83], [31, 658, 17, 44], [379, 84, 213, 71], [70, 141, 21, 518]],
             0.5949282615949283, 0.5795702736256901, None),
    "roberta": ([[634, 6, 108, 2], [1, 696, 9, 44], [612, 9, 123, 3], [1, 111, 8, 630]],
                0.6950283616950284, 0.6622756195253643, None),
    "deberta": ([[283, 3, 461, 3], [0, 697, 8, 45], [242, 3, 497, 5], [3, 71, 2, 674]],
                0.7177177177177178, 0.7124575743996509, None),
}
PRED = "model_name string, seed long, id string, y_true int, y_pred int, scores array<double>, text_len_word int"


def predictions(spark, rows, model="m", seed=1):
    """rows: (y_true, y_pred, scores, words)."""
    return spark.createDataFrame(
        [(model, seed, f"r{i:04d}", t, p, s, w) for i, (t, p, s, w) in enumerate(rows)], PRED)


def test_golden_matrices(spark):
    cells = [(name, 42, t, p, n) for name, (matrix, *_rest) in GOLDEN.items()
             for t, line in enumerate(matrix) for p, n in enumerate(line)]
    weighted = spark.createDataFrame(cells, "model_name string, seed long, y_true int, y_pred int, n long")
    got = {r.model_name: r for r in met.evaluate(weighted, weight="n").collect()}
    for name, (_matrix, accuracy, macro, f1) in GOLDEN.items():
        assert got[name].accuracy == pytest.approx(accuracy, abs=1e-12)
        assert got[name].macro_f1 == pytest.approx(macro, abs=1e-12)
        if f1:
            assert [got[name][f"f1_T{i}"] for i in range(1, 5)] == pytest.approx(f1, abs=1e-12)


def test_absent_classes(spark):
    # T2 is never predicted, T3 never true, T4 neither.
    table = predictions(spark, [(0, 0, None, 1), (1, 0, None, 1), (0, 2, None, 1)])
    confusion = met.confusion_matrix(table)
    assert confusion.count() == 16 and confusion.agg(F.sum("n")).first()[0] == 3
    per_class = {r.label: (r.precision, r.recall, r.f1) for r in met.per_class_metrics(confusion).collect()}
    assert per_class == {"T1": (0.5, 0.5, 0.5), "T2": (0.0, 0.0, 0.0), "T3": (0.0, 0.0, 0.0), "T4": (0.0, 0.0, 0.0)}
    summary = met.evaluate(table).first()
    assert summary.macro_f1 == pytest.approx(0.5 / 3) and summary.accuracy == pytest.approx(1 / 3)
    report = {r.row: r for r in met.classification_report(met.per_class_metrics(confusion)).collect()}
    assert report["macro avg"].f1 == pytest.approx(0.5 / 3) and report["weighted avg"].recall == pytest.approx(1 / 3)
    wide = {r.label: tuple(r[l] for l in ("T1", "T2", "T3", "T4")) for r in met.confusion_wide(confusion).collect()}
    assert wide["T1"] == (1, 0, 1, 0) and wide["T2"] == (1, 0, 0, 0)


def brute_auroc(pairs):
    pos, neg = [s for h, s in pairs if h], [s for h, s in pairs if not h]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("kind", ["probability", "tied", "signed", "extreme", "powers", "close"])
def test_auroc_equals_pair_counting(spark, kind):
    rng = random.Random(3)
    draw = {
        "probability": lambda: rng.random(),
        "tied": lambda: rng.randrange(4) / 4,
        "signed": lambda: rng.gauss(0, 3) if rng.random() < 0.9 else rng.choice([0.0, -0.0]),
        "extreme": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300),
        "powers": lambda: rng.choice([-1, 1]) * 2.0 ** rng.randint(-6, 6) * rng.choice([1, 1 - 2**-53, 1 + 2**-52]),
        "close": lambda: 0.75 + rng.randrange(40) * 2**-45,
    }[kind]
    rows = [(rng.randrange(3), 0, [draw() for _ in range(4)], 1) for _ in range(250)]
    got = {r["class"]: r.auroc for r in met.auroc_one_vs_rest(predictions(spark, rows)).collect()}
    for c in range(4):
        want = brute_auroc([(t == c, s[c]) for t, _p, s, _w in rows])
        assert got[c] == (None if want is None else pytest.approx(want, abs=1e-12))
    macro = met.auroc_macro(predictions(spark, rows)).first().auroc_ovr
    assert macro == pytest.approx(mean(got[c] for c in range(3)))


@pytest.mark.parametrize("low,most", [(0.0, 20), (1 - 2**-18, 20), (1 - 2**-30, 1000)])
def test_score_buckets_divide_crowded_scores(spark, low, most):
    rng = random.Random(4)
    drawn = [low + (1 - low) * rng.random() for _ in range(2000)]
    wide, narrow = met._buckets_of(F.col("score"))
    buckets = [tuple(r) for r in spark.createDataFrame([(x,) for x in sorted(drawn)], "score double").select(wide, narrow, "score").collect()]
    assert buckets == sorted(buckets)
    assert max(Counter(b[:2] for b in buckets).values()) <= most


def test_auroc_has_no_window_over_a_class(spark):
    plan = met.auroc_one_vs_rest(predictions(spark, [(0, 0, [0.1] * 4, 1)]))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    assert len(windows) == 3 and all("class" in w for w in windows)


def test_run_record_and_flat_results(spark):
    table = predictions(spark, [(0, 0, [0.9, 0.1, 0.0, 0.0], 5), (1, 0, [0.6, 0.4, 0.0, 0.0], 60)], "a/b")
    timings = spark.createDataFrame([("a/b", 1, 2.0, 0.5, 10, 1 << 20)],
                                    "model_name string, seed long, train_time_sec double, eval_time_sec double, num_params long, size_bytes long")
    record = met.run_result(table, timings)
    row = record.first()
    assert row.model_name == "a-b" and row.rows_per_sec == 4.0 and row.latency_ms == 250.0 and row.model_size_mb == 1.0
    assert row.confusion_matrix == [[1, 0, 0, 0], [1, 0, 0, 0], [0] * 4, [0] * 4]
    assert row.per_class_f1["T1"] == pytest.approx(2 / 3)
    flat = met.results_flat(record)
    assert flat.columns == ["model_name", "accuracy", "macro_f1", "f1_T1", "f1_T2", "f1_T3", "f1_T4", "precision_macro",
                            "recall_macro", "auroc_ovr", "train_time_sec", "latency_ms", "num_params", "seed", "timestamp_utc"]


def test_stratified_confused_and_misclassified(spark):
    table = predictions(spark, [(0, 1, None, 10), (0, 1, None, 60), (2, 3, None, 200), (1, 1, None, 10)])
    strata = {r.bucket: (r.n, r.accuracy) for r in met.length_stratified(table).collect()}
    assert strata == {"short": (2, 0.5), "medium": (1, 0.0), "long": (1, 0.0)}
    ranked = [(r.rank, r.true_label, r.pred_label, r.n) for r in met.confused_pairs(met.confusion_matrix(table)).orderBy("rank").collect()]
    assert ranked == [(1, "T1", "T2", 2), (2, "T3", "T4", 1)]
    assert [r.id for r in met.misclassified(table, 2).collect()] == ["r0000", "r0001"]


def test_multi_seed_pareto_delta_epoch(spark):
    runs = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.7), ("b", 1, 0.9)], "model_name string, seed long, accuracy double")
    stats = {r.model_name: (r["mean"], r["std"], r.runs) for r in met.multi_seed(runs, ["accuracy"]).collect()}
    assert stats["a"] == (pytest.approx(0.6), pytest.approx(stdev([0.5, 0.7])), 2) and stats["b"][1] is None
    points = spark.createDataFrame([("a", 1, 0.5), ("b", 1, 0.6), ("c", 2, 0.6), ("d", 3, 0.9), ("e", 3, 0.9)], "model_name string, cost long, gain double")
    front = {r.model_name for r in met.pareto_frontier(points, "cost", "gain").filter("on_frontier").collect()}
    assert front == {"b", "d", "e"}
    base = spark.createDataFrame([("a", 0.8)], "model_name string, accuracy double")
    other = spark.createDataFrame([("a", "lower", 0.7)], "model_name string, perturbation string, accuracy double")
    assert met.perturbation_delta(base, other).first().delta == pytest.approx(-0.1)
    history = spark.createDataFrame([("a", 1, 0.4), ("a", 2, 0.6), ("a", 3, 0.6)], "model_name string, epoch int, macro_f1 double")
    assert tuple(met.best_epoch(history).first()) == ("a", 2, 0.6)
