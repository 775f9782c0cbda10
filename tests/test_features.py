from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from checks import fixtures as fx
from corpuswright.operators import encoding, metrics as met, models, tfidf
from corpuswright.plans import baseline
from corpuswright.sources import writers

TEXTS = ["aa bb aa cc", "aa bb dd", "aa ee été ete", "zz", "aa bb bb " + "x" * 200, "aa q", "bb " + "x" * 200]


def brute(texts, config):
    def grams(text):
        words = [w for w in text.replace("é", "e").split() if len(w) > 1]
        low, high = config.ngram_range
        return [" ".join(words[i:i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]

    docs = [Counter(grams(t)) for t in texts]
    df, tf = Counter(), Counter()
    for d in docs:
        df.update(d.keys())
        tf.update(d)
    kept = [w for w in df if config.min_df <= df[w] <= config.max_df * len(docs)]
    kept = sorted(kept, key=lambda w: (-tf[w], w))[:config.max_features]
    idf = {w: np.log((1 + len(docs)) / (1 + df[w])) + 1 for w in kept}
    out = {}
    for i, d in enumerate(docs):
        raw = {w: (1 + np.log(c) if config.sublinear_tf else c) * idf[w] for w, c in d.items() if w in idf}
        norm = np.sqrt(sum(v * v for v in raw.values()))
        out.update({(f"f{i}__T1", w): v / norm for w, v in raw.items()})
    return out


@pytest.mark.parametrize("config", [
    tfidf.TfidfConfig(), tfidf.TfidfConfig(max_features=3), tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, max_df=1.0, sublinear_tf=False),
    tfidf.TfidfConfig(max_features=None), tfidf.TfidfConfig(ngram_range=(1, 3), min_df=1),
])
def test_weights_and_vectors_equal_brute_force(make_rows, config):
    rows = make_rows([("train", f"f{i}", "T1", t) for i, t in enumerate(TEXTS)])
    want = brute(TEXTS, config)
    got = {(r.id, r.term): r.weight for r in tfidf.term_weights(rows, tfidf.vocabulary(rows, config), config).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}
    if config.max_features is None:
        return
    vectors = models.fit_tfidf(rows, config)
    for row in vectors.transform(rows).select("id", "features").collect():
        expected = sorted(v for (i, _w), v in want.items() if i == row.id)
        assert sorted(row.features.values) == pytest.approx(expected)
        assert row.features.size == len(vectors.terms)
        placed = {(row.id, vectors.terms[i]): w for i, w in zip(row.features.indices.tolist(), row.features.values)}
        assert placed == {k: pytest.approx(v) for k, v in want.items() if k[0] == row.id}


def test_rows_that_repeat_an_id_are_weighed_apart(spark):
    config = tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, max_df=1.0)
    rows = spark.createDataFrame([("a", "red"), ("a", "blue"), ("a", None), ("b", "")], "id string, text string")
    known = tfidf.vocabulary(rows, config)
    got = sorted((r.id, r.term, r.weight) for r in tfidf.term_weights(rows, known, config).collect())
    assert got == [("a", "blue", 1.0), ("a", "red", 1.0)]


def test_vectors_keep_very_long_terms(spark):
    config = tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, max_df=1.0)
    rows = spark.createDataFrame([("a", "x" * 5000 + " bb"), ("b", "x" * 4999 + "y")], "id string, text string")
    vectors = models.fit_tfidf(rows, config)
    assert vectors.terms == ("bb", "x" * 5000, "x" * 4999 + "y")
    assert [list(r.features.indices) for r in vectors.transform(rows).orderBy("id").collect()] == [[0, 1], [2]]


def test_macro_f1(spark):
    pairs = [(0, 0.0), (0, 0.0), (0, 1.0), (1, 1.0), (2, 0.0)]
    frame = spark.createDataFrame(pairs, "label_id int, prediction double")
    assert models.MacroF1().evaluate(frame) == pytest.approx((2 / 3 + 2 / 3 + 0) / 3)
    assert models.MacroF1().evaluate(frame.limit(0)) == 0.0


def test_vocabulary_keys_are_bounded(spark, make_rows):
    rows = make_rows([("train", f"f{i}", "T1", "a" * 5000 + " bb") for i in range(2)])
    keys = tfidf.vocabulary(rows, tfidf.TfidfConfig(max_df=1.0)).select(F.max(F.char_length(tfidf.compact_term(F.col("term")))))
    assert keys.first()[0] <= 81


def test_vectors_need_no_shuffle(make_rows):
    rows = make_rows([("train", f"f{i}", "T1", t) for i, t in enumerate(TEXTS)])
    plan = models.fit_tfidf(rows).transform(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_encoding_keeps_rows_that_repeat_an_id(make_rows):
    rows = make_rows([("train", "f0", "T1", "aa bb"), ("train", "f0", "T1", "bb")])
    vocabulary = encoding.token_ids(rows, max_tokens=2)
    got = sorted(r.input_ids for r in encoding.encode_fixed(rows, vocabulary, 4, 2).collect())
    assert got == [[2, 4, 3, 0], [2, 5, 4, 3]] or got == [[2, 4, 5, 3], [2, 5, 3, 0]]


def test_fixed_length_encoding(make_rows):
    rows = make_rows([("train", "f0", "T1", "aa bb aa"), ("train", "f1", "T1", "cc aa bb zz yy"), ("train", "f2", "T1", "!")])
    vocabulary = encoding.token_ids(rows, max_tokens=2)
    assert {r.term: r.token_id for r in vocabulary.collect()} == {"aa": 4, "bb": 5}
    got = {r.id: (r.input_ids, r.attention_mask) for r in encoding.encode_fixed(rows, vocabulary, 6, 2).collect()}
    assert got == {
        "f0__T1": ([2, 4, 5, 4, 3, 0], [1, 1, 1, 1, 1, 0]),
        "f1__T1": ([2, 1, 4, 5, 1, 3], [1] * 6),
        "f2__T1": ([2, 3, 0, 0, 0, 0], [1, 1, 0, 0, 0, 0]),
    }


@pytest.fixture(scope="module")
def separable(spark):
    """Four classes told apart by one word each, among shared words."""
    words = ["alpha", "beta", "gamma", "delta"]
    rows = [(f"f{i}__T", f"f{i}", f"{words[i % 4]} common text number{i % 7} {words[i % 4]}", i % 4, 5,
             "test" if i % 5 == 0 else "train") for i in range(200)]
    return spark.createDataFrame(rows, "id string, family_id string, text string, label_id int, text_len_word int, split string")


@pytest.mark.parametrize("name,make,config", [
    ("logreg", lambda total: models.logistic_regression(total), tfidf.TfidfConfig()),
    ("svm", lambda total: models.linear_svm(total, max_iter=20), tfidf.TfidfConfig()),
    ("forest", lambda total: models.random_forest(20, 8), tfidf.TfidfConfig()),
    ("boosting", lambda total: models.gradient_boosting(3), tfidf.TfidfConfig(max_features=20)),
])
def test_classifiers_learn(separable, name, make, config):
    run = baseline.fit_baseline(separable, make, name, config)
    assert met.evaluate(run.predictions).first().accuracy > 0.9


def test_baseline_artifacts_and_record(spark, separable, tmp_path):
    run = baseline.fit_baseline(separable, models.logistic_regression)
    assert models.parameter_count(run.model) == 4 * len(run.vectors.terms) + 4
    path = str(tmp_path / "run")
    baseline.write_baseline(run, path)
    size = writers.artifact_sizes(spark, f"{path}/model").first()
    assert size.files > 0 and size.size_mb >= 0
    saved = spark.read.parquet(f"{path}/predictions")
    assert saved.count() == separable.filter("split = 'test'").count()
    record = baseline.run_record(run, 1 << 20, 0.5).first()
    assert record.accuracy == 1.0 and record.auroc_ovr == 1.0 and record.num_params == models.parameter_count(run.model)
    assert record.test_samples == 40 and record.model_size_mb == 1.0


@pytest.mark.parametrize("make", [
    models.logistic_regression, lambda total: models.linear_svm(total, max_iter=5), lambda total: models.random_forest(5, 4),
    lambda total: models.gradient_boosting(3),
])
def test_saved_models_predict_the_same(separable, tmp_path, make):
    run = baseline.fit_baseline(separable, make, config=tfidf.TfidfConfig(stop_words=("common",), max_features=50))
    baseline.write_baseline(run, str(tmp_path / "run"))
    loaded = baseline.load_baseline(str(tmp_path / "run"))
    held_out = separable.filter("split = 'test'")
    columns = ("id", "y_pred", "scores")
    again = models.predict(loaded, held_out, "m").select(*columns).orderBy("id").collect()
    assert again == run.predictions.select(*columns).orderBy("id").collect() and len(again) == 40
    vectors = loaded.stages[0]
    assert (vectors.terms, vectors.idf, vectors.config) == (run.vectors.terms, run.vectors.idf, run.vectors.config)


def test_cross_validation_keeps_families_together(separable):
    vectors = models.fit_tfidf(separable)
    train = models.weighted(vectors.transform(separable))
    estimator = LogisticRegression(labelCol="label_id", weightCol="weight", maxIter=5)
    grid = ParamGridBuilder().addGrid(estimator.regParam, [0.01, 0.1]).build()
    tuned = models.fit_cross_validated(estimator, grid, train, folds=2)
    assert max(tuned.avgMetrics) > 0.9


def test_batch_scoring(spark, sf):
    vectors = fx.table(spark, sf, "embeddings")
    centroids = models.fit_centroids(vectors, "embedding", "label")
    scored = models.batch_scores(vectors, models.centroid_scorer(centroids), "embedding", 64).select("embedding", "scores", "y_pred")
    matrix = np.array(centroids)
    for row in scored.limit(20).collect():
        expected = matrix @ np.array(row.embedding, dtype=np.float64)
        assert row.scores == pytest.approx(expected.tolist()) and row.y_pred == int(np.argmax(expected))
