import numpy as np
import pytest

from corpuswright.operators import cross_validation as cv, models, split, tfidf

CONFIG = tfidf.TfidfConfig(ngram_range=(1, 1), max_features=6, min_df=1, max_df=0.9)


@pytest.fixture(scope="module")
def texts(spark):
    words = ["red", "blue", "green", "gold"]
    rows = [(f"f{i // 2}", f"{words[i % 4]} {words[i % 4]} plain word{i % 5} only{i}" if i % 9 else None, i % 4) for i in range(90)]
    return spark.createDataFrame(rows, "family_id string, text string, label_id int")


def _counts(rows):
    df, tf = {}, {}
    for text in rows:
        for w in set((text or "").split()):
            df[w] = df.get(w, 0) + 1
        for w in (text or "").split():
            tf[w] = tf.get(w, 0) + 1
    return tf, df


def test_fold_tables_equal_recounting(texts):
    folded = split.assign_folds(texts, 3)
    rows = folded.collect()
    got = cv.fold_vocabularies(folded, 3, CONFIG).collect()
    for fold in range(3):
        train = [r.text for r in rows if r.fold != fold]
        tf, df = _counts(train)
        kept = sorted((w for w in df if df[w] <= 0.9 * len(train)), key=lambda w: (-tf[w], w))[:6]
        want = {w: (tf[w], df[w], np.log((len(train) + 1) / (df[w] + 1)) + 1) for w in kept}
        found = {r.term: (r.tf, r.df, r.idf) for r in got if r.fold == fold}
        assert found == {w: (a, b, pytest.approx(c)) for w, (a, b, c) in want.items()}


def test_a_term_of_one_fold_is_unknown_to_it(texts):
    folded = split.assign_folds(texts, 3)
    stats = cv.complement_statistics(folded, 3, CONFIG)
    homes = {w: r.fold for r in folded.collect() for w in (r.text or "").split() if w.startswith("only")}
    seen = {(r.term, r.fold) for r in stats.collect()}
    assert homes and all((w, f) not in seen and (w, (f + 1) % 3) in seen for w, f in homes.items())


def test_scores_equal_fold_by_fold_fits(texts):
    make = lambda total: models.logistic_regression(total, max_iter=20)
    scores = cv.cross_validate(texts, {"a": make, "b": lambda total: models.random_forest(3, 2)}, 3, CONFIG)
    got = {(r.candidate, r.fold): r for r in scores.collect()}
    assert len(got) == 6
    folded = split.assign_folds(texts, 3)
    for fold in range(3):
        train, held_out = folded.filter(f"fold <> {fold}"), folded.filter(f"fold = {fold}")
        vectors = models.fit_tfidf(train, CONFIG)
        model = make(float(train.count())).fit(models.weighted(vectors.transform(train)))
        row = got["a", fold]
        assert row.macro_f1 == pytest.approx(models.MacroF1().evaluate(model.transform(vectors.transform(held_out))), abs=1e-6)
        assert (row.train_rows, row.terms) == (train.count(), len(vectors.terms))
    best = cv.grid_scores(scores).collect()
    assert [r.candidate for r in best] == sorted(("a", "b"), key=lambda c: -sum(got[c, f].macro_f1 for f in range(3)))


def test_one_fold_and_no_rows_leave_nothing(texts):
    make = {"a": lambda total: models.logistic_regression(total, max_iter=2)}
    assert cv.cross_validate(texts, make, 1, CONFIG).count() == 0
    assert cv.cross_validate(texts.limit(0), make, 3, CONFIG).count() == 0
