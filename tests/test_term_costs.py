"""Terms are counted within their row and shuffled once."""

import time

from pyspark.sql import functions as F

from corpuswright.operators import cross_validation as cv, tfidf


def test_vectors_meet_in_one_shuffle_by_row(spark):
    rows = spark.createDataFrame([("a", "one two two"), ("b", "two three")], "id string, text string")
    config = tfidf.TfidfConfig(min_df=1, max_df=1.0)
    known = tfidf.vocabulary(rows, config)
    arrays = tfidf.weight_arrays(rows, known, config)
    assert arrays._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    for row in arrays.collect():
        assert abs(sum(e["weight"] ** 2 for e in row["entries"]) - 1) < 1e-9
        assert [(e["df"], e["term"]) for e in row["entries"]] == sorted((e["df"], e["term"]) for e in row["entries"])


def test_long_rows_are_weighed_in_linear_time(spark):
    rows = spark.createDataFrame([("a", " ".join(f"w{i}" for i in range(20_000)))], "id string, text string")
    config = tfidf.TfidfConfig(ngram_range=(1, 1), max_features=None, min_df=1, max_df=1.0)
    known = tfidf.vocabulary(rows, config)
    started = time.perf_counter()
    assert tfidf.term_weights(rows, known, config).count() == 20_000
    assert time.perf_counter() - started < 20


def test_terms_are_counted_within_their_row(spark):
    rows = spark.createDataFrame([(["x", "y", "x"],), ([],), (None,)], "t array<string>")
    counted = rows.select(tfidf.counted_terms(F.col("t")).alias("c")).collect()
    assert [None if r.c is None else [tuple(e) for e in r.c] for r in counted] == [[("x", 2), ("y", 1)], [], None]


def test_fold_statistics_send_a_term_once(spark):
    rows = spark.createDataFrame([(0, "aa aa bb"), (1, "aa"), (1, None)], "fold int, text string")
    config = tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, max_df=1.0)
    found = {(r.fold, r.term): (r.tf, r.df, r.n) for r in cv.complement_statistics(rows, 2, config).collect()}
    assert found == {(0, "aa"): (1, 1, 2), (1, "aa"): (2, 1, 1), (1, "bb"): (1, 1, 1)}
