"""Terms are counted as numbers, in bounded slices, as plain counting of the texts would."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpuswright.operators import cross_validation as cv, grams, models, tfidf


def _rows(n=60, seed=3):
    rng = random.Random(seed)
    return [None if rng.random() < 0.1 else [f"w{int(rng.expovariate(0.2))}" for _ in range(rng.randrange(0, 9))] for _ in range(n)]


def _grams(tokens, low, high):
    return [" ".join(tokens[i:i + n]) for n in range(low, high + 1) for i in range(len(tokens) - n + 1)]


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 3), (1, 4)])
@pytest.mark.parametrize("wide", [False, True])
def test_counts_equal_plain_counting(monkeypatch, low, high, wide):
    rows, rng = _rows(), np.random.default_rng(1)
    groups, times = rng.integers(0, 3, len(rows)) - 1, rng.integers(1, 4, len(rows))
    if wide:  # numbers that leave no bits for the rows
        counted = grams._counted
        monkeypatch.setattr(grams, "_counted", lambda codes, *a: (lambda f, *r: (f >> 40, *r))(*counted(codes << 40, *a)))
    want_tf, want_df = Counter(), Counter()
    for row, g, t in zip(rows, groups.tolist(), times.tolist()):
        found = Counter(_grams(row or [], low, high))
        for term, n in found.items():
            want_tf[term, g] += n * t
            want_df[term, g] += t
    tf, df = Counter(), Counter()
    for names, own, a, b in grams.gram_counts(pa.array(rows, pa.list_(pa.string())), low, high, groups, times):
        for key, x, y in zip(zip(names.to_pylist(), own.tolist()), a.tolist(), b.tolist()):
            assert key not in tf
            tf[key], df[key] = x, y
    assert tf == want_tf and df == want_df


def test_slices_are_bounded_and_whole(monkeypatch):
    monkeypatch.setattr(grams, "_SLICE_TOKENS", 10)
    lists = pa.array([["a"] * n for n in (3, 4, 50, 0, 10, 1, 9)] + [None], pa.list_(pa.string()))
    found = list(grams.slices(lists))
    assert [at for low, high in found for at in range(low, high)] == list(range(8))
    assert all(high - low == 1 or sum(len(x or ()) for x in lists.slice(low, high - low).to_pylist()) <= 10 for low, high in found)


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 3)])
def test_vocabulary_finds_its_terms(low, high):
    rows = _rows(seed=5)
    every = sorted({g for r in rows for g in _grams(r or [], low, high)})
    known = every[::3] + ["unseen", "unseen pair"]
    number = {t: i for i, t in enumerate(known)}
    want = {(i, number[t]): n for i, r in enumerate(rows) for t, n in Counter(_grams(r or [], low, high)).items() if t in number}
    row, term, times = grams.Vocabulary(known).counts(pa.array(rows, pa.list_(pa.string())), low, high)
    assert list(zip(row.tolist(), term.tolist())) == sorted(want) and dict(zip(zip(row.tolist(), term.tolist()), times.tolist())) == want
    assert len(grams.Vocabulary([]).counts(pa.array(rows, pa.list_(pa.string())), low, high)[0]) == 0


def test_a_term_leaves_its_task_once_for_many_texts(spark):
    rows = spark.range(500, numPartitions=1).select(F.lit("red blue red").alias("text"))
    sent = tfidf.grouped_statistics(rows, tfidf.TfidfConfig())
    assert sorted((r.term, r.tf, r.df) for r in sent.collect() if r.term) == [
        ("blue", 500, 500), ("blue red", 500, 500), ("red", 1000, 500), ("red blue", 500, 500)]


def test_rare_terms_are_not_written(spark, monkeypatch):
    """Neither vocabularies nor folds stage the terms that the least frequency rules out."""
    rows = spark.createDataFrame([(i % 2, f"both word{i}") for i in range(8)] + [(0, None)], "fold int, text string")
    config, seen = tfidf.TfidfConfig(ngram_range=(1, 1), min_df=2, max_df=1.0), {}
    for module in (tfidf, cv):
        staged = module.stage

        def watch(frame, name, staged=staged):
            table = staged(frame, name)
            seen[name] = {r.term for r in table.select("term").collect()}
            return table

        monkeypatch.setattr(module, "stage", watch)
    assert [(r.term, r.tf, r.df) for r in tfidf.vocabulary(rows, config).collect()] == [("both", 8, 8)]
    assert sorted((r.fold, r.term, r.df) for r in cv.fold_vocabularies(rows, 2, config).collect()) == [(0, "both", 4), (1, "both", 4)]
    assert seen["terms"] == seen["folds"] == {"both", None}


def test_small_vocabularies_weigh_rows_without_a_shuffle(spark):
    rows = spark.createDataFrame([("a", "red blue blue"), ("b", None), ("c", "red")], "id string, text string")
    config = tfidf.TfidfConfig(min_df=1, max_df=1.0)
    known = tfidf.vocabulary(rows, config)
    weights = tfidf.term_weights(rows, known, config)
    assert "Exchange" not in weights._jdf.queryExecution().executedPlan().toString()
    joined = tfidf.weight_arrays(rows, known, config).select("id", F.inline("entries")).select("id", "term", "df", "weight")
    assert sorted((r.id, r.term, r.df, round(r.weight, 12)) for r in weights.collect()) == sorted(
        (r.id, r.term, r.df, round(r.weight, 12)) for r in joined.collect())
    vectors = models.vectors_of(known, config).transform(rows)
    assert "Generate" not in vectors._jdf.queryExecution().executedPlan().toString()
    assert {r.id: len(r.features.indices) for r in vectors.collect()} == {"a": 4, "b": 0, "c": 1}
