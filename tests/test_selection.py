import random

import pytest
from pyspark.sql import functions as F

from corpuswright.operators import sampling, selection, tfidf
from corpuswright.operators.selection import first_per_group, hex_digits, number_digits, text_digits


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(6)
    words = ["", "a", "ab", "ab\u0000", "abc", "é", "z\U0001F600", "zz" * 40 + "a", "zz" * 40 + "b"]
    rows = [(rng.choice(["x", "y", None, "few"][: 3 + (i % 50 == 0)]), rng.choice([0, 1, 2, 70_000, 1 << 40, rng.randrange(1 << 20)]),
             rng.choice(words) + rng.choice(["", str(i)])) for i in range(3000)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, g string, n long, t string")


def _want(table, group, n, key):
    found = {}
    for r in sorted(table.collect(), key=key):
        found.setdefault(r.g if group else None, []).append(r.i)
    limit = n if isinstance(n, dict) else {g: n for g in found}
    return sorted(i for g, ids in found.items() for i in ids[: limit.get(g, 0)])


def _utf8(r):
    return (r.t.encode(), r.i)


@pytest.mark.parametrize("ranked", [0, 1, 7, 100_000])
@pytest.mark.parametrize("n", [1, 40, 700, 10_000, {"x": 5, "few": 900, "absent": 3}])
def test_first_rows_equal_a_sort(table, monkeypatch, ranked, n):
    monkeypatch.setattr(selection, "_RANKED", ranked)
    by_number = first_per_group(table, "g", n, [F.col("n"), F.col("i")], number_digits(F.col("n"), 1 << 40))
    assert sorted(r.i for r in by_number.collect()) == _want(table, True, n, lambda r: (r.n, r.i))
    by_text = first_per_group(table, "g", n, [F.col("t"), F.col("i")], text_digits(F.col("t"), 16))
    assert sorted(r.i for r in by_text.collect()) == _want(table, True, n, _utf8)


def test_one_group_and_no_rows(table):
    order, digits = [F.col("t"), F.col("i")], text_digits(F.col("t"))
    assert sorted(r.i for r in first_per_group(table, None, 100, order, digits).collect()) == _want(table, None, 100, _utf8)
    assert first_per_group(table, None, 0, order, digits).count() == 0
    assert first_per_group(table.limit(0), "g", 5, order, digits).count() == 0
    assert first_per_group(table, "g", {}, order, digits).count() == 0


def test_digits_never_fall_along_the_order(table):
    rows = table.select("t", F.array(*text_digits(F.col("t"))).alias("d"), F.array(*hex_digits(F.md5("t"))).alias("h"),
                        F.md5("t").alias("m")).distinct().collect()
    assert [r.d for r in sorted(rows, key=lambda r: r.t.encode())] == sorted(r.d for r in rows)
    assert [r.h for r in sorted(rows, key=lambda r: r.m)] == sorted(r.h for r in rows)


@pytest.mark.parametrize("n", [5_000, 20_000])
def test_large_samples_sort_no_group(spark, n):
    rows = spark.range(60_000).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 2 == 0, "T1").otherwise("T2").alias("label"))
    small = sampling.sample_per_group(rows, n=900)
    large = sampling.sample_per_group(rows, n=n)
    plan = large._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number" in line and " Window" in line]
    assert windows and all("__digit" in line or "__name" in line for line in windows)
    assert not any("[label" in line.split("windowspec")[-1] for line in windows)
    got = {(r.label, r.id): r.rank for r in large.collect()}
    assert len(got) == 2 * n and {(r.label, r.id): r.rank for r in small.collect()}.items() <= got.items()
    assert sorted(k for (g, _), k in got.items() if g == "T1") == list(range(1, n + 1))


def test_vocabulary_is_no_merge_in_one_task(spark):
    rows = spark.range(3000).select(F.concat_ws(" ", F.lit("shared"), *[F.concat(F.lit("w"), (F.col("id") * k % 997).cast("string")) for k in (1, 2, 3)]).alias("text"))
    config = tfidf.TfidfConfig(ngram_range=(1, 1), max_features=300, min_df=1, max_df=0.9)
    stats = tfidf._statistics(rows, config, None)
    plan = tfidf._kept_terms(stats, config)._jdf.queryExecution().executedPlan().toString()
    # Only the terms at the cut, with one frequency, are ranked.
    assert "limit=300" not in plan and "GlobalLimit" not in plan and "shiftrightunsigned" in plan
    known = {r.term: r.tf for r in tfidf.vocabulary(rows, config).collect()}
    every = sorted((-r.tf, r.term) for r in tfidf.term_statistics(rows, config).collect() if r.term != "shared")
    assert known == {t: -f for f, t in every[:300]}


def test_large_vocabularies_are_not_broadcast(spark, monkeypatch):
    rows = spark.createDataFrame([("a", "red blue"), ("b", "red")], "id string, text string")
    config = tfidf.TfidfConfig(ngram_range=(1, 1), min_df=1, max_df=1.0)
    known = tfidf.vocabulary(rows, config)
    small = tfidf.term_weights(rows, known, config).collect()
    monkeypatch.setattr(tfidf, "_BROADCAST_TERMS", 1)
    large = tfidf.term_weights(rows, known, config)
    assert "Broadcast hint" not in large._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert sorted(large.collect()) == sorted(small)
