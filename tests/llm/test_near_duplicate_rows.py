import random

import corpus_pipeline


def test_rows_with_repeated_and_missing_ids_are_judged_one_by_one(spark, sf):
    rng = random.Random(1)
    a, b, c, d = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(4))
    rows = [
        (1, a), (2, a), (2, b),  # the second text of 2 is unique
        (3, c), (3, c),  # exact copies under one id
        (None, d), (None, d), (None, a),  # copies without an id, one of a row with an id
    ]
    docs = spark.createDataFrame([(i, t, "x", n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, key string, n int")
    for parts in (1, 4):
        kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(parts), sf)
        assert kept.columns == docs.columns
        found = sorted((r.text, -1 if r.doc_id is None else r.doc_id) for r in kept.collect())
        assert found == sorted([(a, 1), (b, 2), (c, 3), (d, -1)])


def test_unique_ids_keep_the_smallest(spark, sf):
    from corpuswright.llm import simhash

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = {r.doc_id for r in simhash.near_duplicates(docs).filter("kept").collect()}
    got = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()]
    assert len(got) == len(want) and set(got) == want
