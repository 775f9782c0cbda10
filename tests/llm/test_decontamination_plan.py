import re

from corpuswright.llm import decontamination as dc
from tests.conftest import SF


def _plans(spark, monkeypatch):
    """Physical plans of all tables that a search writes."""
    found, staged = [], dc.stage

    def watch(frame, name):
        found.append((name, frame._jdf.queryExecution().executedPlan().toString()))
        return staged(frame, name)

    monkeypatch.setattr(dc, "stage", watch)
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    dc.leaks(docs, items).count()
    return dict(found)


def test_no_shuffle_carries_words(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = _plans(spark, monkeypatch)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("candidates", "leaks"):
        plan = plans[name].split("\n")
        shuffles = [i for i, line in enumerate(plan) if "Exchange hashpartitioning(hash" in line]
        assert shuffles
        # The operator below an exchange says what it carries: no column is the words themselves.
        assert not any(re.search(r"(\[|, )words#\d+(,|\])", plan[i + 1]) for i in shuffles)


def test_sketches_find_the_candidates(spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(30))), (2, "one two")], "item_id long, text string")
    shingles = dc._item_shingles(items, 0.8).collect()
    assert sum(r.sketched for r in shingles if r.item_id == 1) == 26 - 21 + 1
    texts = [" ".join(f"w{i}" for i in range(30)), " ".join(f"w{i}" for i in range(12)), "so one two", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.containment for r in dc.contained_items(docs, items).collect()}
    assert got == {(0, 1): 1.0}
