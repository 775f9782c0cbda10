import numpy as np

import corpus_pipeline
from corpuswright.llm import language, quality, simhash, toxicity
from corpuswright.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _auc(labels, scores):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    good = labels == 1
    return (ranks[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_language_held_out(spark):
    langs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = QUERIES["op2_language"](spark, SF).join(langs, "doc_id").filter("held_out").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.98
    assert rows.score.between(0, 1).all()


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op3_toxicity"](spark, SF).join(labels, "doc_id").toPandas()
    assert _auc(rows.toxic.to_numpy(), rows.score.to_numpy()) > 0.9
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all()


def test_toxicity_locates_sentences(spark):
    clean = [(i, f"The sky is blue today {i}. We walk home. Bread is good.", 0) for i in range(60)]
    toxic = [(100 + i, f"The sky is blue. You are a rotter{i % 3} indeed! Bread is good.", 1) for i in range(60)]
    docs = spark.createDataFrame(clean + toxic, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    for r in toxicity.score(docs, model).collect():
        assert r.predicted == r.toxic
        assert len(r.offending) == r.toxic
        if r.toxic:
            span = r.offending[0]
            assert "rotter" in r.text.lower().encode()[span.start : span.start + span.length].decode()


def test_quality_without_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = QUERIES["op1_quality"](spark, SF).join(labels, "doc_id").toPandas()
    assert _auc(rows.quality.to_numpy(), rows.score.to_numpy()) > 0.97
    assert rows.kept[rows.quality == 1].mean() > 0.98


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.8
    k = len(quality.LABELLERS)
    good = rng.choice([0, 1, -1], (20_000, k), p=[0.03, 0.6, 0.37])
    bad = rng.choice([0, 1, -1], (20_000, k), p=[0.4, 0.2, 0.4])
    votes = np.where(truth[:, None], good, bad)
    codes, counts = np.unique([quality._code(v) for v in votes.tolist()], return_counts=True)
    model = quality.estimate(dict(zip(codes.tolist(), counts.tolist())))
    assert abs(model.prior - 0.8) < 0.02
    assert np.abs(model.given_good - [0.03, 0.6, 0.37]).max() < 0.03
    assert np.abs(model.given_bad - [0.4, 0.2, 0.4]).max() < 0.03


def test_edges_have_defined_results(spark, edge_docs):
    plain = [r for r in language.identify(edge_docs, language.fit(edge_docs)).collect()]
    assert {r.doc_id: (r.lang_pred, r.score) for r in plain if r.doc_id in (2, 3, 4, 5)} == {i: ("und", 0.0) for i in (2, 3, 4, 5)}
    assert len(plain) == 13 and {r.lang_pred for r in plain} == {"und", "en", "de"}
    assert language.fit(edge_docs.limit(0)) is None
    assert {r.lang_pred for r in language.identify(edge_docs, None).collect()} == {"und"}

    labels = spark.createDataFrame([(1, 0), (1, 1), (8, 0), (None, 1), (9, None), (77, 1)], "doc_id long, toxic int")
    model = toxicity.fit(edge_docs, labels)
    scored = toxicity.score(edge_docs, model).collect()
    assert len(scored) == 13 and all(r.score == 0.0 for r in scored if not (r.text or "").strip())
    assert toxicity.fit(edge_docs, labels.limit(0)) is None
    assert {r.predicted for r in toxicity.score(edge_docs, None).collect()} == {0}

    judged = quality.classify(edge_docs, quality.fit(edge_docs)).collect()
    assert len(judged) == 13 and not any(r.kept for r in judged if not (r.text or "").strip())
    assert quality.fit(edge_docs.limit(0)) is None
    assert quality.classify(edge_docs.limit(0), None).count() == 0


def test_pipeline_stages(spark, edge_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, step(spark, kept, SF).cache()
        assert kept.columns == docs.columns and kept.count() > 0.85 * before.count(), name
    groups = simhash.near_duplicates(kept)
    assert groups.filter("NOT kept").count() == 0
    packed = QUERIES["pipeline"](spark, SF)
    assert packed.select("doc_id").distinct().count() == kept.count()
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    odd = edge_docs
    for _, step in corpus_pipeline.STAGES:
        odd = step(spark, odd, SF)
    assert odd.count() > 0
    empty = docs.limit(0)
    for _, step in corpus_pipeline.STAGES:
        empty = step(spark, empty, SF)
    assert empty.count() == 0
