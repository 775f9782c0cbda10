import json

import pytest
from pyspark.sql import functions as F

from corpuswright.operators import dedup, distributions as dist, families as fam, manifest as man, split, validation as val
from corpuswright.plans import build
from corpuswright.schema import RAW_TEXT_FIELDS
from corpuswright.sources import readers, writers

T1, T2, T3, T4 = RAW_TEXT_FIELDS


def record(idx, source, *texts, **extra):
    fields = {k: v for k, v in zip(RAW_TEXT_FIELDS, texts) if v is not None}
    return {"idx": idx, "dataset_source": source, **fields, **extra}


@pytest.fixture
def raw_dir(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    array = [
        record(0, "MRPC", "zero", "x" * 4000, "y" * 4001, "\u0001\u0002 \u0003"),
        record(None, "mrpc", "no idx"), record(5, None, "no source"), record(6, "", "empty source"),
        record(7, "paws", None, "", "  ", None),
        record(8, "paws", "a", **{"llm_paraphrased_generated_text(type5)-1st": "ignored"}),
    ]
    (folder / "a.json").write_text(json.dumps(array))
    (folder / "b.json").write_text(json.dumps(record(1.0, "hlpc", "single object")))
    (folder / "c.json").write_text("")
    (folder / "d.jsonl").write_text(
        json.dumps(record(8, "paws", "a")) + "\n\n" + json.dumps(record(8, "paws", "b")) + "\n")
    (folder / "notes.txt").write_text("not data")
    (folder / "sub").mkdir()
    (folder / "sub" / "deep.jsonl").write_text(json.dumps(record(99, "mrpc", "not read")))
    return str(folder)


def test_read_raw_dir_and_families(spark, raw_dir):
    wide = fam.families(readers.read_raw_dir(spark, raw_dir))
    assert sorted(r.family_id for r in wide.collect()) == ["hlpc_1.0", "mrpc_0", "paws_7", "paws_8", "paws_8", "paws_8"]


def test_empty_dir_warns(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert readers.read_raw_dir(spark, str(tmp_path)).count() == 0


def test_malformed_line_fails(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"idx": 1}\n{broken\n')
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path)).collect()


def test_materialize_and_drop_counts(spark, raw_dir):
    wide = fam.families(readers.read_raw_dir(spark, raw_dir))
    rows = {r.id: r for r in fam.materialize_rows(wide).collect()}
    assert set(rows) == {"mrpc_0__T1", "mrpc_0__T2", "hlpc_1.0__T1", "paws_8__T1"}
    assert rows["mrpc_0__T2"].text_len_char == 4000 and rows["mrpc_0__T2"].label_id == 1
    drops = {r.drop_reason: r.n for r in fam.drop_counts(wide, fam.classify_rows(wide)).collect()}
    assert drops == {"missing_family_id": 0, "empty_text": 1, "too_long": 1, "null_or_blank": 4 + 3 * 3 + 3}


def test_drop_counts_missing_family(spark):
    wide = spark.createDataFrame([("", "s", "a", None, None, None), ("s_1", "s", "a", None, None, None)],
                                 "family_id string, source string, T1 string, T2 string, T3 string, T4 string")
    drops = {r.drop_reason: r.n for r in fam.drop_counts(wide, fam.classify_rows(wide)).collect()}
    assert drops["missing_family_id"] == 1


def test_length_policies(make_rows):
    rows = make_rows([("train", "f1", "T1", "abcd ef"), ("train", "f2", "T1", "ab")])
    flagged = {r.id: r.over_length for r in fam.apply_length_policy(rows, "flag", 5).collect()}
    assert flagged == {"f1__T1": True, "f2__T1": False}
    cut = {r.id: (r.text, r.text_len_char, r.text_len_word) for r in fam.apply_length_policy(rows, "truncate", 5).collect()}
    assert cut["f1__T1"] == ("abcd", 4, 1)
    assert fam.apply_length_policy(rows, "remove", 5).count() == 1
    with pytest.raises(ValueError):
        fam.apply_length_policy(rows, "other", 5)


def test_duplicate_keys(spark, raw_dir):
    wide = fam.families(readers.read_raw_dir(spark, raw_dir))
    found = [tuple(r) for r in val.duplicate_family_keys(wide).collect()]
    assert found == [("paws_8", 3, True)]
    ids = [tuple(r) for r in val.duplicate_ids(fam.materialize_rows(wide)).collect()]
    assert ids == [("paws_8__T1", 3)]


def _families(spark, n, per_family=2):
    return spark.range(n * per_family).select(
        F.concat(F.lit("f_"), (F.col("id") % n).cast("string")).alias("family_id"), F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % n < n // 3, "a").otherwise("b").alias("source"))


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1013])
def test_split_sizes_and_stability(spark, n):
    rows = _families(spark, n)
    assigned = {}
    for parts in (1, 7):
        out = split.split_by_group(rows.repartition(parts)).select("family_id", "split").collect()
        families = {}
        for r in out:
            assert families.setdefault(r.family_id, r.split) == r.split
        assigned[parts] = families
    assert assigned[1] == assigned[7]
    sizes = [sum(s == name for s in assigned[1].values()) for name in ("train", "val", "test")]
    assert sizes == [int(n * 0.70), int(n * 0.15), n - int(n * 0.70) - int(n * 0.15)]
    assert split.split_by_group(rows, seed=1).filter("split = 'train'").count() == 2 * int(n * 0.70)


def test_split_ratios(spark):
    rows = _families(spark, 10)
    only_test = split.split_by_group(rows, {"train": 0.0, "val": 0.0, "test": 1.0})
    assert only_test.filter("split <> 'test'").count() == 0
    only_val = split.split_by_group(rows, {"train": 0.0, "val": 1.0, "test": 0.0})
    assert only_val.filter("split <> 'val'").count() == 0
    for bad in ({"train": 0.5, "val": 0.2, "test": 0.2}, {"train": 1.0}, {"train": 1.2, "val": -0.2, "test": 0.0}):
        with pytest.raises(ValueError):
            split.split_by_group(rows, bad)


def test_split_of_nothing(spark):
    assert split.split_by_group(_families(spark, 5).limit(0)).count() == 0


def test_hot_family_stays_whole(spark):
    hot = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("family_id"))
    out = split.split_by_group(hot)
    assert out.filter("family_id = 'hot'").select("split").distinct().count() == 1
    assert out.count() == 3000


def test_stratified_and_hash(spark):
    rows = _families(spark, 300)
    out = split.split_stratified(rows).select("family_id", "source", "split").distinct()
    counts = {(r.source, r.split): r["count"] for r in out.groupBy("source", "split").count().collect()}
    assert counts == {("a", "train"): 70, ("a", "val"): 15, ("a", "test"): 15,
                      ("b", "train"): 140, ("b", "val"): 30, ("b", "test"): 30}
    small = split.split_by_hash(rows).filter("family_id < 'f_2'").collect()
    again = split.split_by_hash(rows.filter("family_id < 'f_2'")).collect()
    assert sorted(small) == sorted(again)
    folds = split.assign_folds(rows, 5).select("family_id", "fold").distinct()
    assert folds.count() == 300 and {r.fold for r in folds.collect()} == set(range(5))


def test_dedup(make_rows):
    rows = make_rows([
        ("train", "f1", "T1", "same"), ("train", "f2", "T1", "same"), ("train", "f3", "T2", "same"),
        ("val", "f4", "T1", "same"), ("val", "f5", "T1", "other"),
    ])
    once = dedup.dedup_within_split(rows)
    assert sorted(r.id for r in once.collect()) == ["f1__T1", "f3__T2", "f4__T1", "f5__T1"]
    assert sorted(dedup.dedup_within_split(once).collect()) == sorted(once.collect())
    assert sorted(r.id for r in dedup.dedup_global(rows).collect()) == ["f1__T1", "f5__T1"]
    assert sorted(r.id for r in dedup.dedup_global(rows, ("text", "label")).collect()) == ["f1__T1", "f3__T2", "f5__T1"]
    assert {tuple(r) for r in dedup.dedup_counts(rows).collect()} == {("train", 3, 2, 1), ("val", 2, 2, 0)}


def test_dedup_prunes_copies_before_the_shuffle(make_rows):
    plan = dedup.dedup_within_split(make_rows([("train", "f", "T1", "x")]))._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange hash")
    assert "WindowGroupLimit" in plan and exchange < partial  # printed from the top: the limit is below the shuffle


def test_manifest(spark, make_rows, tmp_path):
    rows = make_rows([("train", "f1", "T1", "one two"), ("train", "f1", "T2", "three"), ("test", "f2", "T1", "abc")])
    wide = man.manifest_wide(rows)
    tidy = {(r.metric, r.split, r.label): r.value for r in man.manifest_tidy(wide).collect()}
    assert tidy["total_rows", "", ""] == 3 and tidy["total_families", "", ""] == 2
    assert tidy["rows_per_label_per_split", "val", "T3"] == 0 and tidy["avg_len_char_per_split", "val", ""] == 0.0
    assert tidy["avg_len_char_per_split", "train", ""] == 6.0
    digest = man.fingerprint(rows)
    writers.write_record(man.manifest_record(wide, digest.select("families_hash_sha1").scalar()), str(tmp_path / "m"))
    back = readers.read_manifest(spark, str(tmp_path / "m"))
    import hashlib
    digests = sorted(hashlib.sha1(f).hexdigest() for f in (b"f1", b"f2"))
    whole = "".join(hashlib.sha1(d.encode()).hexdigest() for d in digests)
    assert back.first().families_hash_sha1 == hashlib.sha1(whole.encode()).hexdigest()
    assert {(r.metric, r.split, r.label): r.value for r in man.tidy_from_record(back).collect()} == tidy
    checks = man.reconcile(man.manifest_tidy(wide), man.tidy_from_record(back)).collect()
    assert {c.status for c in checks if c.metric != "split_ratio"} == {"ok"}
    assert {c.status for c in checks if c.metric == "split_ratio"} == {"warning"}


def test_manifest_counts_families_without_id(spark, make_rows):
    rows = make_rows([("train", "f1", "T1", "one")])
    wide = spark.createDataFrame([("f1",), ("",)], "family_id string")
    assert man.manifest_wide(rows, wide=wide).first()["dropped_missing_family_id"] == 1


def test_fingerprint_order(spark, make_rows):
    entries = [("train", f"f{i}", "T1", "x") for i in range(20)]
    a = man.fingerprint(make_rows(entries)).first()
    b = man.fingerprint(make_rows(entries[::-1]).repartition(7)).first()
    assert a == b and a.families_hash_sha1
    assert man.fingerprint(make_rows(entries[1:])).first().families_hash_sha1 != a.families_hash_sha1
    assert man.fingerprint(make_rows([])).first().families_hash_sha1 is None


def test_reconcile_finds_differences(make_rows):
    a = man.manifest_tidy(man.manifest_wide(make_rows([("train", "f1", "T1", "x")])))
    b = man.manifest_tidy(man.manifest_wide(make_rows([("train", "f1", "T2", "xyz")])))
    status = {(c.metric, c.split, c.label): c.status for c in man.reconcile(a, b).collect()}
    assert status["total_rows", "", ""] == "ok" and status["rows_per_label_per_split", "train", "T1"] == "error"
    assert status["avg_len_char_per_split", "train", ""] == "warning"


def test_write_corpus(spark, raw_dir, tmp_path):
    raw = readers.read_raw_dir(spark, raw_dir)
    out = str(tmp_path / "out")
    with pytest.raises(val.CorpusInvalid):
        build.write_corpus(raw, out)
    rows = build.write_corpus(raw, out, strict=False)
    back = readers.load_splits(spark, f"{out}/rows")
    assert sorted(back.collect()) == sorted(rows.select(back.columns).collect())
    assert readers.read_manifest(spark, f"{out}/manifest").first().num_dropped_rows == {
        "missing_family_id": 0, "empty_text": 1, "too_long": 1}
    assert "f0" not in {r.family_id for r in back.collect()}


def test_write_corpus_reads_its_input_once(spark, raw_dir, tmp_path):
    raw = readers.read_raw_dir(spark, raw_dir)
    rows = raw.count()
    seen = spark.sparkContext.accumulator(0)

    def watch(value):
        seen.add(1)
        return value

    watched = raw.withColumn("idx", F.udf(watch, "string").asNondeterministic()("idx"))
    build.write_corpus(watched, str(tmp_path / "out"), strict=False)
    assert seen.value == rows


def test_families_without_an_id_are_counted_once(spark):
    kind = "family_id string, source string, T1 string, T2 string, T3 string, T4 string"
    wide = spark.createDataFrame([("", "s", "a", "b", None, ""), ("", "s", None, None, None, None), ("f", "s", "a", " ", None, "d")], kind)
    staged, dropped = build._counted_stage(wide, 4000)
    assert dropped == {"missing_family_id": 2, "empty_text": 0, "too_long": 0, "null_or_blank": 2, "classified": 4}
    assert sorted(r.id for r in staged.filter("drop_reason IS NULL").collect()) == ["f__T1", "f__T4"]
    assert sorted(staged.collect()) == sorted(fam.classify_rows(wide).collect())


def test_broken_rules_stop_a_strict_build(spark, raw_dir, tmp_path):
    raw = readers.read_raw_dir(spark, raw_dir)
    with pytest.raises(val.CorpusInvalid, match="source_known"):
        build.write_corpus(raw, str(tmp_path / "out"), sources=("nowhere",))


def test_manifest_cells_equal_the_wide_manifest(spark, sf):
    from checks import fixtures as fx

    corpus = build.build_corpus(fx.raw_records(spark, sf), staged=True)
    wide = man.manifest_tidy(corpus.manifest_wide())
    cells = man.manifest_cells(corpus.rows, corpus.dropped)
    assert sorted(cells.select(wide.columns).collect()) == sorted(wide.collect())
    assert corpus.dropped.items() >= {r.drop_reason: r.n for r in fam.drop_counts(corpus.wide, corpus.classified).collect()}.items()
    empty = {(r.metric, r.split, r.label): r.value for r in man.manifest_cells(corpus.rows.limit(0)).collect()}
    assert len(empty) == cells.count() and set(empty.values()) == {0.0}
    leaky = man.manifest_cells(fx.leaky(spark, sf))
    assert leaky.filter("metric = 'total_families'").first().value == fx.leaky(spark, sf).select("family_id").distinct().count()
    many = [f"L{i}" for i in range(300)]
    plans = [len(man.manifest_cells(corpus.rows, labels=l)._jdf.queryExecution().optimizedPlan().toString().splitlines()) for l in (many, many[:2])]
    assert plans[0] == plans[1]


def test_build_modes_agree(spark, sf):
    from checks import fixtures as fx

    raw = fx.raw_records(spark, sf)
    lazy, staged = (build.build_corpus(raw, staged=s) for s in (False, True))
    assert sorted(lazy.rows.collect()) == sorted(staged.rows.collect())
    assert sorted(man.manifest_tidy(lazy.manifest_wide()).collect()) == sorted(man.manifest_tidy(staged.manifest_wide()).collect())
    closed = build.build_corpus(raw, deduplicate="global").rows
    assert closed.groupBy("text").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    assert dist.families_per_split(lazy.rows).count() == 4


def test_data_location(monkeypatch):
    monkeypatch.delenv("DATA_ROOT", raising=False)
    assert readers.data_location("raw") == "raw"
    monkeypatch.setenv("DATA_ROOT", "s3a://bucket/data/")
    assert readers.data_location("raw") == "s3a://bucket/data/raw"
    assert readers.data_location("/abs") == "/abs"


def test_spread_keeps_large_scans(spark):
    many, few = spark.range(100, numPartitions=16), spark.range(100, numPartitions=1)
    assert readers.spread(many).rdd.getNumPartitions() == 16
    assert readers.spread(few).rdd.getNumPartitions() == 8
