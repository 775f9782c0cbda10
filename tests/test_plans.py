import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from corpuswright.operators import distributions as dist, leakage, manifest as man, metrics as met, similarity


def physical(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def lines(frame, node):
    return [line for line in physical(frame).splitlines() if node in line]


@pytest.fixture(scope="module")
def splits(spark, sf):
    return fx.split_rows(spark, sf)


@pytest.mark.parametrize("build", [
    lambda d: d, dist.class_distribution, dist.length_stats, dist.ecdf, leakage.exact_text_overlap,
    lambda d: man.manifest_tidy(man.manifest_wide(d)), similarity.jaccard_pairs, similarity.cosine_pairs,
])
def test_no_cross_joins(splits, build):
    plan = physical(build(splits))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_split_adds_no_shuffle(spark, sf, splits):
    assert physical(splits).count("Exchange") == physical(fx.rows(spark, sf)).count("Exchange")


def test_text_is_normalised_once(splits):
    kept = splits.filter((F.col("split") == "train") & (F.col("text_len_char") > 3))
    assert physical(kept).count("ArrowEvalPython") == 1


def test_scans_read_only_needed_columns(splits):
    scan = [line for line in physical(splits).splitlines() if "documents.parquet" in line][0]
    assert "lang" not in scan and "n_chars" not in scan
    chats = [line for line in physical(splits).splitlines() if "conversations.parquet" in line][0]
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint,text:string>" in chats


def test_digests_travel_instead_of_texts(splits):
    shuffles = lines(leakage.exact_text_overlap(splits), "Exchange hashpartitioning")
    assert shuffles and not any("text#" in line.split("hashpartitioning(")[1] for line in shuffles if "key#" in line)


def test_counts_are_combined_before_the_shuffle(spark, sf):
    for frame in (met.confusion_matrix(fx.predictions(spark, sf)), dist.length_census(fx.all_rows(spark, sf), "text_len_word", ["label"])):
        assert "partial_" in physical(frame)


def test_loading_one_split_prunes_folders(spark, splits, tmp_path):
    from corpuswright.sources import readers, writers

    path = str(tmp_path / "rows")
    writers.write_splits(splits, path, "parquet")
    one = readers.load_splits(spark, path, "parquet").filter(F.col("split") == "val")
    assert "PartitionFilters: [isnotnull(split" in physical(one)
    assert one.count() == splits.filter("split = 'val'").count()
