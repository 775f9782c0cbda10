"""A text is split once, however many words it has."""

import time

from checks.queries import QUERIES


def test_large_lexicon_splits_a_text_once(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(790))
    rows = [(i, text[:3990].rsplit(" ", 1)[0] + f" x{i}", "en", "web") for i in range(0, 400)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    started = time.perf_counter()
    assert QUERIES["perturb_synonym_large"](spark, str(tmp_path)).count() > 0
    assert time.perf_counter() - started < 30
