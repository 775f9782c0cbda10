"""Texts are normalised without regular expressions over every character."""

from pyspark.sql import functions as F

from corpuswright.functions import text as tx


def test_normalising_and_word_sets_need_no_regular_expression(spark):
    frame = spark.createDataFrame([("b \x01a B\n a",), (None,)], "text string")
    found = frame.select(tx.normalize_text(F.col("text")).alias("n"), tx.word_set(F.col("text")).alias("w"))
    assert "regexp" not in found._jdf.queryExecution().executedPlan().toString().lower()
    assert [r.n for r in found.collect()] == ["b a B a", ""]
