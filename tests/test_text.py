import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpuswright.functions import scalar, text as tx

CASES = [
    "", "   ", "plain", "a\u00a0b", "a\u2003b", "tab\t\tand\n\nnewline", "x\u0085y", "x\u001cy", "zero\u200bwidth",
    "soft\u00adhyphen", "\ufeffbom", "\ufb01ne", "\uff11\uff12\uff13", "e\u0301t\u00e9", "\U0001f600 ok",
    "\u0001\u0002", "a \u0000 b", "\u00bd \u2026", "na\u00efve r\u00e9sum\u00e9", "\u0130stanbul", "\u1100\u1161",
    " lead and trail ", "\u4e2d\u6587 \u6587", "\u043f\u0440\u0438\u0439", "a\u0378b", "\u2028x", "\u00e9\u0323", "\u3042\u3099",
]


def spec(text):
    """The normalisation contract as a scan over the composed characters."""
    out, gap = [], False
    for c in unicodedata.normalize("NFKC", text):
        if c.isspace():
            gap = bool(out)
        elif unicodedata.category(c)[0] != "C":
            out += [" ", c] if gap else [c]
            gap = False
    return "".join(out)


def apply(spark, values, fn, kind="string"):
    frame = spark.createDataFrame(list(enumerate(values)), f"n int, text {kind}")
    rows = frame.select("n", fn(F.col("text")).alias("out")).collect()
    return [r.out for r in sorted(rows)]


def test_normalize_cases(spark):
    assert apply(spark, CASES, tx.normalize_text) == [spec(t) for t in CASES]
    assert apply(spark, [None], tx.normalize_text) == [""]


def test_normalize_random_and_idempotent(spark):
    rng = random.Random(7)
    pool = [chr(c) for c in (*range(0, 0x180), *range(0x300, 0x320), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070),
                             *range(0x3041, 0x30FF), *range(0xFB00, 0xFB07), 0x1F600, 0xAC00, 0x1161, 0x11A8)]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    once = apply(spark, texts, tx.normalize_text)
    assert once == [spec(t) for t in texts]
    assert apply(spark, once, tx.normalize_text) == [spec(t) for t in once]


def test_strip_accents_matches_decomposition(spark):
    texts = [chr(c) for c in range(0xA1, 0x250)] + [chr(c) for c in range(0x1E00, 0x1F00)] + ["\u043f\u0440\u0438\u0439", "\ufb01", "\u212b", "\uac00", "e\u0301"]
    expected = ["".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)) for t in texts]
    assert apply(spark, texts, tx.strip_accents) == expected


def test_blank_and_lengths(spark):
    assert apply(spark, ["", " \t", "\u00a0\u2003", "x", None], tx.is_blank) == [True, True, True, False, True]
    assert apply(spark, ["", "one", "two words", "\u00e9 \U0001f600 c"], tx.word_count) == [0, 1, 2, 3]


def test_tokens_ngrams_and_stop_words(spark):
    tokens = lambda t: tx.analyzer_tokens(t)
    assert apply(spark, ["A caf\u00e9 \u00e9t\u00e9_1 b", "x", ""], tokens) == [["cafe", "ete_1"], [], []]
    grams = lambda t: tx.ngrams(tx.analyzer_tokens(t))
    assert apply(spark, ["aa bb cc", "aa", ""], grams) == [["aa", "bb", "cc", "aa bb", "bb cc"], ["aa"], []]
    kept = lambda t: tx.remove_words(tx.analyzer_tokens(t), ["bb"])
    assert apply(spark, ["aa bb cc bb"], kept) == [["aa", "cc"]]


def test_jaccard(spark):
    frame = spark.createDataFrame([("a b c", "C b A"), ("a b", "c d"), ("", "  "), ("a a b", "b")], "l string, r string")
    scores = [r[0] for r in frame.select(tx.jaccard(tx.word_set(F.col("l")), tx.word_set(F.col("r")))).collect()]
    assert scores == [1.0, 0.0, 0.0, 0.5]


def test_labels_slug_preview_bucket(spark):
    assert apply(spark, ["T1", "T4", "T9", None], lambda c: tx.encode_label(c, ["T1", "T2", "T3", "T4"])) == [0, 3, None, None]
    assert apply(spark, [0, 3, 4], lambda c: tx.decode_label(c, ["T1", "T2", "T3", "T4"]), "int") == ["T1", "T4", None]
    assert apply(spark, ["a/b/c"], tx.slug) == ["a-b-c"]
    assert apply(spark, ["x" * 5, "x" * 6], lambda c: tx.preview(c, 5)) == ["xxxxx", "xxxxx..."]
    buckets = (("short", 0, 50), ("medium", 51, 150), ("long", 151, None))
    assert apply(spark, [0, 50, 51, 150, 151], lambda c: tx.length_bucket(c, buckets), "int") == [
        "short", "short", "medium", "medium", "long"]


def test_perturbations(spark):
    assert apply(spark, ["It's (fine), no?"], tx.remove_punctuation) == ["Its fine no"]
    assert apply(spark, ["the cat the"], lambda c: tx.swap_synonyms(c, {"the": "a"})) == ["a cat a"]


def test_argmax_first_wins_and_efficiency(spark):
    frame = spark.createDataFrame([([1.0, 3.0, 3.0],), ([0.0, -1.0, -2.0],)], "s array<double>")
    assert [r[0] for r in frame.select(scalar.argmax(F.col("s"))).collect()] == [1, 0]
    row = spark.range(1).select(
        scalar.throughput(F.lit(10), F.lit(4.0)), scalar.throughput(F.lit(10), F.lit(0.0)), scalar.megabytes(F.lit(1572864))).first()
    assert tuple(row) == (2.5, 0.0, 1.5)


def test_exotic_texts_only_reach_python(spark):
    plan = spark.range(1).select(F.lit("x").alias("text")).select(tx.normalize_text(F.col("text")))
    assert plan._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") <= 1


@pytest.mark.parametrize("name,value", [("utc_now", r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z")])
def test_timestamp_format(spark, name, value):
    assert re.fullmatch(value, spark.range(1).select(scalar.utc_now()).first()[0])
