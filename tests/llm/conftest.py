import pytest

from tests.conftest import make_rows, sf, spark  # noqa: F401 - shared fixtures

LONG = "Lorem ipsum dolor sit amet. " * 20_000


@pytest.fixture(scope="session")
def edge_docs(spark):  # noqa: F811
    """Nulls, blanks, very long and repeated rows, and columns with names the operators use."""
    rows = [
        (1, "The cat sat on the mat. It was warm.", "en", "a"), (1, "The cat sat on the mat. It was warm.", "en", "a"),
        (2, None, "en", None), (3, "", None, "a"), (4, " \n\t ", "en", "a"), (5, "12 34 !!", "en", "a"), (6, LONG, "en", "a"),
        (None, "Der Hund und die Katze.", "de", "a"), (None, None, None, None), (7, "<|endoftext|> x\u0000y ␛<|", "de", "b"),
        (8, "wort", "de", "b"), (9, "zwei worte", "de", "b"), (10, "e\u0301a \u0130st \U0001F600", "de", "b"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    clashing = ("score", "fingerprint", "component", "item_id", "shard", "rule", "length", "node", "size", "a", "b", "label")
    return frame.withColumns({c: F.lit("x") for c in clashing})
