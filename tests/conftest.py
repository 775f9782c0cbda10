import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def make_rows(spark):
    """Final rows from (split, family, label, text) tuples."""
    from corpuswright.schema import LABELS, SPLIT_ROW_SCHEMA

    def build(entries, source="mrpc"):
        rows = []
        for split, family, label, text in entries:
            label_id = LABELS.index(label) if label in LABELS else None
            rows.append((f"{family}__{label}", family, source, text, label, label_id,
                         len(text), len(text.split()), split))
        return spark.createDataFrame(rows, SPLIT_ROW_SCHEMA)

    return build
