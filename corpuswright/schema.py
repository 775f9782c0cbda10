"""Label and source domains, field names and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the data contract.
LABELS = ("T1", "T2", "T3", "T4")
SOURCES = ("mrpc", "paws", "hlpc")
SPLITS = ("train", "val", "test")
RAW_TEXT_FIELDS = {
    "human_original_text(type1)": "T1",
    "llm_generated_text(type2)": "T2",
    "human_paraphrased_text(type3)": "T3",
    "llm_paraphrased_original_text(type4)-prompt-based": "T4",
}
ROW_FIELDS = (
    "id", "family_id", "source", "text", "label", "label_id", "text_len_char", "text_len_word",
)
RESULTS_COLUMNS = (
    "model_name", "accuracy", "macro_f1", "f1_T1", "f1_T2", "f1_T3", "f1_T4",
    "precision_macro", "recall_macro", "auroc_ovr",
    "train_time_sec", "latency_ms", "num_params", "seed", "timestamp_utc",
)
DROP_REASONS = ("missing_family_id", "empty_text", "too_long")
DEFAULT_SEED = 42
DEFAULT_RATIOS = {"train": 0.70, "val": 0.15, "test": 0.15}
MAX_TEXT_CHARS = 4000
MIN_CLASS_SHARE = 0.10
LENGTH_BUCKETS = (("short", 0, 50), ("medium", 51, 150), ("long", 151, None))

# idx is read as a string so that 1 and 1.0 keep their spelling in family ids.
RAW_SCHEMA = T.StructType(
    [T.StructField("idx", T.StringType()), T.StructField("dataset_source", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in RAW_TEXT_FIELDS]
)

ROW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("family_id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("label_id", T.IntegerType()),
    T.StructField("text_len_char", T.IntegerType()),
    T.StructField("text_len_word", T.IntegerType()),
])

SPLIT_ROW_SCHEMA = T.StructType(ROW_SCHEMA.fields + [T.StructField("split", T.StringType())])

_COUNT_MAP = T.MapType(T.StringType(), T.LongType())
_MEAN_MAP = T.MapType(T.StringType(), T.DoubleType())

MANIFEST_SCHEMA = T.StructType([
    T.StructField("created_at_utc", T.StringType()),
    T.StructField("seed", T.LongType()),
    T.StructField("split_ratios", _MEAN_MAP),
    T.StructField("total_rows", T.LongType()),
    T.StructField("total_families", T.LongType()),
    T.StructField("rows_per_split", _COUNT_MAP),
    T.StructField("rows_per_label_per_split", T.MapType(T.StringType(), _COUNT_MAP)),
    T.StructField("avg_len_char_per_split", _MEAN_MAP),
    T.StructField("avg_len_word_per_split", _MEAN_MAP),
    T.StructField("num_dropped_rows", _COUNT_MAP),
    T.StructField("families_hash_sha1", T.StringType()),
])
