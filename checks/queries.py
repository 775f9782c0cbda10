"""Registered queries: the library's operators over the provided tables, and for each the
DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from checks import fixtures as fx
from checks.sql import FIELDS, SOURCES_SQL, byte, lexicon_swap, noisy, norm, side, sql, texts, words_of
from corpuswright.functions import text as tx
from corpuswright.functions.scalar import argmax, megabytes, throughput
from corpuswright.operators import (
    cross_validation as cv, dedup, distributions as dist, encoding, families as fam, leakage, manifest as man, metrics as met,
    minhash, models, sampling, similarity, sketches, split, synonyms, tfidf, validation as val,
)
from corpuswright.plans import audit, baseline, build
from corpuswright.schema import LABELS, LENGTH_BUCKETS, ROW_FIELDS, SPLITS
from corpuswright.sources import readers, writers
from corpuswright.sources.staging import new_location, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLE[fn.__name__] = sql(oracle)
        return fn

    return register


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison between engines; -0.0 becomes 0.0."""
    return frame.select(*[
        (F.round(F.col(f.name), digits) + 0.0).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in frame.schema.fields
    ])


# ---------------------------------------------------------------- sources and sinks

_RAW = [f"`{f}`" for f in fx.RAW_FIELDS]


def _raw_named(raw: DataFrame) -> DataFrame:
    return raw.select("idx", "dataset_source", *[F.col(c).alias(f"t{i}") for i, c in enumerate(_RAW)])


_RAW_CHATS = "SELECT idx, source AS dataset_source, t0, t1, t2, t3 FROM chats"
_RAW_ALL = "SELECT idx, lower(source) AS dataset_source, t0, t1, t2, t3 FROM (SELECT * FROM chats UNION ALL SELECT * FROM docs)"


def _write_arrays(spark, sf, path: str) -> None:
    # The records of at most 1,000 conversations per array; idx is "conversation.part".
    block = F.floor(F.substring_index("idx", ".", 1).cast("long") / 1000)
    arrays = fx.chat_records(spark, sf).groupBy(block.alias("block")).agg(
        F.to_json(F.collect_list(F.struct("idx", "dataset_source", *_RAW))).alias("value"))
    arrays.write.partitionBy("block").text(path)


@query(_RAW_CHATS)
def read_json_array(spark, sf):
    path = new_location(spark, "arrays")
    _write_arrays(spark, sf, path)
    return _raw_named(readers.read_json_array(spark, path, pattern="*.txt"))


@query(_RAW_ALL)
def read_jsonl(spark, sf):
    path = new_location(spark, "lines")
    fx.raw_records(spark, sf).select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return _raw_named(readers.read_jsonl(spark, path, pattern="*.txt"))


@query(_RAW_ALL)
def read_raw_dir(spark, sf):
    """Conversations as one record per .json file group, documents as .jsonl files."""
    path = new_location(spark, "raw")
    arrays, lines = new_location(spark, "arrays"), new_location(spark, "lines")
    _write_arrays(spark, sf, arrays)
    fx.document_records(spark, sf).select(F.to_json(F.struct("*")).alias("value")).write.text(lines)
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(hadoop.Path(path))
    for i, (pattern, suffix) in enumerate(((f"{arrays}/*/*.txt", "json"), (f"{lines}/*.txt", "jsonl"))):
        for j, status in enumerate(system.globStatus(hadoop.Path(pattern))):
            system.rename(status.getPath(), hadoop.Path(f"{path}/part-{i}-{j}.{suffix}"))
    return _raw_named(readers.read_raw_dir(spark, path))


@query(f"SELECT {FIELDS}, split FROM cor")
def load_splits(spark, sf):
    path = new_location(spark, "splits")
    writers.write_splits(fx.corpus(spark, sf), path, "parquet")
    return readers.load_splits(spark, path, "parquet")


@query(f"SELECT {FIELDS}, split FROM cor")
def jsonl_roundtrip(spark, sf):
    path = new_location(spark, "jsonl")
    writers.write_splits(fx.corpus(spark, sf), path, "json")
    return readers.load_splits(spark, path, "json")


_MANIFEST_SQL = """
SELECT 'total_rows' AS metric, '' AS split, '' AS label, CAST(count(*) AS DOUBLE) AS value FROM {0}
UNION ALL SELECT 'total_families', '', '', count(DISTINCT family_id) FROM {0}
UNION ALL SELECT 'rows_per_split', s, '', (SELECT count(*) FROM {0} WHERE split = s)
  FROM unnest(['train', 'val', 'test']) u(s)
UNION ALL SELECT 'rows_per_label_per_split', s, l, (SELECT count(*) FROM {0} WHERE split = s AND label = l)
  FROM unnest(['train', 'val', 'test']) u(s), unnest(['T1', 'T2', 'T3', 'T4']) v(l)
UNION ALL SELECT 'avg_len_char_per_split', s, '', (SELECT coalesce(round(avg(text_len_char), 2), 0) FROM {0} WHERE split = s)
  FROM unnest(['train', 'val', 'test']) u(s)
UNION ALL SELECT 'avg_len_word_per_split', s, '', (SELECT coalesce(round(avg(text_len_word), 2), 0) FROM {0} WHERE split = s)
  FROM unnest(['train', 'val', 'test']) u(s)
UNION ALL SELECT 'num_dropped_rows', '', d, (SELECT count(*) FROM cls WHERE drop_reason = d)
  FROM unnest(['missing_family_id', 'empty_text', 'too_long']) u(d)"""


@query(_MANIFEST_SQL.format("cor"))
def manifest(spark, sf):
    corpus = build.build_corpus(fx.raw_records(spark, sf), staged=True)
    return man.manifest_cells(corpus.rows, corpus.dropped)


@query("""SELECT d AS drop_reason, (SELECT count(*) FROM cls WHERE drop_reason = d) AS n
  FROM unnest(['missing_family_id', 'empty_text', 'too_long', 'null_or_blank']) u(d)
  UNION ALL SELECT 'classified', count(*) FROM cls""")
def staged_drops(spark, sf):
    """Drop counters of a build that reads its input once."""
    corpus = build.build_corpus(fx.raw_records(spark, sf), staged=True)
    return spark.createDataFrame(sorted(corpus.dropped.items()), "drop_reason string, n long")


def _within(estimate: str, exact: str, error: float) -> Column:
    return F.abs(F.col(estimate) - F.col(exact)) <= F.col(exact) * error + 1


@query("""SELECT split, count(*) AS rows, TRUE AS families_ok, TRUE AS chars_ok, TRUE AS words_ok, TRUE AS share_ok
  FROM spl GROUP BY split""")
def sketch_summary(spark, sf):
    """Sketches of two parts of the corpus, merged, beside exact answers: all within their errors."""
    rows = fx.split_rows(spark, sf)
    parts = [sketches.sketch_states(rows.filter(F.crc32(F.col("family_id").cast("binary")) % 3 == i)) for i in range(3)]
    states = stage(parts[0].unionByName(parts[1]).unionByName(parts[2]), "sketches")
    found = sketches.sketch_answers(sketches.merge_states(states))
    # Rank of the estimated median within the exact order.
    ranks = rows.join(F.broadcast(found.select("split", "chars_p50", "words_p50")), "split").groupBy("split").agg(
        F.count_distinct("family_id").alias("exact"), F.avg((F.col("text_len_word") <= 256).cast("double")).alias("share"),
        *[F.avg((F.col(f"text_len_{s[:-1]}") < F.col(f"{s}_p50")).cast("double")).alias(f"{s}_below") for s in ("chars", "words")],
        *[F.avg((F.col(f"text_len_{s[:-1]}") <= F.col(f"{s}_p50")).cast("double")).alias(f"{s}_upto") for s in ("chars", "words")])
    slack = sketches.RANK_ERROR
    return found.join(ranks, "split").select(
        "split", "rows", _within("families", "exact", sketches.DISTINCT_ERROR).alias("families_ok"),
        *[((F.col(f"{s}_below") <= 0.5 + slack) & (F.col(f"{s}_upto") >= 0.5 - slack)).alias(f"{s}_ok") for s in ("chars", "words")],
        (F.abs(F.col("share_within") - F.col("share")) <= slack).alias("share_ok"))


_EXACT = "('total_rows', 'rows_per_split', 'rows_per_label_per_split')"
_MEANS = "('avg_len_char_per_split', 'avg_len_word_per_split')"


@query(f"""
SELECT metric, split, label, round(actual, 6) AS actual, round(declared, 6) AS declared, severity,
  CASE WHEN ok THEN 'ok' ELSE severity END AS status FROM (
  SELECT metric, split, label, a.value AS actual, d.value AS declared,
    CASE WHEN metric IN {_MEANS} THEN 'warning' ELSE 'error' END AS severity,
    CASE WHEN metric IN {_MEANS} THEN coalesce(abs(a.value - d.value) < CAST(0.1 AS DOUBLE), false)
      ELSE a.value IS NOT DISTINCT FROM d.value END AS ok
  FROM (SELECT * FROM ({_MANIFEST_SQL.format("cor")}) WHERE metric IN {_EXACT} OR metric IN {_MEANS}) a
  FULL JOIN (SELECT * FROM ({_MANIFEST_SQL.format("spl")}) WHERE metric IN {_EXACT} OR metric IN {_MEANS}) d
  USING (metric, split, label)
  UNION ALL
  SELECT 'split_ratio', s, '', share, expected, 'warning', abs(share - expected) < CAST(0.02 AS DOUBLE) FROM (
    SELECT s, expected, (SELECT count(*) FROM cor WHERE split = s) / (SELECT CAST(count(*) AS DOUBLE) FROM cor) AS share
    FROM (VALUES ('train', CAST(0.7 AS DOUBLE)), ('val', 0.15), ('test', 0.15)) v(s, expected)))""")
def manifest_check(spark, sf):
    """The corpus against a manifest file that was written before duplicates were removed."""
    before = fx.split_rows(spark, sf)
    record = man.manifest_record(man.manifest_wide(before), F.lit(None).cast("string"))
    path = new_location(spark, "manifest")
    writers.write_record(record, path)
    declared = man.tidy_from_record(readers.read_manifest(spark, path))
    actual = man.manifest_tidy(man.manifest_wide(fx.corpus(spark, sf)))
    return rounded(man.reconcile(actual, declared))


@query("""SELECT (SELECT count(DISTINCT family_id) FROM cor) AS total_families,
  (SELECT sha1(string_agg(d, '' ORDER BY b)) FROM (SELECT substr(h, 1, 4) AS b, sha1(string_agg(h, '' ORDER BY h)) AS d
    FROM (SELECT DISTINCT sha1(family_id) AS h FROM cor) GROUP BY 1)) AS families_hash_sha1,
  (SELECT sha1(concat_ws(':', """ + ", ".join(
      f"CAST(sum(CAST('0x' || substr(sha1(family_id), {1 + 6 * i}, 6) AS BIGINT)) AS BIGINT)" for i in range(6)
  ) + ")) FROM (SELECT DISTINCT family_id FROM cor)) AS families_hash_sum")
def families_fingerprint(spark, sf):
    return man.fingerprint(fx.corpus(spark, sf))


# ---------------------------------------------------------------- raw records to rows

@query("SELECT family_id, source, t0 AS \"T1\", t1 AS \"T2\", t2 AS \"T3\", t3 AS \"T4\" FROM fam")
def families(spark, sf):
    return fx.wide(spark, sf)


@query(f"SELECT {FIELDS} FROM mat")
def materialize_rows(spark, sf):
    return fx.rows(spark, sf)


@query("""SELECT d AS drop_reason, (SELECT count(*) FROM cls WHERE drop_reason = d) AS n
  FROM unnest(['missing_family_id', 'empty_text', 'too_long', 'null_or_blank']) u(d)""")
def drop_counts(spark, sf):
    return fam.drop_counts(fx.wide(spark, sf), fx.classified(spark, sf))


@query("""SELECT dropped, kept, round(dropped / CAST(dropped + kept AS DOUBLE), 6) AS drop_rate,
  dropped / CAST(dropped + kept AS DOUBLE) > CAST(0.05 AS DOUBLE) AS alert
  FROM (SELECT count(*) FILTER (WHERE drop_reason IN ('too_long', 'empty_text')) AS dropped,
    count(*) FILTER (WHERE drop_reason IS NULL) AS kept FROM cls)""")
def drop_rate_check(spark, sf):
    drops = fam.drop_counts(fx.wide(spark, sf), fx.classified(spark, sf))
    return rounded(dist.drop_rate_check(drops, fx.rows(spark, sf)))


@query("SELECT id, label, label_id, 'T' || (label_id + 1) AS decoded FROM mat")
def label_codec(spark, sf):
    return fx.rows(spark, sf).select(
        "id", "label", tx.encode_label(F.col("label"), LABELS).alias("label_id"),
        tx.decode_label(F.col("label_id"), LABELS).alias("decoded"))


@query(f"SELECT {FIELDS} FROM mat ORDER BY id LIMIT 50")
def capped_rows(spark, sf):
    return fam.cap_rows(fx.rows(spark, sf), 50)


@query(f"""SELECT id, text_len_char > 4000 AS over_length, trim(substr(text, 1, 4000)) AS text,
  CAST(length(trim(substr(text, 1, 4000))) AS INTEGER) AS text_len_char,
  CAST({words_of("trim(substr(text, 1, 4000))")} AS INTEGER) AS text_len_word FROM alr""")
def length_policy(spark, sf):
    return fam.apply_length_policy(fx.all_rows(spark, sf), "truncate").select(
        "id", "over_length", "text", "text_len_char", "text_len_word")


@query(f"""SELECT doc_id AS key, {norm('text')} AS text FROM documents
  UNION ALL SELECT -conv_id * 100 - turn - 1, {norm('text')} FROM conversations
  UNION ALL SELECT 1000000000000 + page_id, {norm('html')} FROM pages""")
def normalize_text(spark, sf):
    frames = [
        fx.table(spark, sf, "documents").select(F.col("doc_id").alias("key"), "text"),
        fx.table(spark, sf, "conversations").select((-F.col("conv_id") * 100 - F.col("turn") - 1).alias("key"), "text"),
        fx.table(spark, sf, "pages").select((F.col("page_id") + 1000000000000).alias("key"), F.col("html").alias("text")),
    ]
    every = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return every.select("key", tx.normalize_text(F.col("text")).alias("text"))


@query("SELECT id, text_len_char, text_len_word FROM alr")
def text_lengths(spark, sf):
    return fx.all_rows(spark, sf).select(
        "id", F.char_length("text").cast("int").alias("text_len_char"),
        tx.word_count(F.col("text")).cast("int").alias("text_len_word"))


@query("SELECT id, lower(text) AS text FROM mat")
def perturb_lower(spark, sf):
    return met.perturbed_rows(fx.rows(spark, sf), fx.LEXICON).filter(
        F.col("perturbation") == "lowercase").select("id", "text")


@query(r"SELECT id, regexp_replace(text, '[!-/:-@\[-`{-~]', '', 'g') AS text FROM mat")
def perturb_nopunct(spark, sf):
    return fx.rows(spark, sf).select("id", tx.remove_punctuation(F.col("text")).alias("text"))


@query(f"SELECT id, {lexicon_swap('text')} AS text FROM mat")
def perturb_synonym(spark, sf):
    return fx.rows(spark, sf).select("id", tx.swap_synonyms(F.col("text"), fx.LEXICON).alias("text"))


# Words and pairs of neighbours of the corpus, chosen by their digests.
_WORD_HIT, _PAIR_HIT = "substr(md5({0}), 1, 1) = '7'", "substr(md5({0}), 1, 1) IN ('3', '9')"


@query(f"""SELECT id, array_to_string(list(CASE WHEN start THEN '{{' || w || '+' || following || '}}'
    WHEN {_WORD_HIT.format('w')} THEN '<' || w || '>' ELSE w END ORDER BY i) FILTER (WHERE NOT eaten), ' ') AS text FROM (
  SELECT *, lag(start, 1, FALSE) OVER (PARTITION BY id ORDER BY i) AS eaten FROM (
    SELECT *, hit AND (i - island) % 2 = 1 AS start FROM (
      SELECT *, coalesce(max(CASE WHEN NOT hit THEN i END) OVER (PARTITION BY id ORDER BY i), 0) AS island FROM (
        SELECT id, i, w, following, following IS NOT NULL AND coalesce({_PAIR_HIT.format("w || ' ' || following")}, FALSE) AS hit FROM (
          SELECT id, i, t[i] AS w, t[i + 1] AS following FROM (
            SELECT id, string_split(text, ' ') AS t, unnest(range(1, len(string_split(text, ' ')) + 1)) AS i FROM mat))))))
  GROUP BY id""")
def perturb_synonym_large(spark, sf):
    """Synonym swap through a lexicon of words and neighbouring pairs taken from the corpus itself."""
    rows = stage(fx.rows(spark, sf).select("id", "text"), "rows")
    # Split once per text: within the lambda an expression would be split again for every word.
    split_rows = rows.select(tx.evaluate_once(F.split("text", " ")).alias("words"))
    words = F.col("words")
    pairs = F.transform(F.slice(words, 1, F.size(words) - 1), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    singles = split_rows.select(F.explode(F.array_distinct(words)).alias("phrase")).distinct().filter(_WORD_HIT.format("phrase")).select(
        "phrase", F.concat(F.lit("<"), "phrase", F.lit(">")).alias("replacement"))
    doubles = split_rows.select(F.explode(F.array_distinct(pairs)).alias("phrase")).distinct().filter(_PAIR_HIT.format("phrase")).select(
        "phrase", F.concat(F.lit("{"), F.replace(F.col("phrase"), F.lit(" "), F.lit("+")), F.lit("}")).alias("replacement"))
    return synonyms.swap_phrases(rows, singles.unionByName(doubles))


@query("""SELECT split, CASE WHEN text_len_word <= 50 THEN 'short' WHEN text_len_word <= 150 THEN 'medium' ELSE 'long' END AS bucket,
  count(*) AS n FROM spl GROUP BY ALL""")
def length_buckets(spark, sf):
    bucket = tx.length_bucket(F.col("text_len_word"), LENGTH_BUCKETS)
    return dist.length_buckets(fx.split_rows(spark, sf), bucket)


# ---------------------------------------------------------------- splits and duplicates

@query("SELECT id, family_id, split FROM spl")
def group_split(spark, sf):
    return fx.split_rows(spark, sf).select("id", "family_id", "split")


@query(f"""SELECT id, source, {side()} AS split FROM mat JOIN (
  SELECT family_id, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || family_id), family_id) AS r,
    count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT family_id, min(source) AS source FROM mat GROUP BY family_id)) USING (family_id)""")
def stratified_split(spark, sf):
    return split.split_stratified(fx.rows(spark, sf)).select("id", "source", "split")


@query("""SELECT id, CASE WHEN u < CAST(0.7 AS DOUBLE) THEN 'train' WHEN u < CAST(0.7 AS DOUBLE) + CAST(0.15 AS DOUBLE) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT id, CAST('0x' || substr(md5('42:' || family_id), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) AS u FROM mat)""")
def hash_split(spark, sf):
    return split.split_by_hash(fx.rows(spark, sf)).select("id", "split")


@query("""SELECT id, CAST(CAST('0x' || substr(md5('fold:42:' || family_id), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM spl WHERE split = 'train'""")
def cv_folds(spark, sf):
    return split.assign_folds(fx.split_rows(spark, sf).filter(F.col("split") == "train")).select("id", "fold")


@query(f"SELECT {FIELDS}, split FROM cor")
def dedup_within_split(spark, sf):
    return fx.corpus(spark, sf)


@query("""SELECT split, CAST(count(*) AS BIGINT) AS rows_before, count(DISTINCT (label, text)) AS rows_after,
  count(*) - count(DISTINCT (label, text)) AS removed FROM spl GROUP BY split""")
def dedup_counts(spark, sf):
    return dedup.dedup_counts(fx.split_rows(spark, sf))


@query(f"""SELECT {FIELDS} FROM mat QUALIFY
  row_number() OVER (PARTITION BY text ORDER BY family_id, id, source) = 1""")
def dedup_global(spark, sf):
    return dedup.dedup_global(fx.rows(spark, sf))


# ---------------------------------------------------------------- distributions

_CELLS = "unnest(['train', 'val', 'test']) u(s)"


@query(f"""SELECT s AS split, l AS label, n, round(CASE WHEN t > 0 THEN n * 100 / CAST(t AS DOUBLE) ELSE 0 END, 6) AS pct FROM (
  SELECT s, l, (SELECT count(*) FROM cor WHERE split = s AND label = l) AS n, (SELECT count(*) FROM cor WHERE split = s) AS t
  FROM {_CELLS}, unnest(['T1', 'T2', 'T3', 'T4']) v(l))""")
def class_distribution(spark, sf):
    return rounded(dist.class_distribution(fx.corpus(spark, sf)))


@query(f"""SELECT s AS split, x AS source, n, round(CASE WHEN t > 0 THEN n * 100 / CAST(t AS DOUBLE) ELSE 0 END, 6) AS pct FROM (
  SELECT s, x, (SELECT count(*) FROM cor WHERE split = s AND source = x) AS n, (SELECT count(*) FROM cor WHERE split = s) AS t
  FROM {_CELLS}, unnest([{SOURCES_SQL}]) v(x))""")
def source_distribution(spark, sf):
    return rounded(dist.source_distribution(fx.corpus(spark, sf), fx.ALL_SOURCES))


def _stats(metric: str) -> str:
    return f"""SELECT split, '{metric}' AS metric, count(*) AS n, round(avg({metric}), 6) AS mean,
      round(quantile_cont({metric}, 0.5), 6) AS median, round(stddev_samp({metric}), 6) AS std,
      CAST(min({metric}) AS BIGINT) AS min, CAST(max({metric}) AS BIGINT) AS max FROM lsp GROUP BY split"""


_ALL_SPLIT = f"""SELECT * FROM (SELECT alr.*, {side()} AS split FROM alr JOIN (
  SELECT family_id, row_number() OVER (ORDER BY md5('42:' || family_id), family_id) AS r, count(*) OVER () AS n
  FROM (SELECT DISTINCT family_id FROM alr)) USING (family_id))"""


def _all_split(spark, sf) -> DataFrame:
    return split.split_by_group(fx.all_rows(spark, sf))


@query(" UNION ALL ".join(_stats(m) for m in ("text_len_word", "text_len_char")).replace("lsp", f"({_ALL_SPLIT})"))
def length_stats(spark, sf):
    return rounded(dist.length_stats(_all_split(spark, sf)))


@query(f"""SELECT split, CAST(bin AS INTEGER) AS bin, round(lo + bin * width, 6) AS bin_start, round(lo + (bin + 1) * width, 6) AS bin_end,
  n, round(mean, 6) AS mean, round(median, 6) AS median FROM (
  SELECT split, lo, (hi - lo) / 50 AS width, mean, median,
    CASE WHEN hi = lo THEN 0 ELSE least(floor((text_len_word - lo) * 50 / (hi - lo)), 49) END AS bin, count(*) AS n
  FROM ({_ALL_SPLIT}) JOIN (SELECT split, CAST(min(text_len_word) AS DOUBLE) AS lo, CAST(max(text_len_word) AS DOUBLE) AS hi,
    avg(text_len_word) AS mean, quantile_cont(text_len_word, 0.5) AS median FROM ({_ALL_SPLIT}) GROUP BY split) USING (split)
  GROUP BY ALL)""")
def length_histogram(spark, sf):
    return rounded(dist.histogram(_all_split(spark, sf)))


@query("""SELECT label, q1, median, q3, CAST(min(x) FILTER (WHERE ok) AS BIGINT) AS whisker_low,
  CAST(max(x) FILTER (WHERE ok) AS BIGINT) AS whisker_high, count(*) FILTER (WHERE NOT ok) AS outliers, count(*) AS n
  FROM (SELECT label, text_len_word AS x, q1, median, q3,
    text_len_word BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok
    FROM alr JOIN (SELECT label, quantile_cont(text_len_word, 0.25) AS q1, quantile_cont(text_len_word, 0.5) AS median,
      quantile_cont(text_len_word, 0.75) AS q3 FROM alr GROUP BY label) USING (label)) GROUP BY ALL""")
def length_boxplot(spark, sf):
    return dist.boxplot(fx.all_rows(spark, sf))


@query("""SELECT label, CAST(value AS BIGINT) AS value, n, round(sum(n) OVER (PARTITION BY label ORDER BY value) / sum(n) OVER (PARTITION BY label), 6) AS ecdf
  FROM (SELECT label, text_len_word AS value, count(*) AS n FROM alr GROUP BY ALL)""")
def length_ecdf(spark, sf):
    return rounded(dist.ecdf(fx.all_rows(spark, sf)))


@query("SELECT label, " + ", ".join(
    f"count(*) FILTER (WHERE source = '{s}') AS {s}" for s in fx.ALL_SOURCES) + " FROM cor GROUP BY label")
def label_source_crosstab(spark, sf):
    return dist.crosstab(fx.corpus(spark, sf), "label", "source", fx.ALL_SOURCES)


@query("""SELECT split, count(DISTINCT family_id) AS families FROM cor GROUP BY split
  UNION ALL SELECT 'all', count(DISTINCT family_id) FROM cor""")
def families_per_split(spark, sf):
    return dist.families_per_split(fx.corpus(spark, sf))


@query("""SELECT label_id, n, round(total / (k * n), 6) AS weight FROM (SELECT label_id, count(*) AS n,
  CAST(sum(count(*)) OVER () AS DOUBLE) AS total, count(*) OVER () AS k FROM lab GROUP BY label_id)""")
def class_weights(spark, sf):
    return rounded(dist.class_weights(fx.labelled(spark, sf)))


@query("""SELECT l AS label, n, round(n / CAST(t AS DOUBLE), 6) AS share, n / CAST(t AS DOUBLE) < CAST(0.1 AS DOUBLE) AS imbalanced FROM (
  SELECT l, (SELECT count(*) FROM lab WHERE label = l) AS n, (SELECT count(*) FROM lab) AS t FROM unnest(['T1', 'T2', 'T3', 'T4']) v(l))""")
def imbalance_check(spark, sf):
    return rounded(dist.imbalance_check(fx.labelled(spark, sf)))


@query(f"""SELECT split, count(*) FILTER (WHERE text_len_char < 10) AS too_short,
  count(*) FILTER (WHERE text_len_char > 2000) AS too_long, count(*) AS rows FROM ({_ALL_SPLIT}) GROUP BY split""")
def length_outliers(spark, sf):
    return dist.length_outliers(_all_split(spark, sf))


@query(f"""SELECT split, label, count(*) AS rows, CAST(l AS INTEGER) AS "limit",
  round(avg(CASE WHEN text_len_word <= l THEN 1.0 ELSE 0.0 END), 6) AS coverage
  FROM ({_ALL_SPLIT}), unnest([128, 256]) u(l) GROUP BY split, label, l""")
def length_coverage(spark, sf):
    return rounded(dist.length_coverage(_all_split(spark, sf)))


@query("""SELECT CAST(bin AS INTEGER) AS bin, round(lo + bin * (hi - lo) / 50, 6) AS bin_start, round(lo + (bin + 1) * (hi - lo) / 50, 6) AS bin_end,
  count(*) FILTER (WHERE label = 'T3') AS n_first, count(*) FILTER (WHERE label = 'T4') AS n_second
  FROM (SELECT label, lo, hi, least(floor((text_len_word - lo) * 50 / (hi - lo)), 49) AS bin FROM alr,
    (SELECT CAST(min(text_len_word) AS DOUBLE) AS lo, CAST(max(text_len_word) AS DOUBLE) AS hi FROM alr WHERE label IN ('T3', 'T4'))
    WHERE label IN ('T3', 'T4')) GROUP BY bin, lo, hi""")
def class_pair_compare(spark, sf):
    return rounded(dist.class_pair_comparison(fx.all_rows(spark, sf), "T3", "T4"))


# ---------------------------------------------------------------- samples

_PREVIEW = "CASE WHEN length({0}) > {1} THEN substr({0}, 1, {1}) || '...' ELSE {0} END"


@query(f"""SELECT label, CAST(r AS INTEGER) AS rank, {_PREVIEW.format('text', 100)} AS preview, source, family_id, text_len_word
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || id), id) AS r FROM cor WHERE split = 'train') WHERE r <= 5""")
def sample_per_label(spark, sf):
    return sampling.example_rows(fx.corpus(spark, sf).filter(F.col("split") == "train"))


@query(f"""SELECT {FIELDS}, split, CAST(r AS INTEGER) AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY id) AS r FROM cor) WHERE r <= 3""")
def head_per_split(spark, sf):
    return sampling.head_per_group(fx.corpus(spark, sf))


@query("""SELECT id, split FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('42:' || id), id) AS r
  FROM spl WHERE split IN ('train', 'val')) WHERE r <= CASE split WHEN 'train' THEN 200 ELSE 100 END""")
def sample_rows(spark, sf):
    return sampling.sample_splits(fx.split_rows(spark, sf), {"train": 200, "val": 100}).select("id", "split")


_UNIT = "CAST('0x' || substr(md5('42:' || id), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE)"


@query(f"SELECT id FROM mat WHERE {_UNIT} < CAST(0.01 AS DOUBLE)")
def sample_fraction(spark, sf):
    return sampling.sample_fraction(fx.rows(spark, sf), 0.01).select("id")


@query(f"SELECT id, label FROM mat WHERE {_UNIT} < CASE label WHEN 'T1' THEN CAST(0.1 AS DOUBLE) WHEN 'T2' THEN CAST(0.2 AS DOUBLE) WHEN 'T3' THEN CAST(0.5 AS DOUBLE) ELSE 0 END")
def sample_stratified(spark, sf):
    return sampling.sample_stratified(fx.rows(spark, sf), {"T1": 0.1, "T2": 0.2, "T3": 0.5}).select("id", "label")


# ---------------------------------------------------------------- leakage and validation

_BYTE_SPLIT = f"CASE WHEN {byte('md5(id)', 0)} % 4 < 2 THEN 'train' WHEN {byte('md5(id)', 0)} % 4 = 2 THEN 'val' ELSE 'test' END"
_LEAKY = f"(SELECT *, {_BYTE_SPLIT} AS split FROM mat)"
_PAIRS = "(VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) v(a, b)"


def _shared(key: str, source: str) -> str:
    return f"""SELECT a AS left_split, b AS right_split, (SELECT count(*) FROM (
      SELECT {key} FROM {source} WHERE split = a INTERSECT SELECT {key} FROM {source} WHERE split = b)) AS shared FROM {_PAIRS}"""


@query(_shared("family_id", _LEAKY))
def leak_family(spark, sf):
    return leakage.family_overlap(fx.leaky(spark, sf))


@query(_shared("text", "cor"))
def leak_exact_text(spark, sf):
    return leakage.exact_text_overlap(fx.corpus(spark, sf))


@query(_shared("lower(text)", "cor"))
def leak_case_insensitive(spark, sf):
    return leakage.caseless_text_overlap(fx.corpus(spark, sf))


@query(f"""SELECT a AS left_split, b AS right_split, CAST(r AS INTEGER) AS rank, {_PREVIEW.format('text', 80)} AS preview, copies FROM (
  SELECT a, b, text, (SELECT count(*) FROM cor c WHERE c.text = q.text) AS copies,
    row_number() OVER (PARTITION BY a, b ORDER BY md5(text)) AS r FROM (
    SELECT DISTINCT a, b, x.text FROM {_PAIRS} JOIN cor x ON x.split = a JOIN cor y ON y.split = b AND y.text = x.text) q) WHERE r <= 3""")
def leak_examples(spark, sf):
    return leakage.text_overlap_examples(fx.corpus(spark, sf))


@query(f"""SELECT a AS left_split, b AS right_split, family_id AS key, CAST(r AS INTEGER) AS rank FROM (
  SELECT a, b, family_id, row_number() OVER (PARTITION BY a, b ORDER BY family_id) AS r FROM (
    SELECT DISTINCT a, b, x.family_id FROM {_PAIRS} JOIN {_LEAKY} x ON x.split = a
    JOIN {_LEAKY} y ON y.split = b AND y.family_id = x.family_id)) WHERE r <= 10""")
def leak_family_examples(spark, sf):
    shared = leakage.overlap_examples(fx.leaky(spark, sf), F.col("family_id"), 10)
    return shared.select("left_split", "right_split", "key", "rank")


@query("""SELECT split, count(*) AS rows, count(DISTINCT text) AS distinct_texts, count(*) - count(DISTINCT text) AS duplicates
  FROM spl GROUP BY split""")
def duplicate_texts(spark, sf):
    return leakage.duplicate_texts(fx.split_rows(spark, sf))


_CHECK = "'' AS split, CAST({0} AS BIGINT) AS actual, CAST(0 AS BIGINT) AS expected, CASE WHEN ({0}) = 0 THEN 'ok' ELSE 'fail' END AS status"


def _check(name: str, severity: str, count: str) -> str:
    return f"SELECT '{name}' AS \"check\", '{severity}' AS severity, " + _CHECK.format(count)


def _row_checks(source: str) -> str:
    rules = {
        "text_not_blank": "trim(text) = ''", "source_known": "source NOT IN ('mrpc', 'paws', 'hlpc')",
        "label_known": "label NOT IN ('T1', 'T2', 'T3', 'T4')", "label_id_matches": "'T' || (label_id + 1) <> label",
    }
    return " UNION ALL ".join(
        _check(n, "error", f"(SELECT count(*) FROM {source} WHERE {rule})") for n, rule in rules.items())


@query(_row_checks("cor"))
def row_validity(spark, sf):
    return val.rule_violations(fx.corpus(spark, sf), val.row_rules())


@query(f"SELECT {FIELDS}, split, ['source_known'] AS rule_failures FROM cor WHERE source NOT IN ('mrpc', 'paws', 'hlpc')")
def row_quarantine(spark, sf):
    return val.quarantine(fx.corpus(spark, sf), val.row_rules())


@query(f"""SELECT id, split, CASE WHEN text_len_char > 2000 THEN 'length_allowed' ELSE '' END AS rule_failures, text_len_char <= 2000 AS valid
  FROM ({_ALL_SPLIT})""")
def row_contract(spark, sf):
    verdict = val.row_contract(_all_split(spark, sf), max_chars=2000)
    return verdict.withColumn("rule_failures", F.array_join("rule_failures", ","))


_BY_SOURCE_SQL = "CASE WHEN label = 'T4' AND split <> 'train' THEN 'T3' WHEN label = 'T1' AND split = 'train' THEN 'T2' ELSE label END"


@query(f"""SELECT s AS split, l AS label, CASE WHEN s = 'train' THEN 'error' ELSE 'warn' END AS severity
  FROM {_CELLS}, unnest(['T1', 'T2', 'T3', 'T4']) v(l)
  WHERE NOT EXISTS (SELECT 1 FROM (SELECT split, {_BY_SOURCE_SQL} AS label FROM spl) x WHERE x.split = s AND x.label = l)""")
def missing_labels(spark, sf):
    """Over rows relabelled so that train lacks T1 and the other splits lack T4."""
    relabelled = fx.split_rows(spark, sf).withColumn("label", F.expr(_BY_SOURCE_SQL))
    return val.missing_labels(relabelled)


@query(f"""SELECT 'family_leakage' AS "check", 'error' AS severity, left_split || '-' || right_split AS split, shared AS actual,
  CAST(0 AS BIGINT) AS expected, CASE WHEN shared = 0 THEN 'ok' ELSE 'fail' END AS status FROM ({_shared('family_id', _LEAKY)})
  UNION ALL {_row_checks(_LEAKY)}
  UNION ALL SELECT 'label_coverage', CASE WHEN s = 'train' THEN 'error' ELSE 'warn' END, s, k, 4, CASE WHEN k = 4 THEN 'ok' ELSE 'fail' END
    FROM (SELECT s, (SELECT count(DISTINCT label) FROM {_LEAKY} WHERE split = s) AS k FROM {_CELLS})
  UNION ALL {_check('class_imbalance', 'warn', f"(SELECT count(*) FROM (SELECT label FROM {_LEAKY} GROUP BY label HAVING count(*) < 0.1 * (SELECT count(*) FROM {_LEAKY})))")}
  UNION ALL {_check('duplicate_texts', 'warn', f"(SELECT sum(d) FROM (SELECT count(*) - count(DISTINCT text) AS d FROM {_LEAKY} GROUP BY split))")}""")
def split_integrity(spark, sf):
    return val.split_integrity(fx.leaky(spark, sf))


@query("""SELECT id, count(*) AS n FROM (SELECT source || '_' || length(t) || '__' || 'T' || (d % 4 + 1) AS id
  FROM (SELECT lower(source) AS source, text AS t, doc_id AS d FROM documents)) GROUP BY id HAVING count(*) > 1""")
def duplicate_ids(spark, sf):
    """Over documents numbered by their length, which collides."""
    wide = fam.families(_by_length(spark, sf))
    return val.duplicate_ids(fam.classify_rows(wide, max_chars=None, keep_blank=False))


@query("""SELECT family_id, count(*) AS records, count(DISTINCT (x, text)) > 1 AS conflicting
  FROM (SELECT lower(source) || '_' || length(text) AS family_id, doc_id % 4 AS x, text FROM documents)
  GROUP BY family_id HAVING count(*) > 1""")
def duplicate_family_keys(spark, sf):
    return val.duplicate_family_keys(fam.families(_by_length(spark, sf)))


def _by_length(spark, sf) -> DataFrame:
    raw = fx.document_records(spark, sf, "text")
    return raw.withColumn("idx", F.char_length("idx").cast("string"))


# ---------------------------------------------------------------- similarity

_PAIR = "left_id, right_id, left_copies, right_copies, round(similarity, 6) AS similarity"


@query(f"SELECT {_PAIR} FROM jac")
def jaccard_pairs(spark, sf):
    return rounded(similarity.jaccard_pairs(fx.split_rows(spark, sf)))


@query(f"SELECT {_PAIR} FROM cprs")
def cosine_pairs(spark, sf):
    return rounded(similarity.cosine_pairs(fx.split_rows(spark, sf), stop_words=fx.STOP_WORDS))


@query("""SELECT t.split, t.id, CASE WHEN t.split = 'train' THEN g.left_id ELSE g.right_id END AS class_id,
  CAST(coalesce(n, 0) AS BIGINT) AS linked_texts FROM wst t JOIN wsg g ON g.k = md5(array_to_string(t.s, ' ')) LEFT JOIN (
    SELECT 'train' AS split, left_id AS id, sum(right_copies) AS n FROM jac GROUP BY left_id UNION ALL
    SELECT 'val', right_id, sum(left_copies) FROM jac GROUP BY right_id
  ) l ON l.split = t.split AND l.id = CASE WHEN t.split = 'train' THEN g.left_id ELSE g.right_id END""")
def near_duplicate_texts(spark, sf):
    """Every text of both splits with its class and the number of texts linked to it."""
    return similarity.near_duplicate_texts(fx.split_rows(spark, sf))


@query(f"SELECT {_PAIR} FROM sprs ORDER BY sprs.similarity DESC, left_id, right_id LIMIT 10")
def cosine_top10(spark, sf):
    """The sampling mode: 200 train rows against 100 val rows."""
    sample = sampling.sample_splits(fx.split_rows(spark, sf), {"train": 200, "val": 100})
    pairs = similarity.cosine_pairs(sample, max_features=10_000, stop_words=fx.STOP_WORDS)
    return rounded(similarity.most_similar(pairs))


@query("SELECT count(*) AS distinct_pairs, CAST(coalesce(sum(left_copies * right_copies), 0) AS BIGINT) AS row_pairs FROM jac")
def jaccard_summary(spark, sf):
    return similarity.pair_summary(similarity.jaccard_pairs(fx.split_rows(spark, sf)))


@query("SELECT count(*) AS exact_pairs, TRUE AS all_right, TRUE AS recall_reached FROM jac")
def minhash_recall(spark, sf):
    """The approximate join beside the exact one: no wrong pair, and at least 0.9 of all."""
    rows = fx.split_rows(spark, sf)
    exact = similarity.jaccard_pairs(rows).select("left_id", "right_id", F.lit(True).alias("exact"))
    found = minhash.approximate_jaccard_pairs(rows).select("left_id", "right_id", F.lit(True).alias("found"))
    both = exact.join(found, ["left_id", "right_id"], "full")
    return both.agg(
        F.count("exact").alias("exact_pairs"), F.coalesce(F.every(F.col("exact").isNotNull()), F.lit(True)).alias("all_right"),
        (F.count("found") >= F.count("exact") * 0.9).alias("recall_reached"))


@query()
def jaccard_pairs_approximate(spark, sf):
    return rounded(minhash.approximate_jaccard_pairs(fx.split_rows(spark, sf)))


@query(f"""SELECT CAST(row_number() OVER (ORDER BY similarity DESC, left_id, right_id) AS INTEGER) AS rank, left_id, right_id,
  round(similarity, 6) AS similarity, {_PREVIEW.format('l.text', 80)} AS left_preview, {_PREVIEW.format('r.text', 80)} AS right_preview
  FROM (SELECT * FROM jac ORDER BY similarity DESC, left_id, right_id LIMIT 10) JOIN spl l ON l.id = left_id JOIN spl r ON r.id = right_id""")
def near_duplicate_previews(spark, sf):
    rows = stage(fx.split_rows(spark, sf), "rows")
    return rounded(similarity.pair_previews(similarity.jaccard_pairs(rows), rows))


# ---------------------------------------------------------------- features and models

@query("SELECT id, array_to_string(t, ' ') AS tokens FROM tok")
def tokens(spark, sf):
    return fx.labelled(spark, sf).select(
        "id", F.array_join(tx.analyzer_tokens(F.col("text")), " ").alias("tokens"))


@query(f"SELECT id, array_to_string(list_filter(t, lambda w: w NOT IN ({texts(fx.STOP_WORDS)})), ' ') AS tokens FROM tok")
def tokens_nostop(spark, sf):
    kept = tx.remove_words(tx.analyzer_tokens(F.col("text")), fx.STOP_WORDS)
    return fx.labelled(spark, sf).select("id", F.array_join(kept, " ").alias("tokens"))


@query("SELECT id, array_to_string(list_concat(t, [t[i] || ' ' || t[i + 1] for i in range(1, len(t))]), '|') AS ngrams FROM tok")
def ngrams(spark, sf):
    grams = tx.ngrams(tx.analyzer_tokens(F.col("text")))
    return fx.labelled(spark, sf).select("id", F.array_join(grams, "|").alias("ngrams"))


def _train(spark, sf) -> DataFrame:
    return fx.labelled(spark, sf).filter(F.col("split") == "train")


@query("SELECT term, tf, df FROM vst")
def vocab_stats(spark, sf):
    return tfidf.term_statistics(_train(spark, sf))


@query("SELECT term, tf, df, round(idf, 6) AS idf FROM voc")
def vocab_topk(spark, sf):
    return rounded(tfidf.vocabulary(_train(spark, sf)))


@query("SELECT id, term, round(weight, 6) AS weight FROM wgt WHERE split = 'train'")
def tfidf_weights(spark, sf):
    train = _train(spark, sf)
    return rounded(tfidf.term_weights(train, tfidf.vocabulary(train)).select("id", "term", "weight"))


@query("SELECT id, term, round(weight, 6) AS weight FROM wgt WHERE split <> 'train'")
def tfidf_transform(spark, sf):
    held_out = fx.labelled(spark, sf).filter(F.col("split") != "train")
    return rounded(tfidf.term_weights(held_out, tfidf.vocabulary(_train(spark, sf))).select("id", "term", "weight"))


@query("""SELECT lab.id, coalesce(n, 0) AS terms, coalesce(w, 0) AS weight_sum FROM lab LEFT JOIN (
  SELECT id, count(*) AS n, round(sum(weight), 6) AS w FROM wgt GROUP BY id) USING (id)""")
def feature_vectors(spark, sf):
    """Sparse vectors, summarised by their number of terms and the sum of weights."""
    vectors = models.fit_tfidf(_train(spark, sf))
    summed = _sparse_summary("features")
    return rounded(vectors.transform(fx.labelled(spark, sf)).select("id", F.explode(F.array(summed)).alias("v")).select(
        "id", F.col("v.terms").alias("terms"), F.col("v.weight_sum").alias("weight_sum")))


def _sparse_summary(column: str):
    def summarise(vectors: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({
            "terms": vectors["indices"].map(len), "weight_sum": vectors["values"].map(lambda w: float(sum(w)))})

    kind = StructType([StructField("terms", LongType()), StructField("weight_sum", DoubleType())])
    return F.pandas_udf(summarise, kind)(column)


_TOKEN_SQL = r"""(SELECT id, split, regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}') AS t FROM lab)"""


@query(f"""SELECT id, array_to_string(list_concat([2], ids, [3], [0 for i in range(254 - len(ids))]), ' ') AS input_ids,
  array_to_string(list_concat([1 for i in range(len(ids) + 2)], [0 for i in range(254 - len(ids))]), ' ') AS attention_mask FROM (
  SELECT id, coalesce(list(coalesce(token_id, 1) ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS ids FROM
    (SELECT id FROM lab) LEFT JOIN (SELECT id, unnest(t[1:254]) AS term, unnest(range(1, least(len(t), 254) + 1)) AS i FROM {_TOKEN_SQL}) USING (id)
    LEFT JOIN (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) + 3 AS token_id FROM
      (SELECT unnest(t) AS term FROM {_TOKEN_SQL} WHERE split = 'train') GROUP BY term ORDER BY count(*) DESC, term LIMIT 20000) USING (term)
  GROUP BY id)""")
def encode_fixed(spark, sf):
    known = encoding.token_ids(_train(spark, sf), max_tokens=20_000)
    encoded = encoding.encode_fixed(fx.labelled(spark, sf), known, 256, 20_000)
    return encoded.select(
        "id", F.array_join("input_ids", " ").alias("input_ids"),
        F.array_join("attention_mask", " ").alias("attention_mask"))


def _logreg(spark, sf) -> baseline.BaselineRun:
    return baseline.fit_baseline(fx.labelled(spark, sf), models.logistic_regression)


_FOLDED = """(SELECT id, CAST(CAST('0x' || substr(md5('fold:42:' || family_id), 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold
  FROM lab WHERE split = 'train')"""


@query(f"""SELECT CAST(k AS INTEGER) AS fold, term, tf, df, round(ln((1 + n) / (1 + CAST(df AS DOUBLE))) + 1, 6) AS idf FROM (
  SELECT k, term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df,
    (SELECT CAST(count(*) AS DOUBLE) FROM {_FOLDED} c WHERE c.fold <> k) AS n
  FROM dtf JOIN {_FOLDED} d USING (id), range(5) r(k) WHERE d.fold <> k GROUP BY k, term)
  WHERE df >= 2 AND df <= n * CAST(0.95 AS DOUBLE)
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY tf DESC, term) <= 20000""")
def cv_vocabularies(spark, sf):
    """Each fold's vocabulary by complement statistics; the SQL counts every fold anew."""
    return rounded(cv.fold_vocabularies(split.assign_folds(_train(spark, sf)), 5))


@query()
def cv_scores(spark, sf):
    """Five-fold grid search over the strength of the penalty."""
    candidates = {f"C={c}": lambda total, c=c: models.logistic_regression(total, c) for c in (0.1, 1.0)}
    return rounded(cv.grid_scores(cv.cross_validate(_train(spark, sf), candidates)))


@query()
def predictions(spark, sf):
    """Logistic-regression predictions for the test split, written and read back."""
    path = new_location(spark, "predictions")
    writers.write_predictions(_logreg(spark, sf).predictions, path)
    return spark.read.parquet(path).select("model_name", "seed", "id", "y_true", "y_pred", "text_len_word")


@query("SELECT id, label_id AS y_true, text_len_word, TRUE AS reloaded_equal FROM lab WHERE split = 'test'")
def predictions_reloaded(spark, sf):
    """Predictions of a model that was saved and loaded again, beside those made before saving."""
    path = new_location(spark, "baseline")
    baseline.write_baseline(_logreg(spark, sf), path)
    held_out = fx.labelled(spark, sf).filter(F.col("split") == "test")
    again = models.predict(baseline.load_baseline(path), held_out, "tfidf_logreg")
    before = spark.read.parquet(f"{path}/predictions").select("id", F.col("y_pred").alias("first"), F.col("scores").alias("first_scores"))
    return again.join(before, "id", "left").select(
        "id", "y_true", "text_len_word",
        F.coalesce((F.col("y_pred") == F.col("first")) & (F.col("scores") == F.col("first_scores")), F.lit(False)).alias("reloaded_equal"))


@query()
def logreg_metrics(spark, sf):
    return met.evaluate(_logreg(spark, sf).predictions)


@query()
def svm_metrics(spark, sf):
    run = baseline.fit_baseline(fx.labelled(spark, sf), models.linear_svm, "linear_svm")
    return met.evaluate(run.predictions)


@query()
def rf_metrics(spark, sf):
    run = baseline.fit_baseline(fx.labelled(spark, sf), lambda total: models.random_forest(), "random_forest")
    return met.evaluate(run.predictions)


@query()
def gbt_metrics(spark, sf):
    run = baseline.fit_baseline(fx.labelled(spark, sf), lambda total: models.gradient_boosting(), "gradient_boosting")
    return met.evaluate(run.predictions)


@query()
def artifact_sizes(spark, sf):
    run = _logreg(spark, sf)
    path = new_location(spark, "artifacts")
    baseline.write_baseline(run, path)
    return writers.artifact_sizes(spark, f"{path}/model")


_SCORES = """SELECT vec_id, k, sum(CAST(e.embedding[p] AS DOUBLE) * m) AS s FROM embeddings e, (
  SELECT label AS k, p, avg(CAST(embedding[p] AS DOUBLE)) AS m FROM embeddings, range(1, 65) r(p) GROUP BY ALL) c GROUP BY ALL"""


@query(f"""SELECT vec_id, CAST(arg_max(k, s) AS INTEGER) AS y_pred, round(max(s), 4) AS best FROM ({_SCORES}) GROUP BY vec_id""")
def batch_scoring(spark, sf):
    vectors = fx.table(spark, sf, "embeddings")
    centroids = models.fit_centroids(vectors, "embedding", "label")
    scored = models.batch_scores(vectors, models.centroid_scorer(centroids), "embedding", len(centroids[0]))
    return rounded(scored.select("vec_id", "y_pred", F.array_max("scores").alias("best")), 4)


# ---------------------------------------------------------------- evaluation

@query("SELECT model_name, seed, id, CAST(list_position(scores, list_max(scores)) - 1 AS INTEGER) AS best FROM prd")
def argmax_scores(spark, sf):
    return fx.predictions(spark, sf).select("model_name", "seed", "id", argmax(F.col("scores")).alias("best"))


def _confusion(spark, sf) -> DataFrame:
    return met.confusion_matrix(fx.predictions(spark, sf))


def _per_class(spark, sf) -> DataFrame:
    return met.per_class_metrics(_confusion(spark, sf))


def _summary(spark, sf) -> DataFrame:
    return met.summary(_per_class(spark, sf))


@query("SELECT model_name, seed, round(accuracy, 6) AS accuracy FROM smy")
def accuracy(spark, sf):
    return rounded(_summary(spark, sf).select("model_name", "seed", "accuracy"))


@query("SELECT model_name, seed, round(macro_f1, 6) AS macro_f1 FROM smy")
def macro_f1(spark, sf):
    return rounded(_summary(spark, sf).select("model_name", "seed", "macro_f1"))


@query("""SELECT model_name, seed, label, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1,
  support, predicted, tp FROM pcl""")
def per_class_metrics(spark, sf):
    return rounded(_per_class(spark, sf))


@query("SELECT model_name, seed, y_true, y_pred, n FROM cnf")
def confusion_matrix(spark, sf):
    return _confusion(spark, sf)


@query("""SELECT model_name, seed, 'T' || (y_true + 1) AS label, """ + ", ".join(
    f"CAST(sum(n) FILTER (WHERE y_pred = {i}) AS BIGINT) AS \"T{i + 1}\"" for i in range(4)) + " FROM cnf GROUP BY ALL")
def confusion_pivot(spark, sf):
    """Written as CSV and read back."""
    path = new_location(spark, "confusion")
    wide = met.confusion_wide(_confusion(spark, sf))
    writers.write_csv(wide, path)
    return spark.read.schema(wide.schema).option("header", True).csv(path)


@query("SELECT model_name, seed, CAST(class AS INTEGER) AS class, round(auroc, 6) AS auroc FROM auc")
def auroc_ovr(spark, sf):
    return rounded(met.auroc_one_vs_rest(fx.predictions(spark, sf)))


_RUN_SQL = """SELECT replace(model_name, '/', '-') AS model_name, seed, n AS test_samples, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
  round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro, round(auroc_ovr, 6) AS auroc_ovr,
  round(train_time_sec, 6) AS train_time_sec, round(eval_time_sec * 1000 / n, 6) AS latency_ms, round(n / eval_time_sec, 6) AS rows_per_sec,
  num_params, round(size_bytes / CAST(1048576 AS DOUBLE), 3) AS model_size_mb,
  (SELECT string_agg(CAST(n AS VARCHAR), ',' ORDER BY y_true, y_pred) FROM cnf WHERE cnf.model_name = smy.model_name AND cnf.seed = smy.seed) AS cells
  FROM smy JOIN (SELECT model_name, seed, avg(auroc) AS auroc_ovr FROM auc GROUP BY ALL) USING (model_name, seed) JOIN tim USING (model_name, seed)"""


def _results(spark, sf) -> DataFrame:
    predicted = stage(fx.predictions(spark, sf), "predictions")
    return met.run_result(predicted, fx.timings(predicted))


def _run_rows(results: DataFrame) -> DataFrame:
    cells = F.array_join(F.flatten("confusion_matrix"), ",").alias("cells")
    return rounded(results.select("*", cells).drop(
        "per_class_f1", "per_class_precision", "per_class_recall", "confusion_matrix", "timestamp_utc"))


@query(_RUN_SQL)
def run_result(spark, sf):
    return _run_rows(_results(spark, sf))


@query(_RUN_SQL)
def run_record_roundtrip(spark, sf):
    """Run records written as JSON and read back."""
    results = _results(spark, sf)
    path = new_location(spark, "run-records")
    writers.write_record(results, path)
    return _run_rows(spark.read.schema(results.schema).json(path))


@query("""SELECT replace(model_name, '/', '-') AS model_name, round(accuracy, 6) AS accuracy, round(macro_f1, 6) AS macro_f1,
  round(f1_T1, 6) AS "f1_T1", round(f1_T2, 6) AS "f1_T2", round(f1_T3, 6) AS "f1_T3", round(f1_T4, 6) AS "f1_T4",
  round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro, round(auroc_ovr, 6) AS auroc_ovr,
  round(train_time_sec, 6) AS train_time_sec, round(eval_time_sec * 1000 / n, 6) AS latency_ms, num_params, seed
  FROM smy JOIN (SELECT model_name, seed, avg(auroc) AS auroc_ovr FROM auc GROUP BY ALL) USING (model_name, seed) JOIN tim USING (model_name, seed)""")
def results_flat(spark, sf):
    """Written as CSV and read back."""
    path = new_location(spark, "results")
    flat = met.results_flat(_results(spark, sf))
    writers.write_csv(flat, path)
    return rounded(spark.read.schema(flat.schema).option("header", True).csv(path).drop("timestamp_utc"))


@query("""SELECT model_name, seed, label AS row, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, support FROM pcl
  UNION ALL SELECT model_name, seed, 'accuracy', round(accuracy, 6), round(accuracy, 6), round(accuracy, 6), n FROM smy
  UNION ALL SELECT model_name, seed, 'macro avg', round(precision_macro, 6), round(recall_macro, 6), round(macro_f1, 6), n FROM smy
  UNION ALL SELECT model_name, seed, 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
    round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pcl GROUP BY ALL""")
def classification_report(spark, sf):
    return rounded(met.classification_report(_per_class(spark, sf)))


@query("""SELECT model_name, metric, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, count(*) AS runs FROM (
  SELECT model_name, 'accuracy' AS metric, accuracy AS v FROM smy UNION ALL SELECT model_name, 'macro_f1', macro_f1 FROM smy) GROUP BY ALL""")
def multi_seed(spark, sf):
    return rounded(met.multi_seed(_summary(spark, sf), ["accuracy", "macro_f1"]))


@query("""SELECT model_name, cost, round(gain, 6) AS gain, NOT EXISTS (SELECT 1 FROM pts q WHERE q.cost <= p.cost AND q.gain >= p.gain
  AND (q.cost < p.cost OR q.gain > p.gain)) AS on_frontier FROM pts p""".replace(
      "pts", "(SELECT model_name || '#' || seed AS model_name, size_bytes % 997 AS cost, macro_f1 AS gain FROM smy JOIN tim USING (model_name, seed))"))
def pareto_models(spark, sf):
    predicted = fx.predictions(spark, sf)
    points = met.evaluate(predicted).join(fx.timings(predicted), ["model_name", "seed"]).select(
        F.concat_ws("#", "model_name", F.col("seed").cast("string")).alias("model_name"),
        (F.col("size_bytes") % 997 + F.length("model_name") * 0).alias("cost"), F.col("macro_f1").alias("gain"))
    return rounded(met.pareto_frontier(points, "cost", "gain"))


@query("""SELECT model_name, """ + ", ".join(
    f"round(avg(f) FILTER (WHERE label = 'T{i}'), 6) AS \"T{i}\"" for i in range(1, 5)) + " FROM pcl GROUP BY model_name")
def per_class_by_model(spark, sf):
    return rounded(met.per_class_by_model(_per_class(spark, sf)))


@query("""SELECT model_name, seed, bucket, n, round(accuracy, 6) AS accuracy, round((SELECT avg(2 * tp / CAST(s + p AS DOUBLE)) FROM (
    SELECT k.range AS k, count(*) FILTER (WHERE y_true = k.range AND y_pred = k.range) AS tp, count(*) FILTER (WHERE y_true = k.range) AS s,
      count(*) FILTER (WHERE y_pred = k.range) AS p FROM bkt x, range(4) k
      WHERE x.model_name = g.model_name AND x.seed = g.seed AND x.bucket = g.bucket GROUP BY 1) WHERE s + p > 0), 6) AS macro_f1
  FROM (SELECT model_name, seed, bucket, count(*) AS n, avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END) AS accuracy FROM bkt GROUP BY ALL) g""".replace(
      "bkt", "(SELECT *, CASE WHEN text_len_word <= 50 THEN 'short' WHEN text_len_word <= 150 THEN 'medium' ELSE 'long' END AS bucket FROM prd)"))
def length_stratified(spark, sf):
    return rounded(met.length_stratified(fx.predictions(spark, sf)).select(
        "model_name", "seed", "bucket", "n", "accuracy", "macro_f1"))


@query("""SELECT model_name, seed, CAST(row_number() OVER (PARTITION BY model_name, seed ORDER BY n DESC, y_true, y_pred) AS INTEGER) AS rank,
  'T' || (y_true + 1) AS true_label, 'T' || (y_pred + 1) AS pred_label, n,
  round(n / CAST(sum(n) OVER (PARTITION BY model_name, seed) AS DOUBLE), 6) AS error_share FROM cnf WHERE y_true <> y_pred AND n > 0""")
def confused_pairs(spark, sf):
    return rounded(met.confused_pairs(_confusion(spark, sf)))


@query("""SELECT model_name, seed, id, y_true, y_pred FROM prd WHERE y_true <> y_pred
  QUALIFY row_number() OVER (PARTITION BY model_name, seed ORDER BY id) <= 100""")
def misclassified(spark, sf):
    return met.misclassified(fx.predictions(spark, sf)).select("model_name", "seed", "id", "y_true", "y_pred")


def _text_noise(column: str) -> str:
    return noisy(f"'q:' || m || ':' || {column}", "k")


@query(f"""SELECT model_name, perturbation, round(baseline, 6) AS baseline, round(perturbed, 6) AS perturbed, round(perturbed - baseline, 6) AS delta FROM (
  SELECT m AS model_name, perturbation, avg(CASE WHEN {_text_noise('text')} = label_id THEN 1.0 ELSE 0.0 END) AS baseline,
    avg(CASE WHEN {_text_noise('changed')} = label_id THEN 1.0 ELSE 0.0 END) AS perturbed FROM (
    SELECT label_id, text, 'lowercase' AS perturbation, lower(text) AS changed FROM mat
    UNION ALL SELECT label_id, text, 'remove_punctuation', regexp_replace(text, '[!-/:-@\\[-`{{-~]', '', 'g') FROM mat
    UNION ALL SELECT label_id, text, 'synonym_swap', {lexicon_swap('text')} FROM mat), (VALUES ('a', 60), ('b', 120)) v(m, k) GROUP BY ALL)""")
def perturbation_delta(spark, sf):
    """Runs whose errors depend on the text, so that changing a text changes the outcome."""
    runs = F.inline(F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.lit(k).alias("noise")) for m, k in (("a", 60), ("b", 120))]))

    def scored(rows: DataFrame, *extra: str) -> DataFrame:
        each = rows.select("text", "label_id", *extra, runs)
        key = F.concat_ws(":", F.lit("q"), "model_name", "text")
        predicted = each.select("model_name", *extra, F.col("label_id").alias("y_true"),
                                fx.noisy_class(key, F.col("noise")).alias("y_pred"))
        return met.evaluate(predicted, ["model_name", *extra])

    rows = fx.rows(spark, sf)
    return rounded(met.perturbation_delta(
        scored(rows), scored(met.perturbed_rows(rows, fx.LEXICON), "perturbation")))


@query(f"""SELECT model_name, CAST(arg_max(epoch, (macro_f1, -epoch)) AS INTEGER) AS epoch, round(max(macro_f1), 6) AS macro_f1 FROM (
  SELECT m AS model_name, epoch, avg(2 * tp / CAST(s + p AS DOUBLE)) AS macro_f1 FROM (
    SELECT m, epoch, k.range AS c, count(*) FILTER (WHERE label_id = k.range AND y = k.range) AS tp,
      count(*) FILTER (WHERE label_id = k.range) AS s, count(*) FILTER (WHERE y = k.range) AS p FROM (
      SELECT m, epoch, label_id, {noisy("'e:' || m || ':' || epoch || ':' || id", "k")} AS y
      FROM mat, (VALUES ('a', 1, 200), ('a', 2, 90), ('a', 3, 110), ('b', 1, 150), ('b', 2, 140), ('b', 3, 60)) v(m, epoch, k)), range(4) k
    GROUP BY ALL) WHERE s + p > 0 GROUP BY ALL) GROUP BY model_name""")
def best_epoch(spark, sf):
    epochs = F.inline(F.array(*[
        F.struct(F.lit(m).alias("model_name"), F.lit(e).alias("epoch"), F.lit(k).alias("noise"))
        for m, e, k in (("a", 1, 200), ("a", 2, 90), ("a", 3, 110), ("b", 1, 150), ("b", 2, 140), ("b", 3, 60))]))
    each = fx.rows(spark, sf).select("id", "label_id", epochs)
    key = F.concat_ws(":", F.lit("e"), "model_name", F.col("epoch").cast("string"), "id")
    predicted = each.select("model_name", "epoch", F.col("label_id").alias("y_true"),
                            fx.noisy_class(key, F.col("noise")).alias("y_pred"))
    return rounded(met.best_epoch(met.evaluate(predicted, ["model_name", "epoch"])))


@query("""SELECT model_name, seed, round(n / eval_time_sec, 6) AS rows_per_sec, round(size_bytes / CAST(1048576 AS DOUBLE), 3) AS size_mb
  FROM smy JOIN tim USING (model_name, seed)""")
def run_efficiency(spark, sf):
    predicted = fx.predictions(spark, sf)
    counts = predicted.groupBy("model_name", "seed").agg(F.count("*").alias("n"))
    return rounded(fx.timings(predicted).join(counts, ["model_name", "seed"]).select(
        "model_name", "seed", throughput(F.col("n"), F.col("eval_time_sec")).alias("rows_per_sec"),
        megabytes(F.col("size_bytes")).alias("size_mb")))


# ---------------------------------------------------------------- reports

@query()
def eda_report_lines(spark, sf):
    rows = stage(fx.corpus(spark, sf), "corpus")
    path = new_location(spark, "report")
    counted = man.manifest_cells(rows)
    report = audit.audit_report(
        rows, fx.ALL_SOURCES, near_duplicates=similarity.jaccard_pairs(rows), reconciled=man.reconcile(counted, counted))
    writers.write_report(report, path)
    return report


@query()
def run_report_lines(spark, sf):
    return audit.run_report(_results(spark, sf))
