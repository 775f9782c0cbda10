"""Benchmark items inside documents, in DataFrame operations only.

Items and documents are compared by their five-word shingles (lower-cased words of
letters and digits; a text of fewer words is one shingle). An item leaks into a document
that contains at least the threshold's share of its distinct shingles.

Documents are long and items short, so sketches are kept of the items: the smallest
hashes of an item's shingles, its bottom-k MinHash. Items are partitioned by size into
powers of two. For an item of n shingles a document must hold ceil(0.8 n), so with
k = n - ceil(0.8 n) + 1 hashes at least one of the sketch lies in every document that
qualifies: nothing is missed. Documents with fewer shingles than a size class asks for
are not searched in that class. The sketches and classes give the candidate pairs, which
are written; only the documents in them are read again, and only the shingles of their
own candidate items are counted, exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.sources.staging import stage

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# Up to this size the shingles of the items are broadcast, beyond it they are shuffled.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128_000_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _shingled(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, words, i, size, hash) for each shingle of rows(keys, words); size counts shingles.

    A row without words has one shingle, the empty string, which no item keeps: a filter
    here would split every text a second time.
    """
    counted = rows.withColumn("size", F.greatest(F.size("words") - SHINGLE_WORDS + 1, F.lit(1)))
    each = counted.select(*keys, "words", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("i"))
    return each.withColumn("hash", F.xxhash64(*[F.get("words", F.col("i") + k) for k in range(SHINGLE_WORDS)]))


def _spelled() -> Column:
    return F.concat_ws(" ", *[F.get("words", F.col("i") + k) for k in range(SHINGLE_WORDS)])


def _item_shingles(items: DataFrame, threshold: float) -> DataFrame:
    """(item_id, shingle, hash, n, needed, size_class, sketched): distinct shingles of each item."""
    split = items.select("item_id", words(F.col("text")).alias("words"))
    spelled = _shingled(split, ["item_id"]).select("item_id", "hash", _spelled().alias("shingle"))
    distinct = spelled.filter("shingle <> ''").distinct()
    per_item = Window.partitionBy("item_id")
    needed = F.greatest(F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)), F.lit(1))
    return (
        distinct.withColumn("n", F.count("*").over(per_item))
        .withColumn("needed", needed)
        .withColumn("size_class", F.floor(F.log2("n")).cast("int"))
        .withColumn("rank", F.row_number().over(per_item.orderBy("hash", "shingle")))
        .withColumn("sketched", F.col("rank") <= F.col("n") - F.col("needed") + 1)
        .drop("rank")
    )


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, item_id, containment) for each document and item that qualify.

    docs: doc_id, text. items: item_id, text. text_key is a hash of the text, so rows
    that repeat a doc_id with different texts are judged apart, equal rows together.
    Null texts and texts without a word match nothing; a null doc_id or item_id is kept.
    """
    shingles = stage(_item_shingles(items.select("item_id", "text"), threshold), "item-shingles")
    size = shingles.agg(F.count("*"), F.sum(F.octet_length("shingle"))).first()
    small = size[0] <= BROADCAST_ROWS and (size[1] or 0) <= BROADCAST_BYTES

    def bounded(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if small else frame

    def shared(rows: DataFrame, wanted: DataFrame) -> DataFrame:
        """(key, size, shingle): distinct wanted shingles of rows (key, words)."""
        each = _shingled(rows, key)
        if small:  # spelled where the hash matches, next to the words
            met = each.join(F.broadcast(wanted), "hash").filter(_spelled() == F.col("shingle"))
        else:  # spelled before the shuffle, which must not carry the words with every shingle
            spelled = each.select(*key, "size", "hash", _spelled().alias("own"))
            met = spelled.join(wanted, "hash").filter("own = shingle")
        return met.select(*key, "size", "shingle").distinct()

    key = ["doc_id", "text_key"]
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    sketches = shingles.filter("sketched")
    met = shared(keyed.select(*key, words(F.col("text")).alias("words")), sketches.select("hash", "shingle").distinct())
    # The smallest item of a class has 2^class shingles.
    enough = F.col("size") >= F.ceil(F.pow(F.lit(2.0), F.col("size_class")) * F.lit(threshold) - F.lit(1e-9))
    candidates = stage(
        met.join(bounded(sketches.select("item_id", "shingle", "size_class")), "shingle").filter(enough)
        .select(*key, "item_id").distinct(), "candidates")
    chosen = candidates.select(F.col("doc_id").alias("in_doc"), F.col("text_key").alias("in_text")).distinct()
    texts = keyed.join(
        chosen, F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("text_key") == F.col("in_text")), "left_semi")
    held = shared(texts.select(*key, words(F.col("text")).alias("words")), shingles.select("hash", "shingle").distinct())
    parts = shingles.select(F.col("item_id").alias("part_of"), F.col("shingle").alias("part"), "n", "needed")
    wanted = candidates.join(bounded(parts), F.col("item_id").eqNullSafe(F.col("part_of"))).select(
        F.col("doc_id").alias("in_doc"), F.col("text_key").alias("in_text"), "item_id", "part", "n", "needed")
    found = F.col("doc_id").eqNullSafe(F.col("in_doc")) & (F.col("text_key") == F.col("in_text")) & (F.col("shingle") == F.col("part"))
    tallied = held.join(wanted, found).groupBy(*key, "item_id").agg(
        F.count("*").alias("shared"), F.first("n").alias("n"), F.first("needed").alias("needed"))
    return tallied.filter("shared >= needed").select(*key, "item_id", (F.col("shared") / F.col("n")).alias("containment"))


def leaks(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, item_ids, containment) for each document that an item leaks into."""
    return stage(contained_items(docs, items, threshold).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("containment").alias("containment")), "leaks")


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, kept, item_ids, containment), one row per row of docs.

    kept is false where an item leaks into the document; item_ids lists those items in
    order and containment is the highest share found (empty and 0.0 where none leaks).
    Without items every document is kept. Other columns of docs are not read.
    """
    found = leaks(docs, items, threshold)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"))
    same = rows["doc_id"].eqNullSafe(found["doc_id"]) & (rows["text_key"] == found["text_key"])
    return rows.join(found, same, "left").select(
        rows["doc_id"], found["containment"].isNull().alias("kept"),
        F.coalesce("item_ids", F.array().cast(found.schema["item_ids"].dataType)).alias("item_ids"),
        F.coalesce("containment", F.lit(0.0)).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, into which no item leaks."""
    found = leaks(docs, items, threshold).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
    same = docs["doc_id"].eqNullSafe(found["__id"]) & (F.xxhash64(docs["text"]) == found["__key"])
    return docs.join(found, same, "left_anti")
