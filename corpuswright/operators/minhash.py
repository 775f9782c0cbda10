"""Approximate near-duplicate join by banded MinHash signatures, verified exactly.

It finds pairs above a Jaccard threshold like similarity.jaccard_pairs, each with a
stated probability, for corpora whose frequent words make the exact join too costly: a
text costs a fixed number of bucket entries, whatever its words. Copies are merged
first, buckets with many entries become salted grids, and every candidate is compared
word by word, so all reported pairs are right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpuswright.functions import text as tx
from corpuswright.operators.similarity import _PAIR, _salted_join, word_sets
from corpuswright.schema import DEFAULT_SEED

MAX_HASHES = 256


def bands_for(threshold: float, recall: float, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows of each) that find a pair at the threshold with at least this probability.

    Of all that fit the number of hashes, the ones with the longest bands, whose buckets
    hold the fewest false candidates.
    """
    if not 0 < recall < 1 or not 0 < threshold <= 1:
        raise ValueError("threshold and recall lie between 0 and 1")
    for rows in range(max_hashes, 0, -1):
        bands, missed = 0, 1.0
        while missed > 1 - recall and (bands + 1) * rows <= max_hashes:
            bands, missed = bands + 1, missed * (1 - threshold**rows)
        if missed <= 1 - recall:
            return bands, rows
    raise ValueError(f"{max_hashes} hashes do not reach a recall of {recall} at {threshold}")


def band_keys(words: Column, bands: int, rows: int, seed: int = DEFAULT_SEED) -> Column:
    """One number per band for an array of distinct words, which must not be empty."""

    @F.arrow_udf("array<long>")
    def keys(hashes):
        import numpy as np
        import pyarrow as pa

        lengths = np.diff(hashes.offsets.to_numpy())
        values = hashes.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        starts = np.cumsum(lengths) - lengths
        draws = np.random.default_rng(seed).integers(0, 1 << 63, (bands * rows, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        out = np.zeros((len(lengths), bands), np.uint64)
        for i, (factor, shift) in enumerate(draws):
            mixed = (values ^ shift) * factor
            mixed ^= mixed >> np.uint64(32)
            least = np.minimum.reduceat(mixed * factor, starts) if len(values) else np.zeros(0, np.uint64)
            band = out[:, i // rows]
            band ^= least + np.uint64(0x9E3779B97F4A7C15) + (band << np.uint64(6)) + (band >> np.uint64(2))
        offsets = pa.array(np.arange(len(lengths) + 1, dtype=np.int32) * bands)
        return pa.ListArray.from_arrays(offsets, pa.array(out.view(np.int64).ravel()))

    return keys(F.transform(words, lambda w: F.xxhash64(w)))


def approximate_jaccard_pairs(
    rows: DataFrame, threshold: float = 0.9, recall: float = 0.99, left: str = "train", right: str = "val",
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """Pairs of distinct word sets, one from each split, with Jaccard > threshold.

    A pair is found with a probability of at least recall, independent of other pairs;
    the columns and the pairs that are found equal those of similarity.jaccard_pairs.
    """
    bands, width = bands_for(threshold, recall)
    sets = word_sets(rows, left, right)
    keyed = sets.select(
        "key", "size", (F.col("left_copies") > 0).alias("on_left"), (F.col("right_copies") > 0).alias("on_right"),
        F.posexplode(band_keys(F.col("words"), bands, width, seed)).alias("band", "bucket"))
    crowds = keyed.groupBy("band", "bucket").agg(
        F.count("*").alias("entries"), (F.bool_or("on_left") & F.bool_or("on_right")).alias("both"))
    # Buckets of one side, most of them, go at once.
    entries = keyed.join(crowds.filter("both").drop("both"), ["band", "bucket"])
    a = entries.filter("on_left").select(F.col("key").alias("left_key"), F.col("size").alias("left_size"), "band", "bucket", "entries")
    b = entries.filter("on_right").select(F.col("key").alias("right_key"), F.col("size").alias("right_size"), "band", "bucket", "entries")
    smaller, larger = F.least("left_size", "right_size"), F.greatest("left_size", "right_size")
    candidates = (
        _salted_join(a, b, ["band", "bucket"], "entries").filter(smaller > larger * threshold - 1e-9)
        .select("left_key", "right_key").distinct())
    left_sets = sets.select(F.col("key").alias("left_key"), F.col("words").alias("left_words"), "left_id", "left_copies")
    right_sets = sets.select(F.col("key").alias("right_key"), F.col("words").alias("right_words"), "right_id", "right_copies")
    return (
        candidates.join(left_sets, "left_key").join(right_sets, "right_key")
        .withColumn("similarity", tx.jaccard(F.col("left_words"), F.col("right_words")))
        .filter(F.col("similarity") > threshold).select(*_PAIR))
