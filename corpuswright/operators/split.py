"""Group-aware splits: all rows of a family land in the same split.

Families are ordered by a seeded hash and cut at exact positions. Only the two keys
at the cuts have to be found: the bucket counts (at most 65,536 numbers) say which hash
bucket holds each cut, and only those buckets are ranked. Every row is then labelled by
comparing its own key with the cuts, without a join or a shuffle of the rows, so a
family with very many rows costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.functions.scalar import hash_fraction, order_key
from corpuswright.schema import DEFAULT_RATIOS, DEFAULT_SEED

_BUCKET_DIGITS = 4


def check_ratios(ratios: Mapping[str, float]) -> None:
    if set(ratios) != {"train", "val", "test"}:
        raise ValueError("ratios must name train, val and test")
    if min(ratios.values()) < 0 or abs(sum(ratios.values()) - 1.0) > 1e-9:
        raise ValueError("ratios must be non-negative and sum to 1")


def _rank_key(seed: int, group: Column) -> Column:
    # The hash has a fixed width, so this sorts by hash and then by group id.
    return F.concat(order_key(seed, group), group)


def _cut_keys(groups: DataFrame, ratios: Mapping[str, float], seed: int) -> DataFrame:
    """(stratum, train_cut, val_cut): the last key of train and of val, null if empty.

    groups holds one row per (stratum, group_id).
    """
    keyed = groups.select("stratum", _rank_key(seed, F.col("group_id")).alias("key")).withColumn(
        "bucket", F.substring("key", 1, _BUCKET_DIGITS)
    )
    counts = keyed.groupBy("stratum", "bucket").agg(F.count("*").alias("n"))
    per_stratum = Window.partitionBy("stratum")
    upto = per_stratum.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = F.col("total").cast("double")
    train_end = F.floor(total * F.lit(float(ratios["train"])))
    val_end = train_end + F.floor(total * F.lit(float(ratios["val"])))
    targets = (
        counts.withColumn("last", F.sum("n").over(upto))
        .withColumn("total", F.sum("n").over(per_stratum))
        .select(
            "stratum", "bucket", "last", (F.col("last") - F.col("n")).alias("before"),
            F.inline(F.array(
                F.struct(F.lit("train").alias("cut"), train_end.alias("position")),
                F.struct(F.lit("val").alias("cut"), val_end.alias("position")),
            )),
        )
        .filter((F.col("before") < F.col("position")) & (F.col("position") <= F.col("last")))
        .select("stratum", "bucket", "cut", (F.col("position") - F.col("before")).alias("rank"))
    )
    # The bucket of a cut holds about 1/65,536 of the groups of its stratum.
    within = Window.partitionBy("stratum", "bucket").orderBy("key")
    cut_buckets = targets.select("stratum", "bucket").distinct()
    ranked = keyed.join(cut_buckets, ["stratum", "bucket"], "left_semi").withColumn(
        "rank", F.row_number().over(within).cast("long")
    )
    found = ranked.join(targets, ["stratum", "bucket", "rank"])
    return found.groupBy("stratum").agg(
        F.max(F.when(F.col("cut") == "train", F.col("key"))).alias("train_cut"),
        F.max(F.when(F.col("cut") == "val", F.col("key"))).alias("val_cut"),
    )


def _side(key: Column, train_cut: Column, val_cut: Column) -> Column:
    return F.when(key <= train_cut, "train").when(key <= val_cut, "val").otherwise("test")


@dataclass(frozen=True)
class GroupSplit:
    """The last key of train and of val, None where the split has no group."""

    seed: int
    group: str
    train_cut: str | None
    val_cut: str | None

    def assign(self, rows: DataFrame) -> DataFrame:
        """Add the split column from the group id of each row alone."""
        cuts = [F.lit(c).cast("string") for c in (self.train_cut, self.val_cut)]
        return rows.withColumn("split", _side(_rank_key(self.seed, F.col(self.group)), *cuts))


def fit_group_split(
    rows: DataFrame,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    seed: int = DEFAULT_SEED,
    group: str = "family_id",
) -> GroupSplit:
    """Find the cuts for exact group counts: int(n*train), int(n*val), the rest."""
    check_ratios(ratios)
    key = _rank_key(seed, F.col("group_id"))
    keyed = (
        rows.select(F.col(group).alias("group_id")).distinct()
        .select(key.alias("key"), F.substring(key, 1, _BUCKET_DIGITS).alias("bucket"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        counts = sorted(keyed.groupBy("bucket").agg(F.count("*")).collect())
        total = sum(n for _, n in counts)
        train_end = int(total * ratios["train"])
        targets = _positions(counts, (train_end, train_end + int(total * ratios["val"])))
        within = Window.partitionBy("bucket").orderBy("key")
        ranked = keyed.filter(F.col("bucket").isin([b for b, _ in targets.values()])).withColumn(
            "rank", F.row_number().over(within)
        )
        wanted = F.lit(False)
        for bucket, rank in targets.values():
            wanted = wanted | ((F.col("bucket") == bucket) & (F.col("rank") == rank))
        found = {(r.bucket, r.rank): r.key for r in ranked.filter(wanted).collect()}
    finally:
        keyed.unpersist()
    train_cut, val_cut = (found.get(targets.get(i)) for i in range(2))
    return GroupSplit(seed, group, train_cut, val_cut)


def _positions(counts: list, ends: tuple[int, int]) -> dict[int, tuple[str, int]]:
    """Bucket and rank within it of every 1-based position that is above 0."""
    found = {}
    before = 0
    for bucket, n in counts:
        for i, end in enumerate(ends):
            if before < end <= before + n:
                found[i] = (bucket, end - before)
        before += n
    return found


def split_by_group(
    rows: DataFrame,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    seed: int = DEFAULT_SEED,
    group: str = "family_id",
    groups: DataFrame | None = None,
) -> DataFrame:
    """Fit the cuts and add the split column.

    groups may name a cheaper frame that holds the same group ids as rows.
    """
    return fit_group_split(rows if groups is None else groups, ratios, seed, group).assign(rows)


def split_by_hash(
    rows: DataFrame,
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    seed: int = DEFAULT_SEED,
    group: str = "family_id",
) -> DataFrame:
    """Add a split column from the group id alone: ratios hold approximately, and
    groups that arrive later never move the earlier ones."""
    check_ratios(ratios)
    u = hash_fraction(seed, F.col(group))
    train, val = float(ratios["train"]), float(ratios["train"] + ratios["val"])
    return rows.withColumn(
        "split", F.when(u < train, "train").when(u < val, "val").otherwise("test")
    )


def split_stratified(
    rows: DataFrame,
    stratum: str = "source",
    ratios: Mapping[str, float] = DEFAULT_RATIOS,
    seed: int = DEFAULT_SEED,
    group: str = "family_id",
) -> DataFrame:
    """Add a split column with the exact ratios inside every stratum.

    A group belongs to the smallest stratum value among its rows.
    """
    check_ratios(ratios)
    groups = rows.groupBy(F.col(group).alias("group_id")).agg(F.min(stratum).alias("stratum"))
    cuts = _cut_keys(groups, ratios, seed)
    key = _rank_key(seed, F.col("group_id"))
    assigned = groups.join(cuts, "stratum", "left").select(
        F.col("group_id").alias(group), _side(key, F.col("train_cut"), F.col("val_cut")).alias("split")
    )
    return rows.join(assigned, group)


def assign_folds(
    rows: DataFrame, folds: int = 5, seed: int = DEFAULT_SEED, group: str = "family_id"
) -> DataFrame:
    """Add a fold number 0..folds-1 that never divides a group."""
    digits = F.substring(order_key(f"fold:{seed}", F.col(group)), 1, 8)
    return rows.withColumn("fold", (F.conv(digits, 16, 10).cast("long") % folds).cast("int"))
