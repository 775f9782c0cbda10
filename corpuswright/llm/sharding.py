"""Shards from a hierarchical weighted hash tree, in DataFrame expressions only.

A row descends region, rack and shard. At each level every child draws -ln(u) / weight
with u hashed from the row's key and the child's name, and the smallest draw wins, so a
child gets rows in proportion to its weight, which is the sum of the weights below it.
A change of one weight changes only the draws on the path to it: rows move only into a
subtree that has grown or out of one that has shrunk.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from corpuswright.llm.ranks import number_within


@dataclass(frozen=True)
class Leaf:
    """A shard, its place and its weight; a weight of 0 takes no rows."""

    region: str
    rack: str
    shard: int
    weight: float = 1.0


def topology(shards: int, shards_per_rack: int = 2, racks_per_region: int = 2) -> list[Leaf]:
    """Equal shards, numbered from 0 and filled rack by rack, region by region."""
    racks = [s // shards_per_rack for s in range(shards)]
    return [Leaf(f"region{r // racks_per_region}", f"rack{r}", s) for s, r in enumerate(racks)]


def with_shard(leaves: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """One more shard, in a region of its own.

    All the weight that is new lies on the path to it, so rows move into it and nowhere
    else. Put into an existing region it would also draw rows to its neighbours there.
    """
    shard = max((leaf.shard for leaf in leaves), default=-1) + 1
    return [*leaves, Leaf(f"region-of-{shard}", f"rack-of-{shard}", shard, weight)]


def _winner(key: Column, children: Iterable[tuple[str, float, Column]]) -> Column:
    """The value of the child with the smallest draw; children as (name, weight, value)."""
    kept = [child for child in children if child[1] > 0]
    if len(kept) == 1:
        return kept[0][2]
    draws = []
    for name, weight, _ in kept:
        # 53 bits of the hash, moved off zero.
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(name)), 11) + F.lit(0.5)) / F.lit(float(2**53))
        draws.append(-F.log(u) / F.lit(float(weight)))
    least = F.least(*draws)
    chosen = F.when(draws[0] == least, kept[0][2])
    for draw, (_, _, value) in zip(draws[1:], kept[1:]):
        chosen = chosen.when(draw == least, value)
    return chosen


def shard_of(key: Column, leaves: list[Leaf]) -> Column:
    """The shard of a key: a null key counts as the empty string."""
    if not any(leaf.weight > 0 for leaf in leaves):
        raise ValueError("no shard has a weight above 0")
    if len({leaf.shard for leaf in leaves}) < len(leaves):
        raise ValueError("a shard is named twice")
    text = F.coalesce(key.cast("string"), F.lit(""))
    regions: dict[str, dict[str, list[Leaf]]] = {}
    for leaf in leaves:
        regions.setdefault(leaf.region, {}).setdefault(leaf.rack, []).append(leaf)

    def weight(of: Iterable[Leaf]) -> float:
        return sum(max(leaf.weight, 0.0) for leaf in of)

    def rack(region: str, name: str, shards: list[Leaf]) -> Column:
        return _winner(text, [(f"{region}/{name}/{x.shard}", x.weight, F.lit(x.shard)) for x in shards])

    def region(name: str, racks: dict[str, list[Leaf]]) -> Column:
        return _winner(text, [
            (f"{name}/{k}", weight(v), rack(name, k, v)) for k, v in racks.items() if weight(v) > 0])

    return _winner(text, [
        (k, w, region(k, v)) for k, v in regions.items() if (w := weight(x for y in v.values() for x in y)) > 0])


def shard(docs: DataFrame, leaves: list[Leaf], grown: list[Leaf] | None = None, doc_id: str = "doc_id",
          text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per document.

    size is the UTF-8 bytes of the text plus one (null text: 1, checksum 0). The shard
    follows from doc_id and the tree alone, so equal rows share one. slot numbers the rows of
    a shard from 0 without a gap; grown_shard is the shard in the grown tree. Other
    columns are not read; an empty table gives an empty one.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(content) + F.lit(1)).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(F.col(doc_id), leaves).cast("int").alias("shard"),
        (shard_of(F.col(doc_id), grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    return number_within(narrow, ["shard"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
