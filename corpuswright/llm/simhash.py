"""SimHash near-duplicates through an inverted index over byte positions.

A document's fingerprint takes the majority of each bit over the XXH64 hashes of its
three-word shingles. Two fingerprints that differ in at most two bits agree in at least
six of their eight bytes. So at least two of the four two-byte positions agree, and the
index lists each fingerprint under the six pairs of positions with their four bytes.
Fingerprints that meet in a list are tallied by the bytes they share, kept from six on,
and verified by their differing bits. Lists with many fingerprints are not paired: there
each fingerprint is listed under itself and its 64 one-bit neighbours. Two fingerprints
share such a key exactly when they differ in at most two bits, all that share one differ
in at most two, and no key can have more than 65, so the work stays linear.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType

from corpuswright.llm.components import components
from corpuswright.sources.staging import stage

SHINGLE_WORDS = 3
MAX_BITS = 2
_BYTES = 8
_MIN_SHARED = _BYTES - MAX_BITS
# A longer list goes the linear way; the result is the same either way.
_PAIRED_LIST = 64
# Shingles hashed at once: bounds the memory for a very long text.
_SLICE = 1 << 16


@F.arrow_udf(LongType())
def fingerprint(texts):
    """Signed 64-bit fingerprint of each text given as UTF-8 binary."""
    import numpy as np
    import pyarrow as pa
    from xxhash import xxh64_intdigest

    shifts = np.arange(8, dtype=np.uint64)[:, None]
    lanes = np.uint64(0x0101010101010101)
    weights = np.uint64(1) << (np.arange(8, dtype=np.uint64)[None, :] * np.uint64(8) + shifts)

    def counts(hashes):
        # Lane j of (hash >> k) & lanes holds bit 8j+k; 255 such numbers add up without a carry.
        padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
        padded[: len(hashes)] = hashes
        sums = ((padded[None, :] >> shifts) & lanes).reshape(8, -1, 255).sum(axis=2)
        return sums.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)

    def one(text):
        words = (text or b"").lower().split()
        n = len(words)
        if n == 0:
            return 0
        if n < SHINGLE_WORDS:
            hashes = [xxh64_intdigest(b" ".join(words), 42)]
            total, n = counts(np.array(hashes, np.uint64)), 1
        else:
            n -= SHINGLE_WORDS - 1
            total = 0
            for at in range(0, n, _SLICE):
                part = words[at : at + _SLICE + SHINGLE_WORDS - 1]
                hashes = [xxh64_intdigest(b" ".join(x), 42) for x in zip(part, part[1:], part[2:])]
                total = total + counts(np.array(hashes, np.uint64))
        return int(weights[2 * total > n].sum(dtype=np.uint64).astype(np.int64))

    return pa.array([one(t) for t in texts.to_pylist()], pa.int64())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint): one row per document, fingerprint a signed long.

    Words are what lies between ASCII blanks, A-Z lower-cased. A text with one or two
    words is one shingle; a null text or one without words has fingerprint zero.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text).cast("binary")).alias("fingerprint"))


def _group(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF))


def _bytes_shared(difference: Column) -> Column:
    shared = F.lit(0)
    for i in range(_BYTES):
        octet = F.shiftrightunsigned(difference, 8 * i).bitwiseAND(F.lit(0xFF))
        shared = shared + (octet == 0).cast("int")
    return shared


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints within two bits of each other."""
    fp = F.col("fingerprint")
    postings = distinct.select("fingerprint", F.inline(F.array(*[
        F.struct(F.lit(i).alias("positions"), F.shiftleft(_group(fp, x), 16).bitwiseOR(_group(fp, y)).alias("octets"))
        for i, (x, y) in enumerate(combinations(range(4), 2))
    ])))
    key = ["positions", "octets"]
    lists = postings.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    listed = stage(postings.join(lists, key), "postings")

    paired = listed.filter(F.col("n") <= _PAIRED_LIST).drop("n")
    other = paired.withColumnRenamed("fingerprint", "b")
    difference = F.col("a").bitwiseXOR(F.col("b"))
    pairs = (
        paired.withColumnRenamed("fingerprint", "a").join(other, key).filter("a < b")
        .filter(_bytes_shared(difference) >= _MIN_SHARED)
        .filter(F.bit_count(difference) <= MAX_BITS)
        .select("a", "b")
    )

    crowded = listed.filter(F.col("n") > _PAIRED_LIST).select("fingerprint").distinct()
    flipped = [fp.bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")) for i in range(64)]
    balls = crowded.select("fingerprint", F.explode(F.array(fp, *flipped)).alias("ball"))
    members = balls.groupBy("ball").agg(F.collect_set("fingerprint").alias("members")).filter(F.size("members") > 1)
    stars = members.select(F.array_min("members").alias("a"), F.explode("members").alias("b")).filter("a < b")
    return pairs.unionByName(stars)


def _classes(prints: DataFrame, least: Column) -> DataFrame:
    """(fingerprint, least): for each fingerprint the smallest value of a column over its component."""
    distinct = stage(prints.groupBy("fingerprint").agg(F.min(least).alias("least")), "distinct")
    reached = stage(components(links(distinct)), "components")
    classes = distinct.join(reached, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component"))
    smallest = classes.groupBy("component").agg(F.min("least").alias("least"))
    return stage(classes.drop("least").join(smallest, "component").select("fingerprint", "least"), "classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, kept): one row per document.

    component_id is the smallest doc_id reachable over links, the document's own
    included; kept is true where it is the document's own. Documents with a null doc_id
    take part, but only numbers are compared for the smallest; a group without any
    number has a null component_id and kept is null. Equal rows are members like others.
    Other columns of docs are not read. An empty table gives an empty one.
    """
    prints = stage(fingerprints(docs, doc_id, text), "fingerprints")
    mapping = _classes(prints, F.col("doc_id")).withColumnRenamed("least", "component_id")
    return prints.join(mapping, "fingerprint").select(
        "doc_id", "fingerprint", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def distinct_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, with all columns: the one with the smallest doc_id.

    Rows are told apart by their place, not by doc_id, so of rows that share a doc_id, or
    have none, only the near copies go. A null doc_id comes after all numbers. docs is
    written once, with the places.
    """
    # Names by place cannot meet the names used here.
    names = [f"__{i}" for i in range(len(docs.columns))]
    own_id, own_text = (names[docs.columns.index(c)] for c in (doc_id, text))
    placed = stage(docs.toDF(*names).withColumn("__row", F.monotonically_increasing_id()), "placed")
    key = F.struct(F.col(own_id).isNull().alias("missing"), F.col(own_id).alias("doc_id"), F.col("__row").alias("row"))
    prints = stage(
        placed.select(key.alias("key"), fingerprint(F.col(own_text).cast("binary")).alias("fingerprint")), "fingerprints")
    repeated = prints.join(_classes(prints, F.col("key")), "fingerprint").filter("key.row <> least.row")
    dropped = stage(repeated.select(F.col("key.row").alias("__row")), "dropped")
    return placed.join(dropped, "__row", "left_anti").select(*names).toDF(*docs.columns)
