"""Trie of shared conversation beginnings, by truncation peeling.

Turns become digests at the scan; texts are not shuffled. One streaming pass chains the
digests of every conversation, so that a prefix of any length has a key of 16 bytes.
Then the trie is peeled from its deepest level upwards: nodes of a level are found by
grouping the conversations that end there with the nodes that survive from below, their
last turn stripped, and the same grouping sums what the subtree holds. No node is
visited twice.

Most turns lie on stretches where nothing merges. A stretch of levels is therefore
stripped at once, and its rows are grouped by what is left: rows that stay alone there
give their whole stretch of nodes, the others are peeled again in two halves, down to
single levels. Stretches double in length up to 4,096 levels, which bounds a row. The
number of grouping steps follows the levels on which prefixes really merge.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.sources.staging import new_location, stage

_LONGEST = 4096
_RUN_BITS = 10
_ROOT = bytes(16)
_NO_IDS = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of no bytes
WORD = r"[^\x20\x09-\x0D]+"
_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, parent_key binary, key binary"
)


def stretches() -> Iterator[tuple[int, int]]:
    """(low, high) level bounds from the top of the trie down: (0, 1), (1, 2), (2, 4), ..."""
    low, step = 0, 1
    while True:
        yield low, low + step
        low += step
        step = min(max(low, 1), _LONGEST)


def digested(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words): a turn as the digest of its role and text.

    Null roles and texts count as empty; rows without a conv_id are left out.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    return turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.sha2(whole, 256)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))


def with_borrowed_heads(turns: DataFrame, heads: int = 4, block: int = 20) -> DataFrame:
    """Conversations whose first turns come from another one.

    turns: as digested() gives them. Conversation c gets the first crc32(c) % heads turns
    of conversation c - c % block in place of its own, all if there are fewer, none if it
    is absent. Returns (conv_id, kind, turn, digest, words, skipped): kind 0 are borrowed
    turns, kind 1 own ones, of which the first `skipped` do not count.
    """
    skipped = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    lender = F.col("conv_id") - F.col("conv_id") % block
    own = turns.withColumn("skipped", F.when(F.col("conv_id") == lender, 0).otherwise(skipped))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "digest", "words")
    lent = (
        turns.filter(F.col("conv_id") == lender).withColumn("place", F.row_number().over(order))
        .filter(F.col("place") < heads).select(F.col("conv_id").alias("lender"), "place", "digest", "words")
    )
    borrowers = own.filter("skipped > 0").select("conv_id", "skipped").distinct().withColumn("lender", lender)
    borrowed = borrowers.join(lent, "lender").filter("place <= skipped").select(
        "conv_id", F.lit(0).alias("kind"), F.col("place").cast("long").alias("turn"), "digest", "words", "skipped")
    return borrowed.unionByName(own.select(
        "conv_id", F.lit(1).alias("kind"), F.col("turn").cast("long").alias("turn"), "digest", "words", "skipped"))


def _chain(batches: Iterator) -> Iterator:
    """Keys of all prefixes, from rows sorted by conversation, one row for each stretch.

    A row holds the levels from low to its last one, both included: their keys, and their
    words summed up from low on; beside them the words of the last level alone.
    """
    from hashlib import blake2b
    from itertools import count

    import pyarrow as pa

    kind = pa.schema([("conv_id", pa.int64()), ("low", pa.int64()), ("depth", pa.int64()), ("last", pa.bool_()),
                      ("keys", pa.list_(pa.binary())), ("sums", pa.list_(pa.int64())), ("words", pa.int64())])
    done: list = []
    held = 0
    state: dict = {}

    def close(last: bool) -> None:
        nonlocal held
        held += len(state["keys"])
        done.append((state["id"], state["low"], state["depth"], last, state["keys"], state["sums"], state["words"]))

    def flush():
        nonlocal held, done
        batch = pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*done), kind)], schema=kind)
        done, held = [], 0
        return batch

    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096).to_pydict()
            for conv, own, digest, words, skipped in zip(
                part["conv_id"], part["kind"], part["digest"], part["words"], part["skipped"]
            ):
                if conv != state.get("id"):
                    if state:
                        close(True)
                    bounds = stretches()
                    low, high = next(bounds)
                    state = {"id": conv, "skip": skipped, "depth": 0, "low": low, "high": high, "bounds": bounds,
                             "keys": [_ROOT], "sums": [0], "words": 0}
                if own and state["skip"]:
                    state["skip"] -= 1
                    continue
                if state["depth"] == state["high"]:
                    close(False)
                    low, high = next(state["bounds"])
                    state |= {"low": low, "high": high, "keys": state["keys"][-1:], "sums": [state["words"]]}
                state["depth"] += 1
                state["keys"].append(blake2b(state["keys"][-1] + digest, digest_size=16).digest())
                state["sums"].append(state["sums"][-1] + words)
                state["words"] = words
            if held > 50_000:
                yield flush()
    if state:
        close(True)
    if done:
        yield flush()


def _hash_runs(batches: Iterator) -> Iterator:
    """SHA-256 of every key's runs of ids, from rows sorted by key and run."""
    from hashlib import sha256

    import pyarrow as pa

    key, digest, found = None, None, []

    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in found], pa.binary()), pa.array([d for _, d in found])], ["key", "ends"])

    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096).to_pydict()
            for this, ids in zip(part["key"], part["ids"]):
                if this != key:
                    if key is not None:
                        found.append((key, digest.hexdigest()))
                    key, digest = this, sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            if len(found) > 10_000:
                yield rows()
                found = []
    if key is not None:
        found.append((key, digest.hexdigest()))
    if found:
        yield rows()


def _ended(paths: DataFrame) -> DataFrame:
    """One row for each distinct whole conversation, as part of its node.

    Ids are joined to texts in runs of 1,024 numbers, so that a conversation of very many
    copies reaches the task that hashes its ids as few rows.
    """
    last = paths.filter("last").select(
        "conv_id", "low", "depth", F.element_at("keys", -1).alias("key"), "words")
    run = F.shiftright("conv_id", _RUN_BITS)
    runs = stage(last.groupBy("key", run.alias("run")).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("low").alias("low"),
        F.first("depth").alias("depth"), F.first("words").alias("words"),
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")), "ends")
    digests = (
        runs.select("key", "run", "ids").repartition("key").sortWithinPartitions("key", "run")
        .select("key", "ids").mapInArrow(_hash_runs, "key binary, ends string")
    )
    merged = runs.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("low").alias("low"),
        F.first("depth").alias("depth"), F.first("words").alias("words"))
    zero = F.lit(0).cast("long")
    return merged.join(digests, "key").select(
        "low", "depth", "key", "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"),
        zero.alias("saved"), "words", "ends")


_PART = ["depth", "key", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "words", "ends"]


def _regroup(parts: DataFrame, *carried: str) -> DataFrame:
    """One row per node from its parts: what ended there and one row for each child."""
    return parts.groupBy("key").agg(
        F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
        F.max("words").alias("words"), F.max("ends").alias("ends"), *[F.first(c).alias(c) for c in carried])


class _Peeling:
    """Peels one stretch after the other; nodes are appended to a table of the shared folder."""

    def __init__(self, spark):
        self.spark, self.found = spark, new_location(spark, "nodes")

    def nodes(self) -> DataFrame:
        return self.spark.read.schema(_NODES).parquet(self.found)

    def _strip(self, rows: DataFrame, base: int, low: int) -> DataFrame:
        """Strip rows down to level low, where they are alone; their nodes are written.

        rows: nodes with the keys and word sums of their levels from base on. Between low
        and the row's own level nothing merges, so every node there has the row's members.
        """
        tops = stage(rows.withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")))
                     .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("words")), "tops")

        def key(level: Column | int) -> Column:
            return F.element_at("level_keys", (F.lit(level) - base + 1).cast("int"))

        def words_below(level: Column | int) -> Column:
            """Words of the levels from base up to, but without, this one."""
            index = (F.lit(level) - base).cast("int")
            return F.when(index > 0, F.element_at("level_sums", F.greatest(index, F.lit(1)))).otherwise(0)

        def saved(level: Column) -> Column:
            return F.col("saved") + (F.col("n_convs") - 1) * (words_below(F.col("depth")) - words_below(level))

        def node(level: Column) -> Column:
            top, lowest = level == F.col("depth"), level == low + 1
            return F.struct(
                level.alias("at"), F.when(~lowest, F.col("conv_id")).alias("parent_conv_id"),
                F.when(top, F.col("n_children")).otherwise(1).cast("long").alias("children"),
                saved(level).alias("saved_tokens"), F.when(top, F.col("ends")).alias("ends_sha256"),
                F.when(lowest, key(low)).alias("parent_key"), key(level).alias("own_key"))

        levels = F.transform(F.sequence(F.lit(low + 1).cast("long"), F.col("depth")), node)
        tops.select("conv_id", "n_convs", "n_leaves", F.inline(levels)).select(
            "conv_id", F.col("at").alias("depth"), "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
            "n_leaves", "saved_tokens", "ends_sha256", "parent_key", F.col("own_key").alias("key"),
        ).write.mode("append").parquet(self.found)
        return tops.select(
            F.lit(low).cast("long").alias("depth"), key(low).alias("key"), "conv_id", "n_convs",
            F.lit(1).cast("long").alias("n_children"), "n_leaves", saved(F.lit(low + 1)).alias("saved"),
            (words_below(low + 1) - words_below(low)).alias("words"), F.lit(None).cast("string").alias("ends"),
            "level_keys", "level_sums")

    def peel(self, rows: DataFrame, base: int, low: int, high: int) -> DataFrame:
        """Peel levels high to low + 1, one row per node; returns the parts that survive at level low."""
        if high == low + 1:
            return self._strip(rows, base, low)
        rows = stage(rows.withColumn("left_key", F.element_at("level_keys", low - base + 1)), "levels")
        # Staged, so that the join shuffles both sides and a key with many rows can be divided.
        shared = stage(rows.groupBy("left_key").agg(F.count("*").alias("rows")).filter("rows > 1"), "shared")
        survivors = self._strip(rows.join(shared, "left_key", "left_anti").drop("left_key"), base, low)
        if shared.isEmpty():
            return survivors
        crowd = stage(rows.join(shared, "left_key", "left_semi").drop("left_key"), "crowd")
        middle = (low + high) // 2
        lower, upper = crowd.filter(F.col("depth") <= middle), crowd.filter(F.col("depth") > middle)
        if not upper.isEmpty():
            peeled = self.peel(upper, base, middle, high)
            lower = _regroup(lower.unionByName(peeled), "level_keys", "level_sums")
        return survivors.unionByName(self.peel(lower, base, low, middle))


def build_trie(turns: DataFrame) -> DataFrame:
    """Nodes of the trie of all conversations.

    turns: (conv_id, kind, turn, digest, words, skipped), as with_borrowed_heads() gives
    them; digested() rows with kind 1 and skipped 0 stand for unchanged conversations.
    Turns go by turn, null first, and equal ones by their digest. Returns one row per
    node: conv_id, its smallest member; depth; parent_conv_id, null at the root; n_convs;
    n_children; n_leaves; saved_tokens, the words that need not be repeated in its
    subtree; ends_sha256 over the ids of the conversations that end there. A conversation
    without a turn ends at the root. Without any conversation there is no node.
    """
    spark = turns.sparkSession
    order = ["conv_id", "kind", F.asc_nulls_first("turn"), "digest", "words"]
    chained = turns.repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "kind", "digest", "words", "skipped").mapInArrow(
        _chain, "conv_id long, low long, depth long, last boolean, keys array<binary>, sums array<long>, words long")
    # One folder for each stretch, read when its turn comes.
    place = new_location(spark, "paths")
    chained.write.partitionBy("low").parquet(place)
    shape = "conv_id long, depth long, last boolean, keys array<binary>, sums array<long>, words long, low long"
    paths = spark.read.schema(shape).parquet(place)
    ended = stage(_ended(paths), "ended")
    deepest = ended.agg(F.max("depth").alias("d")).first()["d"]
    peeling = _Peeling(spark)
    bounds = []
    for low, high in stretches():
        bounds.append((low, high))
        if deepest is None or high >= deepest:
            break
    arrays = paths.select("conv_id", "low", F.col("keys").alias("level_keys"), F.col("sums").alias("level_sums"))
    survivors = None
    for low, high in reversed(bounds):
        parts = ended.filter((F.col("low") == low) & (F.col("depth") > low)).select(*_PART)
        if survivors is not None:
            parts = parts.unionByName(survivors.select(*_PART))
        parts = stage(_regroup(parts), "parts")
        here = parts.join(arrays.filter(F.col("low") == low).drop("low"), "conv_id")
        survivors = peeling.peel(here, low, low, high)
    roots = survivors.select(*_PART).unionByName(ended.filter("depth = 0").select(*_PART))
    _regroup(roots).select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
        F.lit(None).cast("binary").alias("parent_key"), "key",
    ).write.mode("append").parquet(peeling.found)
    nodes = peeling.nodes()
    # Inside a stretch, and at the root, the parent is known; nulls would meet in one task.
    known = nodes.filter("parent_key IS NULL").drop("parent_key", "key")
    parents = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("found"))
    joined = nodes.filter("parent_key IS NOT NULL").join(parents, "parent_key").withColumn("parent_conv_id", F.col("found"))
    return known.unionByName(joined.drop("parent_key", "key", "found")).withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS)))
