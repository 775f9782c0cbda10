"""Chat formatting as a prefix tree of turns.

Conversations with the same first turns share them: a node of the tree is a distinct
sequence of turns from the start, identified by a chained digest. Conversations in the
order of their paths visit the tree depth first, and each emits the nodes that no
earlier one has. So shared turns are emitted once, a node's ancestors lie before it, and
its position ids go on from its parent. The intervals of emitted tokens that a node may
attend to, besides the tokens before it in its own run, are those of its ancestors.

Template: "<|im_start|>role\\n" text "<|im_end|>\\n". In role and text an escape sign goes
before itself and inside every "<|", so that control strings cannot be forged and the
original comes back; a line break in a role is escaped too. Nothing is collected in one
place: a conversation streams through one task, hot nodes are only counted and joined.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F

from corpuswright.sources.staging import stage

START, END, ESCAPE = "<|im_start|>", "<|im_end|>", "␛"
_ESCAPED = re.compile(ESCAPE + "(.)", re.DOTALL)
LEARNED_ROLE = "assistant"


def escape(text: str) -> str:
    return text.replace(ESCAPE, ESCAPE * 2).replace("<|", f"<{ESCAPE}|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", ESCAPE + "n")


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


_TURN = (
    "conv_id long, position long, node binary, parent binary, root binary, formatted string, body_start long, "
    "body_length long, learned boolean, tokens array<int>, learned_from int, learned_to int, units long, "
    "position_id long, path binary"
)


def _chain(tokenizer: str | None):
    """Turns sorted by conversation to formatted turns with digests; the last one carries the path."""

    def run(batches: Iterator) -> Iterator:
        from hashlib import blake2b

        import pyarrow as pa

        encode = None
        if tokenizer:
            from tokenizers import Tokenizer

            loaded = Tokenizer.from_file(tokenizer)
            loaded.encode_special_tokens = True

            def encode(parts):
                return [e.ids for e in loaded.encode_batch_fast(parts, add_special_tokens=False)]

        state = {"conv": None, "open": False}

        def turn(conv, role, text):
            if not state["open"] or state["conv"] != conv:
                state.update(conv=conv, open=True, position=0, node=b"", root=None, units=0, path=[])
            role, text = role or "", text or ""
            digest = blake2b(state["node"], digest_size=16)
            for part in (role.encode(), text.encode()):
                digest.update(len(part).to_bytes(8, "little") + part)
            head, body, tail = f"{START}{escape_role(role)}\n", escape(text), f"{END}\n"
            tokens = encode([head, body, tail]) if encode else None
            units = sum(map(len, tokens)) if tokens else len(head) + len(body) + len(tail)
            node = digest.digest()
            row = {
                "conv_id": conv, "position": state["position"], "node": node, "parent": state["node"] or None,
                "root": state["root"] or node, "formatted": head + body + tail, "body_start": len(head),
                "body_length": len(body), "learned": role == LEARNED_ROLE,
                "tokens": sum(tokens, []) if tokens else None, "learned_from": len(tokens[0]) if tokens else None,
                "learned_to": len(tokens[0]) + len(tokens[1]) if tokens else None, "units": units,
                "position_id": state["units"], "path": None,
            }
            state["path"].append(node[:8])
            state.update(position=state["position"] + 1, node=node, root=row["root"], units=state["units"] + units)
            return row

        schema = pa.schema([
            ("conv_id", pa.int64()), ("position", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()),
            ("root", pa.binary()), ("formatted", pa.string()), ("body_start", pa.int64()), ("body_length", pa.int64()),
            ("learned", pa.bool_()), ("tokens", pa.list_(pa.int32())), ("learned_from", pa.int32()),
            ("learned_to", pa.int32()), ("units", pa.int64()), ("position_id", pa.int64()), ("path", pa.binary()),
        ])
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                out = []
                for conv, role, text in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns)):
                    path = state.get("path")
                    row = turn(conv, role, text)
                    if held is not None:
                        if row["position"] == 0:
                            held["path"] = b"".join(path)
                        out.append(held)
                    held = row
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            held["path"] = b"".join(state["path"])
            yield pa.RecordBatch.from_pylist([held], schema)

    return run


def _merged(intervals: Column) -> Column:
    """Sorted disjoint intervals with neighbours joined."""

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        joined = F.concat(
            F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["begin"].alias("begin"), x["end"].alias("end"))))
        return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] == x["begin"]), joined).otherwise(
            F.concat(done, F.array(x)))

    empty = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    return F.aggregate(F.array_sort(intervals), empty, step)


def format_conversations(turns: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The nodes of the prefix tree, and the path of each conversation through it.

    turns: conv_id, turn, role, text; other columns are not read. Turns are taken in the
    order of turn, then role, then text; a null role or text is empty, null conv_ids are
    one conversation. Units are token ids with a tokenizer file, else code points.

    nodes: node, parent (null at a root), tree (its root), formatted, body_start and
    body_length of the escaped text in it, learned (its text is under the loss mask),
    tokens with learned_from and learned_to, units, position_id of its first unit, offset
    of its first unit in the emission, ancestors: the emitted intervals before it that it
    may attend to. Trees follow each other in the emission without a gap.
    paths: conv_id, position from 0, node.
    """
    ordered = turns.select(F.col("conv_id").cast("long"), "turn", "role", "text").repartition("conv_id")
    chained = stage(
        ordered.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
        .mapInArrow(_chain(tokenizer), _TURN),
        "turns",
    )
    # Partition numbers in the upper bits: the numbers rise with the order of the paths.
    conversations = stage(
        chained.filter("path IS NOT NULL").select("conv_id", "path").repartitionByRange("path", "conv_id")
        .sortWithinPartitions("path", "conv_id").select("conv_id", F.monotonically_increasing_id().alias("visit")),
        "visits",
    )
    narrow = chained.select("conv_id", "position", "node", "units")
    visited = narrow.join(conversations, narrow["conv_id"].eqNullSafe(conversations["conv_id"])).select(
        "visit", "position", "node", "units")
    visited = stage(visited, "visited")
    owned = stage(
        visited.groupBy("node").agg(
            F.min("visit").alias("visit"), F.first("position").alias("position"), F.first("units").alias("units")),
        "owned",
    )
    # Every visit that emits something: where it begins in the emission and in its path.
    runs = owned.groupBy("visit").agg(F.sum("units").alias("n"), F.min("position").alias("first"))
    part = F.shiftright("visit", 33)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition.
    parts = runs.groupBy(part.alias("part")).agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("visit").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(
        runs.withColumn("part", part).withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(F.broadcast(parts), "part")
        .select("visit", "first", (F.col("before") + F.col("inside")).alias("begin")),
        "starts",
    )
    along = Window.partitionBy("visit").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    placed = stage(
        owned.join(starts, "visit").withColumn("offset", F.col("begin") + F.coalesce(F.sum("units").over(along), F.lit(0)))
        .select("node", "visit", "position", "units", "begin", "offset"),
        "placed",
    )
    interval = F.struct(F.col("offset").alias("begin"), (F.col("offset") + F.col("units")).alias("end"))
    above = (
        visited.join(starts.filter("first > 0"), "visit").filter(F.col("position") < F.col("first"))
        .select("node", F.col("visit").alias("of"))
        .join(placed.select("node", interval.alias("interval")), "node")
        .groupBy(F.col("of").alias("visit")).agg(F.collect_list("interval").alias("above"))
    )
    own = F.when(
        F.col("offset") > F.col("begin"), F.array(F.struct(F.col("begin").alias("begin"), F.col("offset").alias("end")))
    ).otherwise(F.array())
    reach = _merged(F.concat(F.coalesce("above", F.array()), own))
    located = placed.join(above, "visit", "left").select(
        "visit", "position", "offset", reach.alias("ancestors"))
    emitted = (
        chained.drop("path").join(conversations.withColumnRenamed("conv_id", "owner"), F.col("conv_id").eqNullSafe(F.col("owner")))
        .join(located, ["visit", "position"])
    )
    nodes = stage(
        emitted.select(
            "node", "parent", F.col("root").alias("tree"), "formatted", "body_start", "body_length", "learned", "tokens",
            "learned_from", "learned_to", "units", "position_id", "offset", "ancestors"),
        "nodes",
    )
    return nodes, chained.select("conv_id", "position", "node")


def _digest(batches: Iterator) -> Iterator:
    """Digests of conversations from their formatted turns, sorted by conversation and position."""
    from hashlib import sha256

    import pyarrow as pa

    schema = pa.schema([
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    now = None

    def close(x):
        return {
            "conv_id": x["conv"], "n_turns": x["n"], "turns_sha256": x["turns"].hexdigest(), "loss_chars": x["chars"],
            "loss_sha256": x["loss"].hexdigest(), "formatted_chars": x["formatted"]}

    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            out = []
            for conv, formatted, start, length, learned in zip(
                *(c.to_pylist() for c in batch.slice(at, 1000).columns)
            ):
                if now is None or now["conv"] != conv:
                    if now is not None:
                        out.append(close(now))
                    now = {"conv": conv, "n": 0, "turns": sha256(), "chars": 0, "loss": sha256(), "formatted": 0}
                role = unescape_role(formatted[len(START) : start - 1])
                text = unescape(formatted[start : start + length])
                now["n"] += 1
                now["turns"].update(f"{role}\n{text}\n".encode())
                now["formatted"] += len(formatted)
                if learned:
                    now["chars"] += len(text)
                    now["loss"].update(text.encode())
            yield pa.RecordBatch.from_pylist(out, schema)
    if now is not None:
        yield pa.RecordBatch.from_pylist([close(now)], schema)


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Digests of every conversation, put together again from the nodes on its path.

    Columns: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.
    """
    turns = paths.join(nodes.select("node", "formatted", "body_start", "body_length", "learned"), "node")
    return (
        turns.repartition("conv_id").sortWithinPartitions("conv_id", "position")
        .select("conv_id", "formatted", "body_start", "body_length", "learned")
        .mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                    "formatted_chars long")
    )
