"""Near-duplicate embeddings by tiled comparison along principal axes.

Vectors are compared within a class (equal label and length). Copies are merged first.
The rest are rotated onto the principal axes of all vectors, largest variance first,
sorted along the first axis and cut into blocks. Unit vectors with cosine t are at most
sqrt(2 - 2t) apart on any axis, so only blocks whose intervals come that close form a
tile. In a tile the dot products are accumulated over leading axes; the product of the
norms of what remains bounds the rest, and pairs that can no longer reach t are left.
A tile returns link counts per vector and edges of a spanning forest, never its pairs,
so a crowd of near copies costs no more output than its vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from corpuswright.llm.components import components
from corpuswright.sources.staging import stage

THRESHOLD = 0.93
BLOCK_BYTES = 1 << 19
# Leading axes after which pairs are left, as shares of the length.
_STEPS = (0.125, 0.25, 0.5, 1.0)
# Dot products along rotated axes are this close to the exact cosine.
_SLACK = 1e-9
_SALT = 16
_BLOCK = (
    "label string, width int, block long, low double, high double, ids array<long>, copies array<long>, vectors binary"
)


def _usable() -> Column:
    """Whether a row can link: an id, a label and a non-zero vector of finite numbers."""
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & nonzero, F.lit(False))


def _moments(batches: Iterator) -> Iterator:
    """Sums of the outer products of the unit vectors of one task, by length."""
    import numpy as np
    import pyarrow as pa

    sums = {}
    for batch in batches:
        vectors = batch.column(0)
        for at in range(0, len(vectors), 4096):
            part = vectors.slice(at, 4096).to_pylist()
            for width in {len(v) for v in part}:
                unit = _unit(np.array([v for v in part if len(v) == width], float))
                sums[width] = sums.get(width, 0) + unit.T @ unit
    for width, total in sums.items():
        yield pa.RecordBatch.from_pydict({
            "width": pa.array([width] * width, pa.int32()), "row": pa.array(range(width), pa.int32()),
            "line": pa.array(total.tolist(), pa.list_(pa.float64()))})


def _unit(vectors):
    import numpy as np

    # Scaled first: squares of very large or small numbers would leave the range.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame) -> dict:
    """Rotation by length of vector, from all rows; a length x length matrix each."""
    import numpy as np

    lines = vectors.select("vector").mapInArrow(_moments, "width int, row int, line array<double>")
    summed = (
        lines.select("width", "row", F.posexplode("line").alias("at", "value"))
        .groupBy("width", "row", "at").agg(F.sum("value").alias("value")).toPandas()
    )
    axes = {}
    for width, cells in summed.groupby("width"):
        moment = np.zeros((width, width))
        moment[cells["row"], cells["at"]] = cells["value"]
        axes[int(width)] = np.linalg.eigh(moment)[1][:, ::-1].copy()
    return axes


def _blocks(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 33
    held: list = []
    kind = None

    def emit(rows):
        nonlocal number
        vectors = np.array([r["vector"] for r in rows], float)
        leading = [r["leading"] for r in rows]
        number += 1
        return pa.RecordBatch.from_pydict({
            "label": [rows[0]["label"]], "width": pa.array([rows[0]["width"]], pa.int32()), "block": [number],
            "low": [min(leading)], "high": [max(leading)],
            "ids": pa.array([[r["vec_id"] for r in rows]], pa.list_(pa.int64())),
            "copies": pa.array([[r["copies"] for r in rows]], pa.list_(pa.int64())),
            "vectors": [vectors.tobytes()],
        })

    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            for row in batch.slice(at, 1024).to_pylist():
                if held and ((row["label"], row["width"]) != kind or len(held) * row["width"] * 8 >= BLOCK_BYTES):
                    yield emit(held)
                    held = []
                kind = (row["label"], row["width"])
                held.append(row)
    if held:
        yield emit(held)


def _compare(axes, threshold):
    """Tiles to (a, b, links): links of a, or an edge a-b of a spanning forest."""

    def tile(x, y, rotation, same):
        import numpy as np

        width = x.shape[1]
        ux, uy = _unit(x), _unit(y)
        zx, zy = ux @ rotation, uy @ rotation
        ends = sorted({max(1, math.ceil(width * s)) for s in _STEPS})
        sx, sy = (np.sqrt(np.cumsum((z * z)[:, ::-1], axis=1)[:, ::-1]) for z in (zx, zy))
        dense, begin, pairs, partial = np.zeros((len(zx), len(zy))), 0, None, None
        for end in ends:
            if pairs is None:
                dense += zx[:, begin:end] @ zy[:, begin:end].T
                bound = dense + np.outer(sx[:, end], sy[:, end]) if end < width else dense
                near = bound >= threshold - _SLACK
                if same:
                    near = np.triu(near, 1)
                if near.sum() * 16 < near.size or end == width:
                    pairs = np.nonzero(near)
                    partial = dense[pairs]
            else:
                i, j = pairs
                partial = partial + np.einsum("ij,ij->i", zx[i, begin:end], zy[j, begin:end])
                bound = partial + sx[i, end] * sy[j, end] if end < width else partial
                keep = bound >= threshold - _SLACK
                pairs, partial = (i[keep], j[keep]), partial[keep]
            begin = end
        i, j = pairs
        close = np.abs(partial - threshold) <= _SLACK
        if close.any():
            exact = np.einsum("ij,ij->i", x[i[close]], y[j[close]]) / (
                np.sqrt((x[i[close]] ** 2).sum(axis=1)) * np.sqrt((y[j[close]] ** 2).sum(axis=1)))
            partial[close] = np.where(np.isfinite(exact), exact, partial[close])
        linked = partial >= threshold
        return i[linked], j[linked]

    def forest(ids, i, j):
        import numpy as np

        least = np.arange(len(ids))
        while True:
            before = least.copy()
            low = np.minimum(least[i], least[j])
            np.minimum.at(least, i, low)
            np.minimum.at(least, j, low)
            least = least[least]
            if (least == before).all():
                break
        moved = np.nonzero(least != np.arange(len(ids)))[0]
        return ids[moved], ids[least[moved]]

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                width, same = row["width"], row["block"] == row["block_b"]
                x, y = (np.frombuffer(row[k]).reshape(-1, width) for k in ("vectors", "vectors_b"))
                ids, copies = (np.concatenate([np.array(row[k], np.int64), np.array(row[f"{k}_b"], np.int64)])
                               for k in ("ids", "copies"))
                i, j = tile(x, y, axes.value[width], same)
                if not len(i):
                    continue
                j = j if same else j + len(x)
                links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                a, b = forest(ids, i, j)
                some = np.nonzero(links)[0]
                yield pa.RecordBatch.from_pydict({
                    "a": np.concatenate([ids[some], a]),
                    "b": pa.array([None] * len(some) + b.tolist(), pa.int64()),
                    "links": np.concatenate([links[some], np.zeros(len(a))]).astype(np.int64)})

    return run


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id",
                    embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of the table.

    threshold lies above 0 and at most 1. n_links counts the other vectors of equal
    label with a cosine of at least the threshold, in double precision; component_id is
    the smallest vec_id reachable over links. A vector that is null, empty, zero or holds
    a null or non-finite number, a null label and a null vec_id link with nothing. Vectors
    of different lengths do not link. Repeated ids count as further vectors. Other
    columns are not read; an empty table gives an empty one.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    spark = rows.sparkSession
    table = rows.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
        F.col(embedding).cast(ArrayType(DoubleType())).alias("vector"))
    copy = ["label", "digest", "vector"]
    valid = table.filter(_usable()).withColumn("digest", F.xxhash64("vector"))
    merged = stage(
        valid.groupBy(*copy).agg(F.min("vec_id").alias("first"), F.count("*").alias("copies")), "vectors")
    axes = principal_axes(merged)
    shared = spark.sparkContext.broadcast(axes)

    leading = F.lit(0.0)
    for width, rotation in axes.items():
        axis = F.array(*[F.lit(float(x)) for x in rotation[:, 0]])
        dot = F.aggregate(F.zip_with("vector", axis, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
        leading = F.when(F.size("vector") == width, dot / norm).otherwise(leading)
    placed = merged.select(
        "label", F.size("vector").alias("width"), F.col("first").alias("vec_id"), "copies", "vector", leading.alias("leading"))
    order = ["label", "width", "leading", "vec_id"]
    blocks = stage(
        placed.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("label", "width", "vec_id", "copies", "vector", "leading").mapInArrow(_blocks, _BLOCK),
        "blocks",
    )
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-6
    meta = blocks.select("label", "width", "block", "low", "high")
    salt = F.pmod(F.col("block_b"), F.lit(_SALT))
    others = meta.select(*[F.col(c).alias(c if c in ("label", "width") else f"{c}_b") for c in meta.columns])
    tiles = (
        meta.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(_SALT)])))
        .join(others.withColumn("salt", salt), ["label", "width", "salt"])
        .filter((F.col("block") <= F.col("block_b")) & (F.col("low") - F.col("high_b") <= reach)
                & (F.col("low_b") - F.col("high") <= reach))
        .select("block", "block_b")
    )
    second = blocks.select(*[F.col(c).alias(f"{c}_b") for c in ("block", "ids", "copies", "vectors")])
    loaded = tiles.join(blocks.select("block", "width", "ids", "copies", "vectors"), "block").join(second, "block_b")
    found = stage(loaded.repartition("block", "block_b").select(
        "block", "block_b", "width", "ids", "copies", "vectors", "ids_b", "copies_b", "vectors_b"
    ).mapInArrow(_compare(shared, threshold), "a long, b long, links long"), "tiles")

    links = found.filter("b IS NULL").groupBy(F.col("a").alias("first")).agg(F.sum("links").alias("links"))
    reached = components(found.filter("b IS NOT NULL").select("a", "b"))
    classes = stage(
        merged.select(*copy, "first", "copies").join(links, "first", "left")
        .join(reached.withColumnRenamed("node", "first"), "first", "left")
        .select(*copy, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "first").alias("component_id")),
        "classes",
    )
    linked = valid.join(classes, copy).select("vec_id", "n_links", "component_id")
    alone = table.filter(~_usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
