"""Exact k-means over integer vectors packed into bit planes.

A vector of 64 components is turned into integers and packed as one 64-bit word per bit
plane: bit i of plane p is bit p of component i, in two's complement, so the last plane
has a negative weight. The dot product of two vectors is then the sum over pairs of
planes of both planes' weights times the number of bits they share, one AND and one
popcount each, and squared distances follow without rounding. Component sums of a
cluster are bit counts per plane, weighted in the same way. The planes are written once;
every round reads them, sends one row per task and cluster through the shuffle, and
brings k rows to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F

from corpuswright.sources.staging import stage

WIDTH = 64
# Components of 28 bits keep every squared distance below 2^63.
_MOST_PLANES = 28
_BATCH = 2048


def _kept(vector: Column) -> Column:
    """Whether a vector has exactly 64 components, none null or non-finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(math.inf)))
    return F.coalesce((F.size(vector) == WIDTH) & finite, F.lit(False))


def _integers(vectors, scale: float):
    """floor(scale * component) of an Arrow list column without nulls, as an n x 64 array."""
    import numpy as np

    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * scale).reshape(len(vectors), WIDTH)


def _range_of(scale: float):
    def measure(batches: Iterator) -> Iterator:
        import pyarrow as pa

        low, high = math.inf, -math.inf
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                numbers = _integers(batch.column(0).slice(at, _BATCH), scale)
                low, high = min(low, float(numbers.min())), max(high, float(numbers.max()))
        if low <= high:
            yield pa.RecordBatch.from_pydict({"low": [low], "high": [high]})

    return measure


def plane_count(low: float, high: float) -> int:
    """Bits of the two's complement that holds all integers from low to high."""
    most = max(high, -low - 1, 0)
    if most >= 2.0 ** (_MOST_PLANES - 1):
        raise ValueError(f"components from {low} to {high}: squared distances would leave a long")
    return int(most).bit_length() + 1


def pack(numbers, planes: int):
    """n x planes words of 64 bits from an n x 64 array of integers."""
    import numpy as np

    whole = numbers.astype(np.int64)
    packed = np.empty((len(whole), planes), np.uint64)
    for p in range(planes):
        bits = (whole >> p & 1).astype(np.uint8)
        packed[:, p] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return packed


def unpack_bits(packed):
    """n x planes x 64 array of bits."""
    import numpy as np

    octets = packed.astype("<u8").view(np.uint8).reshape(*packed.shape, 8)
    return np.unpackbits(octets, axis=2, bitorder="little")


def plane_weights(planes: int):
    import numpy as np

    weights = 1 << np.arange(planes, dtype=np.int64)
    weights[-1] = -weights[-1]
    return weights


def dots(left, right):
    """n x m exact dot products of packed vectors: weighted popcounts of shared bits."""
    import numpy as np

    weights = plane_weights(left.shape[1])
    found = np.zeros((len(left), len(right)), np.int64)
    for p, weight in enumerate(weights):
        shared = np.bitwise_count(left[:, p, None, None] & right[None, :, :])
        found += weight * (shared.astype(np.int64) @ weights)
    return found


def distances(left, right):
    """n x m exact squared Euclidean distances of packed vectors."""
    import numpy as np

    weights = plane_weights(left.shape[1])
    norms = [np.einsum("npq,p,q->n", np.bitwise_count(x[:, :, None] & x[:, None, :]).astype(np.int64), weights, weights)
             for x in (left, right)]
    return norms[0][:, None] + norms[1][None, :] - 2 * dots(left, right)


def _words(column, planes: int):
    import numpy as np

    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64).reshape(-1, planes)


def _packing(scale: float, planes: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                packed = pack(_integers(part.column(1), scale), planes).view(np.int64)
                offsets = pa.array(np.arange(len(packed) + 1, dtype=np.int32) * planes)
                lists = pa.ListArray.from_arrays(offsets, pa.array(packed.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["vec_id", "planes"])

    return run


def _nearest(batches: Iterator, centroids: list[list[int]], planes: int) -> Iterator:
    """(part, packed vectors, cluster, distance) of bounded parts of the rows."""
    import numpy as np

    middles = pack(np.array(centroids, np.int64), planes)
    for batch in batches:
        for at in range(0, batch.num_rows, _BATCH):
            part = batch.slice(at, _BATCH)
            packed = _words(part.column(1), planes)
            away = distances(packed, middles)
            cluster = away.argmin(axis=1)  # the first of equal ones
            yield part, packed, cluster, away[np.arange(len(away)), cluster]


def _sums(centroids: list[list[int]], planes: int):
    """Size and bits of every plane and component, summed by cluster over a task."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        k = len(centroids)
        counts, bits = np.zeros(k, np.int64), np.zeros((k, planes * WIDTH))
        for _, packed, cluster, _ in _nearest(batches, centroids, planes):
            chosen = (cluster[None, :] == np.arange(k)[:, None]).astype(np.float64)
            counts += chosen.sum(axis=1).astype(np.int64)
            bits += chosen @ unpack_bits(packed).reshape(len(packed), -1)
        weighted = np.einsum("kpi,p->ki", bits.astype(np.int64).reshape(k, planes, WIDTH), plane_weights(planes))
        some = np.nonzero(counts)[0]
        if len(some):
            yield pa.RecordBatch.from_pydict({
                "cluster": pa.array(some, pa.int32()), "size": pa.array(counts[some], pa.int64()),
                "total": pa.array(weighted[some].tolist(), pa.list_(pa.int64()))})

    return run


def _assignment(centroids: list[list[int]], planes: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for part, _, cluster, distance in _nearest(batches, centroids, planes):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                ["vec_id", "cluster", "distance"])

    return run


def _first_centroids(packed: DataFrame, k: int, seed: int, planes: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of 'seed:vec_id'; equal ids go by their planes."""
    import numpy as np

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = packed.select("planes", digest.alias("digest")).orderBy("digest", "planes").limit(k).collect()
    words = np.array([r["planes"] for r in chosen], np.int64).reshape(len(chosen), planes).view(np.uint64)
    return np.einsum("kpi,p->ki", unpack_bits(words).astype(np.int64), plane_weights(planes)).tolist()


def _moved(packed: DataFrame, centroids: list[list[int]], planes: int) -> list[list[int]]:
    """Centroids after one round: the floor of the mean, or unchanged without a vector."""
    parts = packed.mapInArrow(_sums(centroids, planes), "cluster int, size long, total array<long>")
    cells = parts.select("cluster", "size", F.posexplode("total").alias("at", "value")).groupBy("cluster", "at").agg(
        F.sum("size").alias("size"), F.sum("value").alias("value"))
    moved = [list(c) for c in centroids]
    for cell in cells.collect():  # k x 64 rows
        moved[cell["cluster"]][cell["at"]] = cell["value"] // cell["size"]
    return moved


def cluster_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 16, rounds: int = 3, scale: float = 64.0,
    seed: int = 1,
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every kept vector.

    Kept are vectors of exactly 64 components, none null or non-finite; others have no
    row. Components become floor(scale * x). The first centroids are the k kept vectors
    (all, if fewer) with the smallest sha256 of "seed:key", a null key counting as the
    empty text. Rows that repeat a key, and null keys, are clustered one by one; an empty
    table gives an empty result. Components of more than 28 bits raise, as distances
    would not fit a long. Other columns are not read.
    """
    taken = rows.select(F.col(key).alias("vec_id"), F.col(vector).alias("vector")).filter(_kept(F.col("vector")))
    edges = taken.select("vector").mapInArrow(_range_of(scale), "low double, high double").agg(
        F.min("low").alias("low"), F.max("high").alias("high")).first()
    kind = rows.schema[key].dataType.simpleString()
    if edges["low"] is None:
        shape = f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        return rows.sparkSession.createDataFrame([], shape)
    planes = plane_count(edges["low"], edges["high"])
    packed = stage(taken.mapInArrow(_packing(scale, planes), f"vec_id {kind}, planes array<long>"), "planes")
    centroids = _first_centroids(packed, k, seed, planes)
    for _ in range(rounds):
        centroids = _moved(packed, centroids, planes)
    found = stage(
        packed.mapInArrow(_assignment(centroids, planes), f"vec_id {kind}, cluster int, distance long"), "assigned")
    summed = {r["cluster"]: r["sum"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("sum")).collect()}
    described = rows.sparkSession.createDataFrame(
        [(c, n, sum(summed.values()), centroids[c]) for c, n in summed.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    # One row per cluster, at most k.
    return found.join(F.broadcast(described), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")
