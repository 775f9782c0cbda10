import hashlib
import math
import random

import numpy as np
import pytest

from corpuswright.llm import bitplane_kmeans as bk


def _brute(vectors, k, rounds):
    """Assignments by plain integer arithmetic; vectors: (vec_id, components)."""
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in vectors]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest()))
    middles = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            away = [sum((a - b) ** 2 for a, b in zip(v, m)) for m in middles]
            out.append((away.index(min(away)), min(away)))
        return out

    for _ in range(rounds):
        chosen = [c for c, _ in assign()]
        for c in set(chosen):
            own = [v for (_, v), x in zip(kept, chosen) if x == c]
            middles[c] = [sum(column) // len(own) for column in zip(*own)]
    found = assign()
    per = {c: sum(d for x, d in found if x == c) for c, _ in found}
    return sorted((i, c, d, per[c], sum(per.values()), tuple(middles[c])) for (i, _), (c, d) in zip(kept, found))


def _got(frame):
    return sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in frame.collect())


def test_popcounts_are_exact_distances():
    rng = np.random.default_rng(3)
    for width in (1, 5, 27):
        numbers = rng.integers(-(1 << width), 1 << width, (50, 64))
        numbers[0], numbers[1] = -(1 << width), (1 << width) - 1
        packed = bk.pack(numbers.astype(float), bk.plane_count(numbers.min(), numbers.max()))
        want = ((numbers[:, None, :].astype(object) - numbers[None, :, :]) ** 2).sum(axis=2)
        assert (bk.distances(packed, packed).astype(object) == want).all()
        assert (bk.dots(packed, packed).astype(object) == numbers.astype(object) @ numbers.T.astype(object)).all()


@pytest.mark.parametrize("spread", [1.0, 300.0])
def test_clusters_match_plain_arithmetic(spark, spread):
    random.seed(2)
    centres = [[random.gauss(0, spread) for _ in range(64)] for _ in range(9)]
    vectors = [(i, [float(np.float32(x + random.gauss(0, spread / 3))) for x in random.choice(centres)]) for i in range(300)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(40)]  # copies
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(5)
    assert _got(bk.cluster_vectors(frame)) == _brute(vectors, 16, 3)
    assert _got(bk.cluster_vectors(frame, k=3, rounds=5)) == _brute(vectors, 3, 5)


def test_given_table_in_sql(spark, sf):
    from checks.compare import difference, duck
    from corpuswright.llm.queries import ORACLE, QUERIES

    name = "op13_bitplanes"
    assert difference(QUERIES[name](spark, sf).toPandas(), duck(sf).execute(ORACLE[name]).df()) is None


def test_unusable_rows_and_clashing_names(spark):
    good = [[random.Random(i).uniform(-1, 1) for _ in range(64)] for i in range(5)]
    rows = [(i, v, "x", "y") for i, v in enumerate(good)] + [(None, good[0], None, None), (None, good[0], None, None)]
    rows += [(0, good[0], "x", "y"), (90, None, "x", "y"), (91, [], "x", "y"), (92, good[0][:63], "x", "y"),
             (93, good[0] + [1.0], "x", "y"), (94, [None] + good[0][1:], "x", "y"),
             (95, [float("nan")] + good[0][1:], "x", "y"), (96, [float("-inf")] + good[0][1:], "x", "y")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string, planes string")
    found = bk.cluster_vectors(frame).collect()
    assert sorted(r.vec_id for r in found if r.vec_id is not None) == [0, 0, 1, 2, 3, 4]
    assert len(found) == 8 and all(r.distance == 0 for r in found)
    assert bk.cluster_vectors(frame.limit(0)).count() == 0
    assert bk.cluster_vectors(frame.filter("vec_id > 89")).schema == bk.cluster_vectors(frame).schema
    huge = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        bk.cluster_vectors(huge)
