import random

import numpy as np
import pytest
import xxhash

from corpuswright.llm import components, embedding_dedup, simhash


def _classes(ids, linked):
    """Smallest reachable id by repeated relaxation over all pairs."""
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and least[b] < least[a]:
                    least[a], changed = least[b], True
    return least


def _fingerprint(text):
    words = (text or "").encode()
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in words)
    for blank in b"\t\n\x0b\x0c\r":
        words = words.replace(bytes([blank]), b" ")
    words = [w for w in words.split(b" ") if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_match_relaxation(spark):
    random.seed(4)
    edges = [(random.randrange(60), random.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)]
    frame = spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.components(frame).collect()}
    ids = sorted({x for e in edges if e[0] != e[1] for x in e})
    pairs = {frozenset(e) for e in edges}
    assert got == _classes(ids, lambda a, b: frozenset((a, b)) in pairs)


def test_simhash_matches_all_pairs(spark, sf, edge_docs):
    table = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = table.unionByName(edge_docs.filter("doc_id IS NOT NULL").selectExpr("doc_id + 100000 AS doc_id", "text"))
    prints = {r.doc_id: _fingerprint(r.text) for r in docs.collect()}
    classes = _classes(sorted(prints), lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 2)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    assert all((r.fingerprint & (1 << 64) - 1, r.component_id) == (prints[r.doc_id], classes[r.doc_id]) for r in got)


def test_simhash_crowded_lists_lose_no_link(spark, monkeypatch):
    random.seed(9)
    base = random.getrandbits(63)
    prints = {base ^ (1 << random.randrange(63)) ^ (1 << random.randrange(63)) for _ in range(120)}
    prints |= {random.getrandbits(63) for _ in range(50)} | {base}
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    want = _classes(sorted(prints), lambda a, b: bin(a ^ b).count("1") <= 2)
    for longest in (64, 2, 10_000):
        monkeypatch.setattr(simhash, "_PAIRED_LIST", longest)
        found = components.components(simhash.links(frame))
        got = {p: p for p in prints} | {r.node: r.component for r in found.collect()}
        assert got == want


def test_simhash_edges(edge_docs):
    rows = simhash.near_duplicates(edge_docs).collect()
    assert len(rows) == 13
    zero = {r.doc_id: r.component_id for r in rows if r.fingerprint == 0}
    assert set(zero) == {2, 3, 4, None} and set(zero.values()) == {2}
    assert simhash.near_duplicates(edge_docs.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [0.93, 1.0])
def test_embeddings_match_all_pairs(spark, threshold):
    random.seed(1)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + rng.normal(size=16) * 0.25).tolist(), i % 2) for i in range(150)]
    rows += [(200 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(30)]
    rows += [(300, None, 1), (301, [0.0] * 16, 1), (302, [float("nan")] * 16, 1), (303, [None] * 16, 1), (304, rows[0][1], None),
             (305, [1.0, 2.0], 1), (306, [2.0, 4.0], 1), (307, [], 1), (308, [float("inf")] + [1.0] * 15, 1),
             (309, [x * 1e150 for x in rows[1][1]], rows[1][2])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, links string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame, threshold).collect()}

    def usable(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    good = {i: (np.array(v) / max(map(abs, v)), label) for i, v, label in rows if usable(v, label)}

    def linked(a, b):
        if a == b or a not in good or b not in good or good[a][1] != good[b][1] or len(good[a][0]) != len(good[b][0]):
            return False
        x, y = good[a][0], good[b][0]
        return x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold - (1e-12 if threshold == 1 else 0)

    ids = sorted(r[0] for r in rows)
    least = _classes(ids, linked)
    if threshold < 1:
        assert got == {i: (sum(linked(i, j) for j in ids), least[i], least[i] == i) for i in ids}
    else:
        assert all(got[200 + i][1] == i % 3 for i in range(30))


def test_embeddings_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.near_duplicates(frame).collect() == []
