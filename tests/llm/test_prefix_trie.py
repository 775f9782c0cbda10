import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest

from corpuswright.llm import prefix_trie as pt

KIND = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _sequences(rows):
    """conv_id -> list of (role, text); rows in any order, turns without ties."""
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def _borrowed(own):
    def head(c):
        return crc32(str(c).encode()) % 4

    return {c: own.get(c - c % 20, [])[: head(c)] + turns[head(c):] for c, turns in own.items()}


def _brute(sequences):
    members = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    rows = []
    for node, ids in members.items():
        below = [n for n in members if n[: len(node)] == node]
        rows.append((
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
            sum(len(n) == len(node) + 1 for n in below),
            sum(not any(len(m) == len(n) + 1 and m[:-1] == n for m in members) for n in below),
            sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n),
            hashlib.sha256(",".join(str(c) for c in sorted(ids) if len(sequences[c]) == len(node)).encode()).hexdigest(),
        ))
    return sorted(rows, key=lambda r: (r[1], r[0]))


def _got(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=lambda r: (r[1], r[0]))


def _tree(frame):
    return pt.build_trie(pt.with_borrowed_heads(pt.digested(frame)))


def test_trie_matches_all_prefixes(spark):
    random.seed(11)
    rows = []
    trunk = [("user" if i % 2 == 0 else "assistant", f"word {i} " * (i % 4)) for i in range(45)]
    for c in random.sample(range(400), 90):
        shared = random.choice([0, 1, 3, 7, 19, 20, 33, 45])
        turns = trunk[:shared] + [(random.choice("ab"), random.choice(["x y", "z", ""])) for _ in range(random.randrange(5))]
        rows += [(c, i, role, text) for i, (role, text) in enumerate(turns)]
    rows += [(1000 + c, i, *trunk[i]) for c in range(30) for i in range(20)]  # copies, too
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, KIND).repartition(6)
    assert _got(_tree(frame)) == _brute(_borrowed(_sequences(rows)))


def test_long_conversations_cross_stretches(spark, monkeypatch):
    monkeypatch.setattr(pt, "_LONGEST", 8)
    trunk = [("user", f"t{i} a b") for i in range(70)]
    rows = [(c, i, *trunk[i]) for c, n in ((1, 70), (2, 70), (3, 50), (4, 51), (5, 16)) for i in range(n)]
    rows += [(6, i, *(trunk[i] if i < 61 else ("user", "other"))) for i in range(66)]
    found = pt.build_trie(pt.digested(spark.createDataFrame(rows, KIND)).selectExpr("*", "1 AS kind", "0 AS skipped"))
    assert _got(found) == _brute(_sequences(rows))


def test_edges(spark):
    rows = [(1, 0, "user", None), (1, None, None, "first"), (1, 1, "", " \t\n"), (21, 0, "user", "a"), (21, 0, "user", "a"),
            (43, 5, "user", "only"), (None, 0, "user", "lost"), (20, 3, "user", "lent"), (-7, 0, "user", "minus")]
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], KIND + ", key string, depth string, kind string")
    got = _got(_tree(frame))
    want = _sequences(rows)
    assert want[1][0] == ("", "first") and len(want[21]) == 2
    heads = {c: crc32(str(c).encode()) % 4 for c in want}
    rebuilt = {c: (want.get(c - c % 20 if c > 0 else 0, []) [: heads[c]] if c % 20 else want[c][: heads[c]]) + t[heads[c]:]
               for c, t in want.items()}
    assert got == _brute(rebuilt)
    assert any(not turns for turns in rebuilt.values())  # a turnless conversation ends at the root
    assert _tree(frame.limit(0)).count() == 0
    assert [r.depth for r in _tree(frame.filter("conv_id = 43")).collect()] == [0]


def test_given_table_in_sql(spark, sf):
    from checks.compare import difference, duck
    from corpuswright.llm.queries import ORACLE, QUERIES

    name = "op12_prefix_trie"
    assert difference(QUERIES[name](spark, sf).toPandas(), duck(sf).execute(ORACLE[name]).df()) is None


def test_texts_are_not_shuffled(spark, sf):
    turns = pt.with_borrowed_heads(pt.digested(spark.read.parquet(f"{sf}/conversations.parquet")))
    plan = turns.repartition("conv_id")._jdf.queryExecution().executedPlan().toString()
    assert not any("text#" in line for line in plan.splitlines() if "Exchange" in line)


@pytest.mark.parametrize("top", [1, 2, 4, 8, 4096, 8192, 12288])
def test_stretches_join(top):
    bounds = []
    for low, high in pt.stretches():
        bounds.append((low, high))
        if high >= top:
            break
    assert bounds[-1][1] == top and all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
