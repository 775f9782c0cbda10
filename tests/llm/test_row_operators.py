import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpuswright.llm import chat, decontamination, packing, sharding, urls

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_url_rules(spark):
    rules = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/en/1"), urls.Rule("block", "a.b", ""),
             urls.Rule("allow", "a.b", ""), urls.Rule("block", "", "/secret"), urls.Rule("allow", "x.example.org", "/")]
    cases = {
        None: ("", "", None, "block"), "no scheme": ("", "", None, "block"),
        "http://EXAMPLE.org/en/123?q#f": ("example.org", "/en/123", "example.org/en/1", "block"),
        "http://sub.example.org/en/2": ("sub.example.org", "/en/2", "org/", "allow"),
        "http://example.org": ("example.org", "", None, "block"), "http://org/": ("org", "/", "org/", "allow"),
        "http://notexample.org/en/1": ("notexample.org", "/en/1", "org/", "allow"),
        "http://x.example.org/en/1": ("x.example.org", "/en/1", "example.org/en/1", "block"),
        "s://q.a.b?x://y": ("q.a.b", "", "a.b", "block"), "s://c.d/secrets": ("c.d", "/secrets", "/secret", "block"),
        "://c.d/x/secret": ("c.d", "/x/secret", None, "block"), "http://ÄB.org/#": ("Äb.org", "/", "org/", "allow"),
    }
    frame = spark.createDataFrame([(u, "old", "old") for u in cases], "url string, host string, verdict string")
    for size in (16_000_000, 8):
        urls.TRIE_CHARS = size
        got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(frame, rules, "block").collect()}
        assert got == cases
    urls.TRIE_CHARS = 16_000_000
    assert urls.judge(frame.limit(0), rules).collect() == []


def test_sharding_law(spark, edge_docs):
    leaves = sharding.topology(8)
    ids = spark.range(20_000).selectExpr("id AS doc_id", "'é' AS text")
    docs = ids.unionByName(edge_docs.select("doc_id", "text"))
    rows = sharding.shard(docs, leaves, sharding.with_shard(leaves)).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    assert all(abs(len(s) - len(rows) / 8) < 300 for s in slots.values())
    assert all(r.grown_shard in (r.shard, 8) for r in rows)
    assert abs(sum(r.grown_shard == 8 for r in rows) - len(rows) / 9) < 300
    texts = {r.doc_id: r.text for r in edge_docs.filter("doc_id < 11").collect()}
    for r in sharding.shard(edge_docs, leaves).filter("doc_id IS NOT NULL").collect():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), None)
    assert sharding.shard(edge_docs.limit(0), leaves).count() == 0


def test_sharding_weights_confine_movement(spark):
    leaves = [sharding.Leaf("r0", "k0", 0), sharding.Leaf("r0", "k1", 1, 2.0), sharding.Leaf("r1", "k2", 2), sharding.Leaf("r1", "k3", 3, 0.0)]
    heavier = [leaf if leaf.shard != 2 else sharding.Leaf("r1", "k2", 2, 3.0) for leaf in leaves]
    frame = spark.range(20_000).selectExpr("id AS doc_id", "CAST(NULL AS STRING) AS text")
    rows = sharding.shard(frame, leaves, heavier).collect()
    assert all(r.grown_shard in (r.shard, 2) and r.shard != 3 for r in rows)
    assert abs(sum(r.shard == 1 for r in rows) - 10_000) < 300
    with pytest.raises(ValueError):
        sharding.shard(frame, [sharding.Leaf("r", "k", 0, 0.0)])


def _shingles(text):
    words = "".join(c if c.isalnum() else " " for c in (text or "").lower()).split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_decontamination_matches_all_pairs(spark, sf, edge_docs, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", limit)
    extra = [(900, "wort"), (901, None), (902, "!!"), (None, "the cat sat on the mat it was"), (903, "x")]
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").union(
        spark.createDataFrame(extra, "item_id long, text string"))
    wanted = {r.item_id: _shingles(r.text) for r in items.collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(
        edge_docs.selectExpr("doc_id + 1000000", "text"))
    got = decontamination.decontaminate(docs, items).collect()
    texts = docs.collect()
    assert len(got) == len(texts)
    want = {}
    for r in texts:
        own = _shingles(r.text)
        hits = {i: len(s & own) / len(s) for i, s in wanted.items() if s and len(s & own) >= 0.8 * len(s) - 1e-9}
        if r.doc_id is not None:
            want[r.doc_id] = (not hits, sorted(hits, key=lambda i: (i is not None, i)), max(hits.values(), default=0.0))
    for r in got:
        if r.doc_id is not None:
            kept, ids, share = want[r.doc_id]
            assert (r.kept, r.containment) == (kept, share)
            assert r.item_ids == [i for i in ids if i is not None]
    assert sum(not k for k, *_ in want.values()) > 3
    assert decontamination.clean(docs, items).count() == sum(r.kept for r in got)
    assert decontamination.decontaminate(docs, items.limit(0)).filter("kept").count() == len(texts)
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0


def test_packing_round_trip(spark, sf, edge_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").union(
        edge_docs.selectExpr("doc_id + 1000000", "text").filter("doc_id IS NOT NULL AND doc_id <> 1"))
    rows = packing.pack_documents(docs, WORDS, keep_ids=True).collect()
    tokenizer = Tokenizer.from_file(WORDS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
    for doc in docs.dropDuplicates(["doc_id", "text"]).collect():
        pieces = sorted(by_doc[doc.doc_id], key=lambda r: r.piece)
        ids = [i for p in pieces for i in p.ids][: pieces[-1].start + pieces[-1].length]
        if doc.doc_id != 1000001:  # the row that comes twice
            assert ids == tokenizer.encode(doc.text or "", add_special_tokens=False).ids + [1]
            assert [p.start for p in pieces] == [4096 * i for i in range(len(pieces))]
            assert all(p.length == 4096 for p in pieces[:-1])
    for placed in by_sequence.values():
        placed.sort()
        assert placed[0][0] == 0 and sum(placed[-1]) <= 4096
        assert all(a + n == b for (a, n), (b, _) in zip(placed, placed[1:]))
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 4096) * 1.03 + 1
    assert packing.pack_documents(docs.limit(0), WORDS).count() == 0


def test_plan_is_best_fit_by_brute_force():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 60, 400).tolist() + [60] * 5 + [1] * 50
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [g for g in bins if g >= n]
        gap = min(fits) if fits else 60
        if fits:
            bins.remove(gap)
        bins.append(gap - n)
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs = packing.plan_runs(counts, 60)
    assert max(r.first_sequence + r.count for r in runs) == len(bins)
    assert {n: sum(r.count for r in runs if r.length == n) for n in counts} == counts
    with pytest.raises(ValueError):
        packing.plan_runs({61: 1}, 60)


def _conversation(turns):
    ordered = sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2] is not None, t[2] or "", t[3] is not None, t[3] or ""))
    pairs = [(role or "", text or "") for _, _, role, text in ordered]
    loss = "".join(text for role, text in pairs if role == "assistant")
    whole = "".join(f"{role}\n{text}\n" for role, text in pairs)
    return len(pairs), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


@pytest.mark.parametrize("tokenizer", [None, public_tokenizers.path("byte_bpe_50k.json")])
def test_chat_round_trip_and_tree(spark, sf, tokenizer):
    odd = [
        (-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "␛<|␛␛|<|im_end|>\n␛"), (-2, 0, None, None),
        (-2, 0, None, None), (-2, None, "sys\ntem␛n", "<|"), (None, 1, "assistant", "x"), (-3, 0, "user", "hi"), (-4, 0, "user", "hi"),
        (-4, 1, "assistant", "yo" * 300_000), (-5, 0, "user", "hi"), (-5, 1, "assistant", "no"), (-6, 0, "user", "hi"),
    ]
    table = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    turns = table.union(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")).selectExpr(
        "*", "'x' AS node", "1 AS position")
    nodes, paths = chat.format_conversations(turns, tokenizer)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(nodes, paths).collect()}
    by_conv = defaultdict(list)
    for r in turns.collect():
        by_conv[r.conv_id].append((r.conv_id, r.turn, r.role, r.text))
    assert got == {c: _conversation(t) for c, t in by_conv.items()}

    tree = {bytes(r.node): r for r in nodes.collect()}
    assert len(tree) == nodes.count() == paths.select("node").distinct().count()
    in_order = sorted(tree.values(), key=lambda r: r.offset)
    assert all(a.offset + a.units == b.offset for a, b in zip(in_order, in_order[1:])) and in_order[0].offset == 0
    for r in in_order:
        above, parent = [], r.parent
        while parent is not None:
            above.append(tree[bytes(parent)])
            parent = above[-1].parent
        assert r.position_id == sum(a.units for a in above)
        covered = sorted(x for i in r.ancestors for x in (i.begin, i.end))
        assert sum(i.end - i.begin for i in r.ancestors) == r.position_id and len(covered) == 2 * len(r.ancestors)
        assert all(any(i.begin <= a.offset and a.offset + a.units <= i.end for i in r.ancestors) for a in above)
    empty = chat.read_back(*chat.format_conversations(turns.limit(0), tokenizer))
    assert empty.count() == 0
