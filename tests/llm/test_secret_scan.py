import hashlib
import random
import re
import string

import pytest
import zstandard

from corpuswright.llm import secret_scan as ss
from corpuswright.llm.queries import QUERIES

ORDER = ("assign", "access", "hex", "novel")


def _base(text):
    """The three patterns as stated, short matches dropped afterwards."""
    keyword = "(" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in (
        "password", "passwd", "secret", "token", "api_?key")) + ")"
    found = []
    for m in re.finditer(keyword + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(found)


def _spans(found):
    return ",".join(f"{ORDER[k]}:{s}:{e}" for s, k, e in found)


def _random_text(rng):
    parts = ["password", "PassWd", "secret", "toKen", "token", "ſecret", "api_key", "APIKEY", "AKIA", "AKIAAKIA", '"', "'", " ", "  ",
             ":", "=", "key", "deadbeef" * 3, "0123456789abcdef" * 2, "ABC123", "x" * 20, "\n", "é\U0001F511", "abcde", "abcdef", "."]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(60)))


def test_base_findings_match_plain_patterns():
    rng = random.Random(5)
    for _ in range(4000):
        text = _random_text(rng)
        assert ss.base_findings(text) == _base(text), text


def _token(rng, n=40, letters=string.ascii_letters + string.digits):
    return "".join(rng.choice(letters) for _ in range(n))


def test_novelty_is_marginal_compressed_size():
    rng = random.Random(1)
    words = ("request_handler", "configuration_path", "session_manager_key")
    value, around = _token(rng), "the configuration_path of the session_manager_key is "
    content = "\n".join(reversed(words)).encode()
    plain = zstandard.ZstdCompressor(
        level=9, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
        write_content_size=False)
    want = len(plain.compress(f"{around}\n{value}".encode())) - len(plain.compress(around.encode()))
    assert ss.novelty(value, around, ss.compressor(words)) == want >= 20
    assert ss.novelty("session_manager_key", "it is", ss.compressor(words)) < 8
    assert ss.novelty(value, around, ss.compressor(())) >= 20  # no identifiers at all


def test_findings_of_both_kinds(spark):
    rng = random.Random(8)
    bearer, quiet, named = _token(rng), _token(rng), "session_manager_v2_key_settings"
    texts = [
        f"curl -H 'Authorization: Bearer {bearer}' now",
        f"the sum of it all is {quiet}, they say",  # no sensitive word
        f"private note\nbut on the next line {quiet}",
        *[f"private use of session_manager_ and _key_settings, run {i}" + f" private {named} " for i in range(3)],
        f"private {named}",
        f"two private copies {bearer} and {bearer} of one key",
        'api_key = "0123456789abcdef0123456789abcdef"',
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = ss.identifiers(docs)
    got = {r.doc_id: [(f.kind, texts[r.doc_id][f.start : f.end]) for f in r.findings] for r in ss.scan(docs, words).collect()}
    assert got[0] == [("novel", bearer)] and got[7] == [("novel", bearer)] * 2
    assert got[1] == got[2] == [] and [k for k, _ in got[8]] == ["assign", "hex"]
    assert "private" in words and not any(bearer[:9] in w for w in words)


def test_identifiers_count_documents(spark):
    texts = ["auth alpha beta k1a2b3c4d5e6f7g8h9 alpha", "auth alpha gamma k1a2b3c4d5e6f7g8h9", "alpha beta", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert ss.identifiers(docs) == ("alpha", "auth")
    assert ss.identifiers(docs, most=1) == ("alpha",)
    assert ss.identifiers(docs.limit(0)) == ()


def test_query_matches_plain_patterns(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_secrets"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        base = _base(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r.base_sha256 == hashlib.sha256(_spans(base).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("novel")] == [s for s in _spans(base).split(",") if s]


@pytest.mark.parametrize("empty", [False, True])
def test_edges(edge_docs, empty):
    docs = edge_docs.limit(0) if empty else edge_docs
    rows = ss.scan(docs, ss.identifiers(docs)).collect()
    assert len(rows) == (0 if empty else 13) and all(r.findings == [] for r in rows)


def test_very_long_text(spark):
    rng = random.Random(3)
    filler = "lorem ipsum dolor " * 200_000
    secret = _token(rng)
    text = filler + "password: hunter22 " + filler + "bearer " + secret
    [row] = ss.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), ()).collect()
    assert [(f.kind, text[f.start : f.end]) for f in row.findings] == [("assign", "password: hunter22"), ("novel", secret)]
    dense = "key " + "a1" * 3_000_000
    [row] = ss.scan(spark.createDataFrame([(1, dense)], "doc_id long, text string"), ()).collect()
    assert [f.kind for f in row.findings] == ["hex"]
