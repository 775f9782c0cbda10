"""Nothing that is read from a text depends on where long texts are cut; scores follow their formulas."""

import math
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from corpuswright.llm import hashing, language, packing, quality, toxicity
from corpuswright.llm.queries import tokenizer_file
from tests.conftest import SF

SIZES = (64, 1000, 5_003, 1 << 18, 1 << 22)


def _long_texts():
    line = " ".join(f"w{i % 977}" for i in range(60_000))
    return [
        "\n".join([line, line, line]), "\n".join(["ab", "ab", "ab", line * 2]), "x.y.z." * 60_000 + " end. next",
        "é" * 200_000 + " b " + "Straße.İΣ " * 30_000, "\n" * 300_000 + "a\n", "one two " * 40_000 + "hate. " + "a, b; " * 50_000, " ", "",
    ]


@pytest.mark.parametrize("text", _long_texts(), ids=range(8))
def test_cuts_change_nothing(text, monkeypatch):
    found = []
    for size in SIZES:
        monkeypatch.setattr(hashing, "PIECE", size)
        monkeypatch.setattr(language, "_PIECE", size)
        votes, features, values = quality._measure(text)
        pieces, bounds = toxicity._sentences(text)
        words = np.concatenate([f for f, _ in pieces], axis=1) if pieces else None
        sentences = np.concatenate([s for _, s in pieces]) if pieces else None
        found.append((votes, features, values, words, sentences, bounds, language._Grams.counts(text)))
    for other in found[1:]:
        assert other[0] == found[0][0]
        for a, b in zip(other[1:], found[0][1:]):
            assert (a is None and b is None) or np.array_equal(a, b)


def test_three_equal_long_lines_are_repeated():
    votes = dict(zip((name for name, *_ in quality.LABELLERS), quality._measure(_long_texts()[0], False)[0]))
    assert votes["repeated_lines"] == quality.BAD


def _hash(word: bytes) -> int:
    return sum(int(hashing._BYTE[b]) * pow(int(hashing._FACTOR), i, 1 << 64) for i, b in enumerate(word)) % (1 << 64)


def _bucket(value: int, kind: int, bits: int) -> int:
    mixed = (value ^ int(hashing._BYTE[kind])) * 0xFF51AFD7ED558CCD % (1 << 64)
    mixed ^= mixed >> 33
    return (mixed * 0xC4CEB9FE1A85EC53 % (1 << 64)) >> (64 - bits)


def test_toxicity_score_is_the_noisy_or(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").limit(25).collect()
    model = (np.abs(np.sin(np.arange(1 << toxicity.BITS))) * 0.3, -3.0)
    docs = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    for r in rows:
        clean = 1.0
        for sentence in re.split(rb"[.!?\n\r]", (r.text or "").lower().encode()):
            words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", sentence)
            if words:
                z = model[1] + sum(
                    model[0][_bucket(_hash(w[:k]), i, toxicity.BITS)] for w in words for i, k in enumerate(toxicity._PREFIXES))
                clean *= 1 - 1 / (1 + math.exp(-z))
        assert got[r.doc_id] == pytest.approx(1 - clean, abs=1e-9)


def test_language_score_is_the_softmax_of_tfidf_ngrams(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs)
    got = {r.doc_id: r for r in language.identify(docs.limit(20), model).collect()}
    for r in docs.limit(20).collect():
        codes, grams = [], {}
        for c in (r.text or "").lower():
            if c.isalpha() or not codes or codes[-1] != " ":
                codes.append(c if c.isalpha() else " ")
        if not any(c != " " for c in codes):
            assert got[r.doc_id].lang_pred == language.UNKNOWN
            continue
        points = [ord(c) for c in codes]
        factors = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)
        for n in (1, 2, 3):
            for i in range(len(points) - n + 1):
                v = sum(p * f for p, f in zip(points[i : i + n], factors)) % (1 << 32)
                v ^= v >> 15
                number = (v * 0x2C1B3C6D % (1 << 32)) >> (32 - language.BITS)
                grams[number] = grams.get(number, 0) + 1
        weights = {g: (1 + math.log(c)) * model.idf[g] for g, c in grams.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        logits = np.array(model.bias, float) + sum(w / norm * model.weights[g] for g, w in weights.items())
        p = np.exp(logits / model.temperature - (logits / model.temperature).max())
        p /= p.sum()
        assert got[r.doc_id].lang_pred == model.labels[int(p.argmax())]
        assert got[r.doc_id].score == pytest.approx(p.max(), abs=1e-6)


def test_quality_votes_follow_their_definitions(spark):
    for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect():
        raw = (r.text or "").encode()
        words = [w for w in re.split(rb"[\t\n\x0b\x0c\r ]+", raw) if w]
        if not words:
            continue
        votes = dict(zip((name for name, *_ in quality.LABELLERS), quality._measure(r.text, False)[0]))
        lines = [line for line in raw.split(b"\n") if line.strip()]
        pairs = list(zip(words, words[1:]))
        shares = {
            "repeated_lines": 1 - len(set(lines)) / len(lines), "digits": sum(48 <= b <= 57 for b in raw) / len(raw),
            "stutter": sum(a == b for a, b in pairs) / len(words),
            "unpunctuated": 1 - sum(w[-1:] in (b".", b"!", b"?") for w in words) / len(words),
            "repeated_pairs": (len(pairs) - len(set(pairs))) / len(words),
        }
        limits = {name: (bad, good) for name, bad, good in quality.LABELLERS}
        for name, share in shares.items():
            bad, good = limits[name]
            want = quality.BAD if share >= bad else quality.GOOD if good is not None and share <= good else quality.NONE
            assert votes[name] == want, (r.doc_id, name)


def _thue_morse(n, a="a", b="b"):
    word, other = a, b
    while len(word) < n:
        word, other = word + other, other + word
    return word, other


@pytest.mark.parametrize("n", [1024, 2048])
def test_colliding_words_keep_their_own_ids(n):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    word, other = _thue_morse(n)
    assert hashing.Words(word.encode(), True).hashes()[0] == hashing.Words(other.encode(), True).hashes()[0]
    encoder = packing.Encoder(path)
    for texts in ([f"{word} {other}"], [word], [other], [f"plain {word}", "words", other]):
        ids, counts = encoder([t.encode() for t in texts])
        want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want
        assert [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]


def test_stages_keep_the_users_columns(spark):
    from pyspark.sql import functions as F

    names = ("score", "predicted", "lang_pred", "offending", "__row", "__text", "__0", "__id", "__key", "__toxicity", "fingerprint")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(
        "*", *[F.concat(F.lit(n + ":"), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, docs, SF)
        assert kept.columns == docs.columns, name
        rows = kept.collect()
        assert rows and all(r[n] == f"{n}:{r.doc_id}" for r in rows for n in names), name
