"""Toxic documents by multiple-instance learning over their sentences.

Only documents are labelled. A sentence has a linear score over hashed words and word
beginnings; a document is toxic when any sentence is, so its probability is the noisy-or
of its sentences. Fitting the document labels through the noisy-or teaches the sentence
scores, which then locate the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from corpuswright.llm.sampling import sample_by_label
from corpuswright.sources.staging import stage

BITS = 18
SAMPLE_ROWS = 8000
# Text of the sample; what reaches the driver is about three times as much.
SAMPLE_BYTES = 64 << 20
# Words and their first bytes: endings vary, beginnings carry the stem.
_PREFIXES = (None, 4, 5, 6)
_ENDS = b".!?\n\r"


def _sentences(text: str | None) -> tuple[list, list]:
    """The words of a text piece by piece, as (features by word, sentence by word), and the sentences' bounds.

    Sentences are numbered over the whole text, so one that goes on in the next piece keeps
    its number. Bounds are the places of the end marks, with -1 before and the length behind.
    """
    import numpy as np

    from corpuswright.llm.hashing import Words, buckets, pieces

    ends_at = np.zeros(256, bool)
    ends_at[list(_ENDS)] = True
    raw = (text or "").lower().encode("utf-8", "replace")
    at, before, found, bounds = 0, 0, [], [np.array([-1])]
    for piece in pieces(raw):
        words = Words(piece)
        ends = np.nonzero(ends_at[words.codes])[0]
        if len(words):
            features = np.stack([buckets(words.hashes(k), i, BITS) for i, k in enumerate(_PREFIXES)])
            found.append((features, before + np.searchsorted(ends, words.starts)))
        bounds.append(at + ends)
        at, before = at + len(piece), before + len(ends)
    return found, np.concatenate([*bounds, [len(raw)]])


def _features(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found, _ = _sentences(text.as_py())
            words = np.concatenate([f for f, _ in found], axis=1) if found else np.zeros((len(_PREFIXES), 0), np.int64)
            sentences = np.unique(np.concatenate([s for _, s in found]), return_inverse=True)[1] if found else []
            yield pa.RecordBatch.from_pydict({
                "label": pa.array([label], pa.int32()), "words": pa.array([words.ravel()], pa.list_(pa.int32())),
                "sentences": pa.array([sentences], pa.list_(pa.int32()))})


def _train(docs: list, epochs: int = 20, rate: float = 0.3, penalty: float = 1e-5, size: int = 64, least: int = 4):
    """Weights and bias of the sentence score, by Adagrad on the noisy-or log loss.

    Weights stay at 0 or above, so that harmless words do not hide an offence beside them.
    Features in fewer than least of the sampled documents keep weight 0: they could only
    be learned by heart.
    """
    import numpy as np

    seen = np.zeros(1 << BITS, np.int64)
    for _, words, _ in docs:
        seen[np.unique(words)] += 1

    weights, squares = np.zeros(1 << BITS), np.full(1 << BITS, 1e-6)
    bias, bias_square = -5.0, 1e-6
    shuffled = np.random.default_rng(5)
    for _ in range(epochs):
        order = shuffled.permutation(len(docs))
        for begin in range(0, len(order), size):
            part = [docs[i] for i in order[begin : begin + size]]
            counts = [int(s.max()) + 1 if len(s) else 0 for _, _, s in part]
            offsets = np.concatenate([[0], np.cumsum(counts)])
            labels = np.array([label for label, _, _ in part], float)
            words = np.concatenate([w for _, w, _ in part], axis=1)
            sentence = np.concatenate([s + o for (_, _, s), o in zip(part, offsets)]).astype(np.int64)
            if not len(sentence):
                continue
            owner = np.repeat(np.arange(len(part)), counts)
            z = bias + np.bincount(sentence, weights[words].sum(axis=0), offsets[-1])
            p = 1 / (1 + np.exp(-np.maximum(z, -700)))
            # log(1 - P) of a document is minus the sum of softplus over its sentences.
            clean = np.bincount(owner, np.logaddexp(0, z), len(part))
            odds = np.exp(-clean) / np.maximum(-np.expm1(-clean), 1e-12)
            slope = np.where(labels == 1, -odds, 1.0)[owner] * p / len(part)
            touched, where = np.unique(words, return_inverse=True)
            g = np.bincount(where.ravel(), np.broadcast_to(slope[sentence], words.shape).ravel(), len(touched))
            g = np.where(seen[touched] >= least, g + penalty * weights[touched], 0.0)
            squares[touched] += g * g
            weights[touched] = np.maximum(weights[touched] - rate * g / np.sqrt(squares[touched]), 0)
            bias_square += slope.sum() ** 2
            bias -= rate * slope.sum() / np.sqrt(bias_square)
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", doc_id: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES):
    """(weights, bias) from the texts of about sample_rows documents whose label is 0 or 1.

    labels holds doc_id and label; of several labels of a document the highest counts.
    None when no document is labelled. A null text counts as empty. Of a doc_id on n rows
    each row is drawn with chance 1/n, and if the texts drawn so would hold more than
    sample_bytes, fewer rows are drawn.
    """
    import numpy as np

    known = labels.filter(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("doc_id")).agg(F.max(label).alias("label"))
    chosen = stage(sample_by_label(known, "label", "doc_id", sample_rows), "sample")
    # About sample_rows rows of two numbers.
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    copies = stage(texts.groupBy("doc_id").agg(
        F.count("*").alias("copies"), F.sum(F.octet_length("text")).alias("bytes")), "copies")
    size = copies.agg(F.sum(F.col("bytes") / F.col("copies"))).first()[0] or 0
    drawn = F.shiftrightunsigned(F.xxhash64("doc_id", F.monotonically_increasing_id()), 11) / F.lit(float(2**53))
    taken = texts.join(F.broadcast(copies.select("doc_id", "copies")), "doc_id").filter(
        drawn < F.lit(min(1.0, sample_bytes / max(size, 1))) / F.col("copies"))
    sample = taken.select("label", "text").mapInArrow(
        _features, "label int, words array<int>, sentences array<int>").toArrow()
    docs = [
        (label, words.values.to_numpy().reshape(len(_PREFIXES), -1), sentences.values.to_numpy())
        for label, words, sentences in zip(
            sample.column("label").to_pylist(), sample.column("words"), sample.column("sentences"))
    ]
    return _train(docs) if docs else None


def score(docs: DataFrame, model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Add score, predicted and offending; columns of these names are replaced.

    score is the noisy-or over all sentences of the whole text (an empty or null text
    0.0, as without a model). predicted is 1 from the threshold on. offending lists the
    sentences with a probability of at least the threshold as (start, length, score), in
    UTF-8 bytes of the lower-cased text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("score double, offending array<struct<start: long, length: long, score: double>>")
    def judge(texts):
        import numpy as np
        import pyarrow as pa

        scores, located = [], []
        for value in texts:
            clean, found = 0.0, []
            if shared.value is not None:
                weights, bias = shared.value
                pieces, bounds = _sentences(value.as_py())
                if pieces:
                    sums = np.concatenate([weights[features].sum(axis=0) for features, _ in pieces])
                    present, where = np.unique(np.concatenate([s for _, s in pieces]), return_inverse=True)
                    z = bias + np.bincount(where, sums)
                    clean = np.logaddexp(0, z).sum()
                    p = 1 / (1 + np.exp(-np.maximum(z, -700)))
                    starts, ends = bounds[present] + 1, bounds[present + 1]
                    found = [
                        {"start": starts[k], "length": ends[k] - starts[k], "score": p[k]}
                        for k in np.nonzero(p >= threshold)[0]
                    ]
            scores.append(float(-np.expm1(-clean)))
            located.append(found)
        spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())]))
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(located, spans)], ["score", "offending"])

    found = docs.withColumn("__toxicity", judge(F.col(text)))
    return found.withColumns({
        "score": F.col("__toxicity").getField("score"),
        "predicted": (F.col("__toxicity").getField("score") >= F.lit(threshold)).cast("int"),
        "offending": F.col("__toxicity").getField("offending"),
    }).drop("__toxicity")
