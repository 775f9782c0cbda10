"""Language identification by multinomial logistic regression on character n-grams.

Features are hashed 1- to 3-grams of the lower-cased text with everything but letters as
one blank, weighted by TF-IDF and scaled to length one. Document frequencies count all
documents to learn from. The weights come from follow-the-regularised-leader steps with
elastic-net penalties, which leave most of them zero, on a bounded sample; one further
temperature on held-back rows of the sample makes the scores probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from corpuswright.llm.sampling import sample_by_label

UNKNOWN = "und"
BITS = 14
SAMPLE_ROWS = 3000
_PIECE = 1 << 18


class _Grams:
    """Counts of hashed n-grams; holds the letter table of a worker."""

    table = None

    @classmethod
    def counts(cls, text: str | None):
        """Counts by feature number, None for a text without a letter."""
        import numpy as np

        if cls.table is None:
            cls.table = np.array([chr(c).isalpha() for c in range(0x110000)])
        # The last two characters go before the next piece, so that each n-gram counts once.
        lowered = (text or "").lower()
        total, tail, after_letter, some = None, np.zeros(0, np.uint32), True, False
        for at in range(0, len(lowered), _PIECE):
            codes = np.frombuffer(lowered[at : at + _PIECE].encode("utf-32-le", "surrogatepass"), np.uint32)
            letters = cls.table[codes]
            some = some or letters.any()
            codes = np.where(letters, codes, np.uint32(32))
            kept = letters | np.concatenate([[after_letter], letters[:-1]])  # runs of blanks become one
            after_letter, fresh = letters[-1], kept.sum()
            codes = np.concatenate([tail, codes[kept]])
            tail = codes[-2:]
            if not fresh:
                continue
            a = codes * np.uint32(0x9E3779B1)
            b = codes * np.uint32(0x85EBCA77)
            c = codes * np.uint32(0xC2B2AE3D)
            grams = np.concatenate([a[-fresh:], (a[:-1] + b[1:])[-fresh:], (a[:-2] + b[1:-1] + c[2:])[-fresh:]])
            grams ^= grams >> np.uint32(15)
            numbers = (grams * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - BITS)
            found = np.bincount(numbers, minlength=1 << BITS)
            total = found if total is None else total + found
        return total if some else None


def _document_frequencies(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    total, n = np.zeros(1 << BITS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            counts = _Grams.counts(text.as_py())
            if counts is not None:
                total += counts > 0
                n += 1
    if n:
        some = np.nonzero(total)[0]
        yield pa.RecordBatch.from_pydict({"feature": np.append(some, -1), "n": np.append(total[some], n)})


def _vector(counts, idf):
    import numpy as np

    features = np.nonzero(counts)[0]
    values = (1 + np.log(counts[features])) * idf[features]
    return features, values / max(np.sqrt(values @ values), 1e-12)


@dataclass(frozen=True)
class LanguageModel:
    """labels, idf by feature, weights (features x labels), bias and temperature."""

    labels: list
    idf: object
    weights: object
    bias: object
    temperature: float

    def probabilities(self, features, values):
        return _softmax((values @ self.weights[features] + self.bias) / self.temperature)


def _softmax(z):
    import numpy as np

    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _ftrl(rows, classes, alpha=0.5, beta=1.0, l1=0.02, l2=0.02, epochs=4):
    """Weights and bias after per-coordinate steps over rows of (features, values, class)."""
    import numpy as np

    z, n = np.zeros(((1 << BITS) + 1, classes)), np.zeros(((1 << BITS) + 1, classes))

    def weights(at):
        free = np.abs(z[at]) > l1
        return np.where(free, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2), 0.0)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            features, values, label = rows[r]
            at, x = np.append(features, 1 << BITS), np.append(values, 1.0)
            w = weights(at)
            error = _softmax(x @ w)
            error[label] -= 1
            g = x[:, None] * error[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(slice(None))
    return w[:-1], w[-1]


def _temperature(logits, labels) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""
    import numpy as np

    if not len(labels):
        return 1.0

    def loss(log_t):
        p = _softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = -5.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """A model from the rows whose text has a letter and whose lang is not null.

    Document frequencies count every such row; the weights and the temperature use about
    sample_rows of them. None when there is no row to learn from.
    """
    import numpy as np

    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).alias("doc_id")).filter(
        F.col("lang").isNotNull())
    counted = known.select("text").mapInArrow(_document_frequencies, "feature long, n long")
    df = dict(counted.groupBy("feature").agg(F.sum("n")).collect())
    if not df:
        return None
    n = df.pop(-1)
    idf = np.full(1 << BITS, np.log(1.0 + n))
    idf[list(df)] = np.log((1 + n) / (1 + np.array(list(df.values())))) + 1

    def sparse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = _Grams.counts(text.as_py())
                if counts is not None:
                    features = np.nonzero(counts)[0]
                    yield pa.RecordBatch.from_pydict({
                        "lang": [lang], "features": pa.array([features], pa.list_(pa.int32())),
                        "counts": pa.array([counts[features]], pa.list_(pa.int32()))})

    sample = sample_by_label(known, "lang", "doc_id", sample_rows).select("lang", "text").mapInArrow(
        sparse, "lang string, features array<int>, counts array<int>").toArrow()
    langs = sample.column("lang").to_pylist()
    if not langs:
        return None
    labels = sorted(set(langs))
    vectors = []
    for features, counts, label in zip(sample.column("features"), sample.column("counts"), langs):
        features, counts = features.values.to_numpy(), counts.values.to_numpy()
        values = (1 + np.log(counts)) * idf[features]
        vectors.append((features, values / np.sqrt(values @ values), labels.index(label)))
    order = np.random.default_rng(11).permutation(len(vectors))
    back = [vectors[i] for i in order[: len(vectors) // 5]]
    weights, bias = _ftrl([vectors[i] for i in order[len(vectors) // 5 :]], len(labels))
    logits = np.array([v @ weights[f] + bias for f, v, _ in back]).reshape(len(back), len(labels))
    return LanguageModel(labels, idf, weights, bias, _temperature(logits, np.array([c for *_, c in back], int)))


def identify(docs: DataFrame, model: LanguageModel | None, text: str = "text") -> DataFrame:
    """Add lang_pred and score; columns of these names are replaced.

    Every row is scored from its whole text alone. A null text, one without a letter and
    any text without a model get "und" with score 0.0.
    """
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts):
        import pyarrow as pa

        names, scores = [], []
        for value in texts:
            counts = _Grams.counts(value.as_py()) if shared.value is not None else None
            if counts is None:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            p = shared.value.probabilities(*_vector(counts, shared.value.idf))
            best = int(np.argmax(p))
            names.append(shared.value.labels[best])
            scores.append(float(p[best]))
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    found = docs.withColumn("__language", predict(F.col(text)))
    return found.withColumns({c: F.col("__language").getField(c) for c in ("lang_pred", "score")}).drop("__language")
