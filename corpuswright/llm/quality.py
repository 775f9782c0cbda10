"""Text quality without labels: heuristic labellers, a label model, a hashed scorer.

Several overlapping heuristics vote good, bad or nothing on each document. Expectation
maximisation over the vote patterns of all documents estimates how accurate each
labeller is and gives each pattern its posterior probability of good. These posteriors
train a logistic scorer over hashed words and word shapes, which then scores every text,
also where the labellers abstain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

from pyspark.sql import DataFrame, functions as F

BITS = 15
SAMPLE_ROWS = 6000
GOOD, BAD, NONE = 1, 0, -1
# Name, share from which a text is bad, share up to which it is good (None: never said).
LABELLERS = (
    ("capitals", 0.30, None),
    ("symbols", 0.03, None),
    ("separators", 0.05, None),
    ("one_mark", 0.25, None),
    ("stutter", 0.05, None),
    ("repeated_lines", 0.45, None),
    ("digits", 0.25, None),
    ("repeated_pairs", 0.30, 0.12),
    ("odd_shapes", 0.35, 0.15),
    ("unpunctuated", 0.995, 0.98),
)


def _shapes():
    """Kind of each byte value: digit, capital, small letter, beyond ASCII, or itself."""
    import numpy as np

    table = np.arange(256, dtype=np.uint8)
    table[48:58], table[65:91], table[97:123], table[128:] = ord("0"), ord("A"), ord("a"), ord("u")
    return table


@lru_cache(1)
def _tables():
    import numpy as np

    odd = np.zeros(256, bool)
    odd[list(b"#$%&*+<=>@\\^_`{|}~!")] = True
    plain = np.zeros(256, bool)
    plain[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), ord(","), ord(".")]] = True
    return _shapes(), odd, plain


def _measure(text: str | None, scored: bool = True):
    """(votes, feature numbers, values) of a whole text; sums over pieces of bounded length.

    Pieces hold whole words; word pairs, marks and the last word are carried from piece to
    piece, and lines are read by themselves, so nothing depends on where the pieces lie.
    """
    from io import BytesIO

    import numpy as np

    from corpuswright.llm.hashing import Words, buckets, pieces

    shapes, odd, plain = _tables()
    sums, n_words, n_lines = np.zeros(8), 0, 0
    all_marks, all_pairs, before = np.zeros(256, np.int64), [], np.zeros(0, np.uint64)
    lines: set[int] = set()
    counts, sums_end = None, 0
    raw = (text or "").encode("utf-8", "replace")
    for line in BytesIO(raw):
        if line.strip():
            lines.add(crc32(line.removesuffix(b"\n")))
            n_lines += 1
    for piece in pieces(raw):
        words = Words(piece, blanks_only=True)
        n = len(words)
        if not n:
            continue
        codes = words.codes
        kinds = np.bincount(shapes[codes], minlength=256)
        upper, letters = kinds[ord("A")], kinds[ord("A")] + kinds[ord("a")] + kinds[ord("u")] / 2
        hashes, last = words.hashes(), codes[words.ends - 1]
        marks = np.bincount(last, minlength=256)
        chain = np.concatenate([before, hashes])
        before = hashes[-1:]
        same = chain[1:] == chain[:-1]
        all_pairs.append(chain[1:] * np.uint64(3) + chain[:-1])
        all_marks += marks
        single = (words.ends - words.starts == 1) & odd[last]
        # Capitals after the first letter, or an end that prose does not have.
        second = codes[np.minimum(words.starts + 1, words.ends - 1)]
        strange = ~plain[last] | ((second >= 65) & (second <= 90))
        sums += [upper, letters, kinds[odd].sum(), len(codes), single.sum(), same.sum(), kinds[ord("0")],
                 strange.sum()]
        n_words += n
        sums_end += marks[[ord("."), ord("!"), ord("?")]].sum()
        if scored:
            shaped = Words.__new__(Words)
            shaped.codes, shaped.starts, shaped.ends, shaped._sums = shapes[codes], words.starts, words.ends, None
            found = np.bincount(np.concatenate([
                buckets(hashes, 0, BITS), buckets(shaped.hashes(4), 1, BITS), buckets(last.astype(np.uint64), 2, BITS),
                buckets(same.astype(np.uint64), 3, BITS),
            ]), minlength=1 << BITS)
            counts = found if counts is None else counts + found
    if not n_words:
        return [NONE] * len(LABELLERS), np.zeros(0, np.int64), np.zeros(0)
    upper, letters, symbols, size, single, stutter, digits, strange = sums
    pairs = np.concatenate(all_pairs)
    mark, pairs = np.where(plain, 0, all_marks).max(), len(pairs) - len(np.unique(pairs))
    shares = {
        "capitals": upper / max(letters, 1), "symbols": symbols / size, "separators": single / n_words,
        "one_mark": mark / n_words, "stutter": stutter / n_words, "repeated_lines": 1 - len(lines) / n_lines,
        "digits": digits / size, "repeated_pairs": pairs / n_words, "odd_shapes": strange / n_words,
        "unpunctuated": 1 - sums_end / n_words,
    }
    votes = [
        BAD if shares[k] >= bad else GOOD if good is not None and shares[k] <= good else NONE for k, bad, good in LABELLERS
    ]
    if counts is None:
        return votes, np.zeros(0, np.int64), np.zeros(0)
    features = np.nonzero(counts)[0]
    values = np.sqrt(counts[features] / n_words)
    return votes, features, values / np.sqrt(values @ values)


def _code(votes) -> int:
    """A vote pattern as one number, base three."""
    code = 0
    for vote in votes:
        code = code * 3 + vote + 1
    return code


def _votes(code: int) -> list[int]:
    votes = []
    for _ in LABELLERS:
        code, vote = divmod(code, 3)
        votes.append(vote - 1)
    return votes[::-1]


@dataclass(frozen=True)
class LabelModel:
    """Share of good documents; chances of (bad, good, no) votes per labeller, given good and given bad."""

    prior: float
    given_good: object
    given_bad: object

    def posterior(self, votes) -> float:
        import numpy as np

        # NONE is -1, the last column.
        odds = np.log(self.prior / (1 - self.prior)) + sum(
            np.log(self.given_good[k][vote] / self.given_bad[k][vote]) for k, vote in enumerate(votes))
        return float(1 / (1 + np.exp(-odds)))


# Where estimation starts, and what smoothing returns to: bad votes are rare on good texts.
_GIVEN_GOOD, _GIVEN_BAD = (0.05, 0.60, 0.35), (0.35, 0.30, 0.35)


def estimate(patterns: dict[int, int], rounds: int = 100, smoothing: float = 10.0) -> LabelModel:
    """Expectation maximisation over the counts of vote patterns.

    There are at most 3^labellers patterns, whatever the corpus. The start says which of
    the two classes is called good.
    """
    import numpy as np

    votes = np.array([_votes(code) for code in patterns])
    n = np.array(list(patterns.values()), float)
    k = np.arange(len(LABELLERS))
    prior, good, bad = 0.85, np.tile(_GIVEN_GOOD, (len(k), 1)), np.tile(_GIVEN_BAD, (len(k), 1))
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior)) + np.log(good[k, votes] / bad[k, votes]).sum(axis=1)
        p = 1 / (1 + np.exp(-odds))
        prior = float(np.clip(n @ p / n.sum(), 0.01, 0.99))
        tables = []
        for start, weight in ((_GIVEN_GOOD, n * p), (_GIVEN_BAD, n * (1 - p))):
            tally = np.stack([weight @ (votes == v) for v in (BAD, GOOD, NONE)], axis=1)
            tables.append((tally + smoothing * np.array(start)) / (weight.sum() + smoothing))
        good, bad = tables
    return LabelModel(prior, good, bad)


def _train(rows: list, epochs: int = 8, rate: float = 0.5, penalty: float = 1e-5):
    """Weights and bias of a logistic scorer on soft labels, by Adagrad."""
    import numpy as np

    weights, squares = np.zeros((1 << BITS) + 1), np.full((1 << BITS) + 1, 1e-6)
    shuffled = np.random.default_rng(3)
    for _ in range(epochs):
        for i in shuffled.permutation(len(rows)):
            features, values, target = rows[i]
            at, x = np.append(features, 1 << BITS), np.append(values, 1.0)
            error = 1 / (1 + np.exp(-np.clip(x @ weights[at], -500, 500))) - target
            g = error * x + penalty * weights[at]
            squares[at] += g * g
            weights[at] -= rate * g / np.sqrt(squares[at])
    return weights[:-1], float(weights[-1])


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sample_rows: int = SAMPLE_ROWS):
    """(label model, weights, bias); None for an empty table.

    The label model counts the votes on every document; the scorer is trained on about
    sample_rows documents with their posteriors as labels.
    """
    table = docs.select(F.col(text).alias("text"), F.col(doc_id).alias("doc_id"))

    @F.arrow_udf("int")
    def pattern(texts):
        import pyarrow as pa

        return pa.array([_code(_measure(t.as_py(), scored=False)[0]) for t in texts], pa.int32())

    patterns = dict(table.select(pattern("text").alias("pattern")).groupBy("pattern").count().collect())
    if not patterns:
        return None
    model = estimate(patterns)
    share = min(1.0, sample_rows / sum(patterns.values()))
    drawn = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.monotonically_increasing_id()), 11) / F.lit(float(2**53))

    def sparse(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for text in batch.column(0):
                votes, features, values = _measure(text.as_py())
                yield pa.RecordBatch.from_pydict({
                    "target": [model.posterior(votes)], "features": pa.array([features], pa.list_(pa.int32())),
                    "values": pa.array([values], pa.list_(pa.float64()))})

    sample = table.filter(drawn < share).select("text").mapInArrow(
        sparse, "target double, features array<int>, values array<double>").toArrow()
    rows = [
        (features.values.to_numpy(), values.values.to_numpy(), target)
        for features, values, target in zip(
            sample.column("features"), sample.column("values"), sample.column("target").to_pylist())
        if len(features)
    ]
    return model, *_train(rows)


def classify(docs: DataFrame, fitted, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """Add score, posterior and kept; columns of these names are replaced.

    score is the scorer's probability of good for the whole text, posterior that of the
    label model. kept is true from the threshold on. A null or blank text has no quality
    to speak of: score and posterior 0.0, not kept. Equal texts get equal results.
    """
    import numpy as np

    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    @F.arrow_udf("score double, posterior double")
    def judge(texts):
        import pyarrow as pa

        scores, posteriors = [], []
        for value in texts:
            votes, features, values = _measure(value.as_py())
            if shared.value is None or not len(features):
                scores.append(0.0)
                posteriors.append(0.0)
                continue
            model, weights, bias = shared.value
            z = np.clip(values @ weights[features] + bias, -500, 500)
            scores.append(float(1 / (1 + np.exp(-z))))
            posteriors.append(model.posterior(votes))
        return pa.StructArray.from_arrays(
            [pa.array(scores, pa.float64()), pa.array(posteriors, pa.float64())], ["score", "posterior"])

    found = docs.withColumn("__quality", judge(F.col(text)))
    score = F.col("__quality").getField("score")
    return found.withColumns({
        "score": score, "posterior": F.col("__quality").getField("posterior"), "kept": score >= F.lit(threshold),
    }).drop("__quality")
