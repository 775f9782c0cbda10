"""Counting n-grams of token arrays in Arrow batches, on numbers instead of texts.

Tokens are numbered within a slice of rows; an n-gram is the number of its first n - 1
tokens and that of its last one, so texts are put together only for what leaves the task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

# Tokens, and rows, that are counted together.
_SLICE_TOKENS, _SLICE_ROWS = 500_000, 1 << 20


def _flat(lists) -> tuple[np.ndarray, object]:
    """(tokens of each row, all tokens) of an Arrow list array, in which null is an empty list."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return lengths, lists.flatten()


def slices(lists) -> Iterator[tuple[int, int]]:
    """Ranges of rows with a bounded number of tokens, a longer row alone."""
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < len(ends):
        most = (ends[low - 1] if low else 0) + _SLICE_TOKENS
        high = min(max(int(np.searchsorted(ends, most, "right")), low + 1), low + _SLICE_ROWS)
        yield low, high
        low = high


def _numbered(tokens) -> tuple[np.ndarray, object]:
    """(number of each token, the distinct tokens)."""
    coded = tokens.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _counted(codes: np.ndarray, rows: np.ndarray, groups: np.ndarray, times: np.ndarray | None) -> tuple:
    """(distinct codes, place of each result among them, its group, tf, df).

    Rows come in order of their groups. times is how often a row counts.
    """
    bits = max(1, int(len(groups)).bit_length())
    distinct = None
    if int(codes.max()).bit_length() + bits > 62:
        distinct, codes = np.unique(codes, return_inverse=True)
    keys = np.sort(codes << bits | rows)
    row_begun = np.nonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))[0]
    in_row = np.diff(np.append(row_begun, len(keys)))
    codes, rows = keys[row_begun] >> bits, keys[row_begun] & (1 << bits) - 1
    own = groups[rows]
    begun = np.nonzero(np.concatenate([[True], (codes[1:] != codes[:-1]) | (own[1:] != own[:-1])]))[0]
    if times is None:
        tf, df = np.add.reduceat(in_row, begun), np.diff(np.append(begun, len(codes)))
    else:
        tf, df = np.add.reduceat(in_row * times[rows], begun), np.add.reduceat(times[rows], begun)
    codes = codes[begun]
    first = np.concatenate([[True], codes[1:] != codes[:-1]])
    found = codes[first] if distinct is None else distinct[codes[first]]
    return found, np.cumsum(first) - 1, own[begun], tf, df


def gram_counts(lists, low: int, high: int, groups: np.ndarray, times: np.ndarray | None = None) -> Iterator[tuple]:
    """(terms, groups, tf, df) of the n-grams of some rows, for each n from low to high.

    tf counts the occurrences in the rows of a group and df these rows; each row counts as
    often as times says.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    lengths, tokens = _flat(lists)
    # Rows in order of their groups, so that results of a code and group lie side by side.
    order = np.argsort(groups, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    rows = np.repeat(place, lengths)
    groups, times = groups[order], None if times is None else times[order]
    numbers, names = _numbered(tokens)
    ends = np.repeat(np.cumsum(lengths), lengths)
    grams, texts, begin = numbers, names, np.arange(len(numbers))
    for n in range(1, high + 1):
        if n > 1:
            whole = begin + n - 1 < ends[begin]
            begin, codes = begin[whole], grams[whole] * len(names) + numbers[begin[whole] + n - 1]
        else:
            codes = grams
        if not len(codes):
            return
        if n >= low:
            found, at, group, tf, df = _counted(codes, rows[begin], groups, times)
        else:
            found = np.unique(codes)
        if n == 1:
            made = texts.take(pa.array(found))
        else:
            made = pc.binary_join_element_wise(
                texts.take(pa.array(found // len(names))), names.take(pa.array(found % len(names))), " ")
        if n >= low:
            yield made.take(pa.array(at)) if len(at) > len(found) else made, group, tf, df
        if n < high:
            # Numbers of the n-grams, for those that are a token longer.
            grams, texts = (np.searchsorted(found, codes), made) if n > 1 else (codes, names)


class Vocabulary:
    """Finds the n-grams of token arrays among some terms, whose place is their number."""

    def __init__(self, terms: Sequence[str]):
        # For each n the ascending codes of known beginnings; for those the number of the term, or -1.
        self.codes: list[np.ndarray] = []
        self.terms: list[np.ndarray] = []
        split = [term.split(" ") for term in terms]
        self.names = list(dict.fromkeys(word for words in split for word in words))
        number = {word: i for i, word in enumerate(self.names)}
        at = np.array([number[words[0]] for words in split], np.int64)
        left, n = np.arange(len(split)), 1
        while len(left):
            known = np.unique(at)
            at = np.searchsorted(known, at)
            said = np.full(len(known), -1, np.int64)
            ended = np.array([len(split[i]) == n for i in left], bool)
            said[at[ended]] = left[ended]
            self.codes.append(known)
            self.terms.append(said)
            left, at = left[~ended], at[~ended]
            at = at * len(self.names) + np.array([number[split[i][n]] for i in left], np.int64)
            n += 1
        self._set = None

    def counts(self, lists, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, number of the term, occurrences) of the known n-grams, rows and terms ascending."""
        import pyarrow as pa
        import pyarrow.compute as pc

        lengths, tokens = _flat(lists)
        if self._set is None:
            self._set = pa.array(self.names, pa.string())
        rows = np.repeat(np.arange(len(lengths)), lengths)
        numbers, names = _numbered(tokens)
        known = pc.fill_null(pc.index_in(names, value_set=self._set), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        numbers = known[numbers] if len(known) else numbers
        ends = np.repeat(np.cumsum(lengths), lengths)
        begin = np.nonzero(numbers >= 0)[0]
        grams, found = numbers[begin], []
        for n in range(1, min(high, len(self.codes)) + 1):
            if n > 1:
                whole = begin + n - 1 < ends[begin]
                begin, grams = begin[whole], grams[whole]
                last = numbers[begin + n - 1]
                begin, grams = begin[last >= 0], grams[last >= 0] * len(self.names) + last[last >= 0]
            at = np.minimum(np.searchsorted(self.codes[n - 1], grams), len(self.codes[n - 1]) - 1)
            hit = self.codes[n - 1][at] == grams
            begin, grams = begin[hit], at[hit]
            said = self.terms[n - 1][grams]
            if n >= low:
                found.append((rows[begin[said >= 0]], said[said >= 0]))
        size = 1 + sum(len(said) for said in self.terms)
        codes = np.sort(np.concatenate([row * size + term for row, term in found])) if found else np.zeros(0, np.int64)
        begun = np.nonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))[0] if len(codes) else np.zeros(0, np.int64)
        times = np.diff(np.append(begun, len(codes)))
        return codes[begun] // size, codes[begun] % size, times


def unit_weights(rows: np.ndarray, times: np.ndarray, idf: np.ndarray, count: int, sublinear: bool) -> np.ndarray:
    """TF-IDF weights of entries (row, occurrences, idf), every one of count rows scaled to length 1."""
    raw = (np.log(times) + 1 if sublinear else times.astype(float)) * idf
    norms = np.sqrt(np.bincount(rows, raw * raw, count))
    return raw / norms[rows]
