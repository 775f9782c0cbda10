"""Packing of token sequences: documents are cut into pieces, best_fit gives them places."""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from corpuswright.llm.best_fit import SWEEP_ROWS, best_fit
from corpuswright.sources.staging import stage

CAPACITY = 4096
END_ID = 1
# Words remembered by a Python worker, about 40 bytes each; beyond that it starts afresh.
_REMEMBERED = 1_000_000
# Bytes of text that are encoded together.
_CHUNK = 1_000_000


class Encoder:
    """Token ids of texts, with a memory of words.

    For tokenizers that ignore case, drop blanks, and encode runs of letters separately,
    the last token of each ending in "</w>". Then the ids of a word between ASCII blanks
    can be remembered, under the 64-bit hash of its bytes, and the
    marks behind a letter can be taken as a word of their own. Only ASCII words are
    lower-cased before: a capital and a mark may not compose where the small letter does.
    A text with a special token in it, in capitals or not, is encoded whole. Words of
    equal hash are compared; where they differ, the texts at hand are encoded whole.
    """

    _held: dict = {}

    def __init__(self, path: str):
        import os

        import numpy as np

        # A task has one core; threads would only hold memory of their own.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Its own memory would only cost time: no word comes twice.
        self.tokenizer.model._resize_cache(0)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        import numpy as np

        # Sorted hashes with place and number of ids, and of the word's bytes; merged as they grow.
        self.tables: list[tuple] = []
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.bytes, self.bytes_used = np.zeros(1 << 16, np.uint8), 0

    @classmethod
    def of(cls, path: str) -> Encoder:
        """One encoder for each worker and tokenizer."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def _encode(self, texts: list[str]):
        import numpy as np

        # Few at a time: the library's results take many times the room of the ids.
        slices = (texts[i : i + 32] for i in range(0, len(texts), 32))
        return [
            np.array(e.ids, "<u4") for part in slices
            for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
        ]

    def _encode_words(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word; many words at once where every one ends in one end token."""
        import numpy as np

        groups = [words[i : i + 256] for i in range(0, len(words), 256)]
        for group, ids in zip(groups, self._encode([" ".join(g) for g in groups])):
            ends = np.nonzero(self.ends[ids])[0] + 1
            if len(ends) == len(group):
                raw = ids.tobytes()
                yield from (raw[4 * a : 4 * b] for a, b in zip((0, *ends[:-1].tolist()), ends.tolist()))
            else:
                yield from (x.tobytes() for x in self._encode(group))

    def _word_ids(self, words: list[str]) -> list[bytes]:
        letters, others = [w for w in words if w.isalpha()], [w for w in words if not w.isalpha()]
        known = dict(zip(letters, self._encode_words(letters)))
        known.update(zip(others, (x.tobytes() for x in self._encode(others))))
        return [known[w] for w in words]

    def _remember(self, hashes, words: list[str]):
        """Add words with sorted hashes; their places and numbers of ids."""
        import numpy as np

        encoded = self._word_ids(words)
        counts = np.array([len(x) // 4 for x in encoded], np.int32)
        raw = [w.encode() for w in words]
        sizes = np.array([len(w) for w in raw], np.int32)
        self.ids, places, self.used = _append(self.ids, self.used, np.frombuffer(b"".join(encoded), "<u4"), counts)
        self.bytes, spots, self.bytes_used = _append(
            self.bytes, self.bytes_used, np.frombuffer(b"".join(raw), np.uint8), sizes)
        table = (hashes, places, counts, spots, sizes)
        while self.tables and len(self.tables[-1][0]) < 2 * len(table[0]):
            joined = [np.concatenate(pair) for pair in zip(self.tables.pop(), table)]
            order = np.argsort(joined[0], kind="stable")
            table = tuple(column[order] for column in joined)
        self.tables.append(table)
        return places, counts

    def __call__(self, texts: list[bytes]):
        """(ids of all texts one after the other, number of ids of each)."""
        import numpy as np

        from corpuswright.llm.hashing import Words

        whole = {i for i, t in enumerate(map(bytes.lower, texts)) if any(s in t for s in self.special)}
        if whole:
            apart = [self._encode([t.decode()])[0] if i in whole else None for i, t in enumerate(texts)]
            ids, counts = self([b"" if i in whole else t for i, t in enumerate(texts)])
            each = np.split(ids, np.cumsum(counts)[:-1])
            each = [a if a is not None else b for a, b in zip(apart, each)]
            return np.concatenate(each), np.array([len(x) for x in each])
        text = _lower_ascii_words(b"\n".join(texts))
        words = Words(text, blanks_only=True)
        words.part_marks()
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        if sum(len(t[0]) for t in self.tables) > _REMEMBERED:
            self._forget()
        hashes, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        places, counts = np.zeros(len(hashes), np.int64), np.full(len(hashes), -1, np.int32)
        lengths = words.ends - words.starts
        repeated = np.nonzero(first[inverse] != np.arange(len(inverse)))[0]
        model = first[inverse[repeated]]
        equal = _same(words.codes, words.starts[repeated], lengths[repeated], words.codes, words.starts[model], lengths[model])
        for known, at, n, spots, sizes in self.tables:
            row = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = np.nonzero(known[row] == hashes)[0]
            row = row[hit]
            equal = equal and _same(
                words.codes, words.starts[first[hit]], lengths[first[hit]], self.bytes, spots[row], sizes[row])
            places[hit], counts[hit] = at[row], n[row]
        if not equal:
            each = self._encode([t.decode() for t in texts])
            return np.concatenate(each), np.array([len(x) for x in each])
        new = np.nonzero(counts < 0)[0]
        if len(new):
            spans = zip(words.starts[first[new]].tolist(), words.ends[first[new]].tolist())
            places[new], counts[new] = self._remember(hashes[new], [text[a:b].decode() for a, b in spans])
        n, start = counts[inverse].astype(np.int64), places[inverse]
        before = np.cumsum(n) - n
        ids = self.ids[np.repeat(start - before, n) + np.arange(n.sum())]
        ends = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(ends, words.starts, side="right")
        return ids, np.bincount(owner, n, len(texts)).astype(np.int64)


def _append(held, used: int, new, counts):
    """Put new behind the used part of a growing array: (array, place of each run, used now)."""
    import numpy as np

    if used + len(new) > len(held):
        grown = np.empty((used + len(new)) * 3 // 2, held.dtype)
        grown[:used] = held[:used]
        held = grown
    held[used : used + len(new)] = new
    return held, used + np.cumsum(counts, dtype=np.int64) - counts, used + len(new)


def _same(left, left_starts, left_lengths, right, right_starts, right_lengths) -> bool:
    """Whether all runs of the one array equal those of the other."""
    import numpy as np

    if not np.array_equal(left_lengths, right_lengths):
        return False
    lengths = left_lengths.astype(np.int64)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return bool((left[np.repeat(left_starts, lengths) + inside] == right[np.repeat(right_starts, lengths) + inside]).all())


def _lower_ascii_words(raw: bytes) -> bytes:
    """raw with the words between ASCII blanks in small letters, those beyond ASCII as they are."""
    import numpy as np

    from corpuswright.llm.hashing import Words

    if raw.isascii():
        return raw.lower()
    words = Words(raw, blanks_only=True)
    seen = np.concatenate([[0], np.cumsum(words.codes >= 128)])
    beyond = seen[words.ends] > seen[words.starts]
    edges = np.zeros(len(raw) + 1, np.int8)
    edges[words.starts[beyond]], edges[words.ends[beyond]] = 1, -1
    kept = np.cumsum(edges[:-1], dtype=np.int8).view(bool)
    return np.where(kept, words.codes, np.frombuffer(raw.lower(), np.uint8)).tobytes()


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                  doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each document in pieces.

    tokenizer names a file that every executor can read. A null text is empty: its piece
    holds the end id alone. With keep_ids there is a column ids too.
    """

    def cut(batches: Iterator) -> Iterator:
        from zlib import crc32

        import numpy as np
        import pyarrow as pa

        encoder, end, step = Encoder.of(tokenizer), np.array([end_id], "<u4").tobytes(), 4 * capacity

        def emit(keys, texts):
            out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
            flat, counts = encoder(texts)
            raw, bounds = flat.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
            for key, first, last in zip(keys, (0, *bounds), bounds):
                ids = raw[first:last] + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    values = (key, piece, at // 4, len(part) // 4, crc32(part), np.frombuffer(part, "<u4"))
                    for column, value in zip(out.values(), values):
                        column.append(value)
            arrays = {
                "doc_id": pa.array(out["doc_id"], pa.int64()), "piece": pa.array(out["piece"], pa.int32()),
                "start": pa.array(out["start"], pa.int64()), "length": pa.array(out["length"], pa.int64()),
                "ids_crc32": pa.array(out["ids_crc32"], pa.int64()),
            }
            if keep_ids:
                arrays["ids"] = pa.array(out["ids"], pa.list_(pa.int32()))
            return pa.RecordBatch.from_pydict(arrays)

        for batch in batches:
            keys, texts, size = [], [], 0
            for key, value in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                texts.append(value.as_py() or b"")
                size += len(texts[-1])
                if size >= _CHUNK:
                    yield emit(keys, texts)
                    keys, texts, size = [], [], 0
            if keys:
                yield emit(keys, texts)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(cut, schema)


@dataclass(frozen=True)
class Run:
    """Pieces of one length with ranks from first_rank on lie at one offset of successive sequences."""

    length: int
    first_rank: int
    count: int
    first_sequence: int
    offset: int


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    """Best fit, longest first, one piece after another, over the number of pieces of each length.

    The yardstick for best_fit's rounds: how few sequences a given histogram of lengths needs.
    """
    runs: list[Run] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, count)
    sizes: list[int] = []  # the gaps in order
    sequences = 0

    def add(gap: int, first: int, count: int) -> None:
        if gap > 0:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            heapq.heappush(gaps[gap], (first, count))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of length {length}")
        rank, left = 0, histogram[length]
        while left:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                gap = sizes[at]
                first, count = heapq.heappop(gaps[gap])
                used = min(count, left)
                if used < count:
                    heapq.heappush(gaps[gap], (first + used, count - used))
                if not gaps[gap]:
                    del gaps[gap], sizes[at]
            else:
                # New sequences for all that is left, each filled with this length.
                gap, first, used = capacity, sequences, -(-left // (capacity // length))
                sequences += used
            runs.append(Run(length, rank, used, first, capacity - gap))
            add(gap - length, first, used)
            rank, left = rank + used, left - used
    return runs


def pack(pieces: DataFrame, capacity: int = CAPACITY, sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """Add sequence_id and offset to pieces with a column length between 1 and the capacity.

    The pieces of a sequence follow each other from offset 0 without a gap. Equal rows
    are packed like others; an empty table gives an empty one.
    """
    rows = stage(pieces.withColumn("__item", F.monotonically_increasing_id()), "pieces")
    placed = best_fit(rows.select(F.col("__item").alias("item"), "length"), capacity, sweep_rows)
    return rows.join(placed.select(F.col("item").alias("__item"), "sequence", "offset"), "__item").select(
        *pieces.columns, F.col("sequence").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                   doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """Cut documents into pieces of at most capacity tokens and pack them; one row per piece."""
    return pack(cut_documents(docs, tokenizer, capacity, end_id, doc_id, text, keep_ids), capacity)
