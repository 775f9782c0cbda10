"""Words of a text and their hashes as numpy arrays, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
# A number per byte value, from a fixed rule.
_BYTE = np.array([pow(0xD6E8FEB86659FD93, b + 3, (1 << 64) - 59) for b in range(256)], np.uint64)
# Bytes that are handled at once; longer texts are cut at a blank.
PIECE = 1 << 18
# A run without an ASCII blank that is longer counts as several words of this length.
LONGEST_WORD = 1 << 22

_BLANKS = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        steps = np.full(1 << (n - 1).bit_length(), _FACTOR if kind == "up" else _INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.cumprod(steps)
    return _powers[kind][:n]


def pieces(raw: bytes) -> Iterator[bytes]:
    """The text in pieces of about PIECE bytes, cut behind an ASCII blank.

    A longer run without a blank is one piece up to LONGEST_WORD bytes, counted from its
    own beginning, so that the words do not depend on where the pieces lie.
    """
    at = 0
    while at < len(raw):
        end = min(at + PIECE, len(raw))
        if end < len(raw):
            last = max(raw.rfind(blank, at, end) for blank in _BLANKS)
            if last < 0:
                end = min(at + LONGEST_WORD, len(raw))
                following = [i for i in (raw.find(blank, at, end) for blank in _BLANKS) if i >= 0]
                last = min(following, default=end - 1)
            end = last + 1
        yield raw[at:end]
        at = end


class Words:
    """Start, end and hashes of the words of one piece.

    A word is a run of letters, digits and non-ASCII bytes, or with blanks_only a run of
    anything but ASCII blanks.
    """

    def __init__(self, piece: bytes, blanks_only: bool = False):
        self.codes = np.frombuffer(piece, np.uint8)
        inside = ~_BLANK[self.codes] if blanks_only else _LETTERS[self.codes]
        edges = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
        self.starts, self.ends = np.nonzero(edges == 1)[0], np.nonzero(edges == -1)[0]
        self._sums = None

    def __len__(self) -> int:
        return len(self.starts)

    def part_marks(self) -> None:
        """Make the ASCII marks that end a word, behind a small ASCII letter, a word of their own."""
        kept = np.where(_LETTERS[self.codes], np.arange(len(self.codes)), -1)
        cuts = np.maximum.accumulate(kept)[self.ends - 1] + 1
        before = self.codes[np.maximum(cuts - 1, 0)]
        marked = np.nonzero((cuts < self.ends) & (cuts > self.starts) & (before >= 97) & (before <= 122))[0]
        self.starts = np.insert(self.starts, marked + 1, cuts[marked])
        ends = self.ends.copy()
        ends[marked] = cuts[marked]
        self.ends = np.insert(ends, marked + 1, self.ends[marked])

    def hashes(self, length: int | None = None) -> np.ndarray:
        """64-bit hash of each word, or of its first length bytes."""
        if self._sums is None:
            self._sums = np.concatenate([
                np.zeros(1, np.uint64), np.cumsum(_BYTE[self.codes] * _power("up", len(self.codes)))])
        ends = self.ends if length is None else np.minimum(self.ends, self.starts + length)
        spans = self._sums[ends] - self._sums[self.starts]
        return spans * _power("down", len(self.codes) + 1)[self.starts]


def buckets(hashes: np.ndarray, kind: int, bits: int) -> np.ndarray:
    """Feature numbers below 2^bits; kind keeps hashes of different meaning apart."""
    mixed = (hashes ^ _BYTE[kind]) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(33)
    return ((mixed * np.uint64(0xC4CEB9FE1A85EC53)) >> np.uint64(64 - bits)).astype(np.int64)
