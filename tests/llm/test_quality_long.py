import random

import pytest

from corpuswright.llm import hashing, quality


def _texts():
    rng = random.Random(2)
    half = " ".join(f"w{rng.randrange(10**9)}" for _ in range(30_000))
    marks = " ".join(f"a{i}{'!' if i < 9_000 else '%'}" if i % 3 == 0 else f"a{i}" for i in range(60_000))
    return [half + " " + half, marks, "stop " * 120_000]


@pytest.mark.parametrize("text", _texts(), ids=["copied half", "marks", "stutter"])
def test_votes_do_not_depend_on_the_cut(text, monkeypatch):
    assert len(text) > hashing.PIECE
    cut = quality._measure(text, False)[0]
    monkeypatch.setattr(hashing, "PIECE", 1 << 22)
    assert cut == quality._measure(text, False)[0]


def test_a_copied_half_is_a_bad_vote():
    votes = dict(zip((name for name, *_ in quality.LABELLERS), quality._measure(_texts()[0], False)[0]))
    assert votes["repeated_pairs"] == quality.BAD
