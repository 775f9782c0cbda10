import random

import pytest

from corpuswright.operators import minhash, similarity


@pytest.mark.parametrize("threshold,recall", [(0.9, 0.99), (0.8, 0.95), (0.5, 0.9), (1.0, 0.5)])
def test_bands_reach_the_recall(threshold, recall):
    bands, rows = minhash.bands_for(threshold, recall)
    assert bands * rows <= minhash.MAX_HASHES
    assert 1 - (1 - threshold**rows) ** bands >= recall
    longer = rows + 1
    assert 1 - (1 - threshold**longer) ** (minhash.MAX_HASHES // longer) < recall or threshold == 1.0


def test_unreachable_recall_is_refused():
    with pytest.raises(ValueError):
        minhash.bands_for(0.01, 0.999)


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(12)
    words = [f"w{i}" for i in range(400)]
    entries = []
    for i in range(150):
        base = rng.sample(words, 60)
        for split, kept in (("train", base), ("val", base[: 60 - rng.randrange(9)] + ["extra"] * rng.randrange(2))):
            entries.append((f"{split}{i}", split, " ".join(kept)))
    entries += [(f"copy{i}", "train", "one same text of many copies") for i in range(300)] + [("v", "val", "one same text of many copies")]
    entries += [("e1", "train", ""), ("e2", "val", None)]
    return spark.createDataFrame(entries, "id string, split string, text string")


def test_pairs_are_right_and_nearly_all(texts, monkeypatch):
    exact = {(r.left_id, r.right_id): r for r in similarity.jaccard_pairs(texts, 0.85).collect()}
    found = {(r.left_id, r.right_id): r for r in minhash.approximate_jaccard_pairs(texts, 0.85).collect()}
    assert found.items() <= exact.items() and len(found) >= 0.95 * len(exact) > 50
    monkeypatch.setattr(similarity, "_SALT_ROWS", 2)  # every shared bucket becomes a grid
    salted = {(r.left_id, r.right_id): r for r in minhash.approximate_jaccard_pairs(texts, 0.85).collect()}
    assert salted == found


def test_copies_meet_and_empty_tables_give_none(texts):
    same = [r for r in minhash.approximate_jaccard_pairs(texts, 0.9).collect() if r.right_id == "v"]
    assert [(r.left_id, r.left_copies, r.right_copies, r.similarity) for r in same] == [("copy0", 300, 1, 1.0)]
    assert minhash.approximate_jaccard_pairs(texts.limit(0)).count() == 0
