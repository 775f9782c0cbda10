import random

from corpuswright.operators import synonyms


def _swap(text, lexicon):
    """Longest match from left to right over all phrases."""
    if text is None:
        return None
    words, out, at = text.split(" "), [], 0
    while at < len(words):
        fits = [p for p in lexicon if words[at : at + len(p.split(" "))] == p.split(" ")]
        if fits:
            best = max(fits, key=lambda p: len(p.split(" ")))
            out.append(lexicon[best])
            at += len(best.split(" "))
        else:
            out.append(words[at])
            at += 1
    return " ".join(out)


def test_longest_phrases_win(spark):
    rng = random.Random(3)
    words = ["a", "b", "c", "d", "new", "york"]
    lexicon = {" ".join(rng.choice(words) for _ in range(rng.randrange(1, 5))): f"<{i}>" for i in range(25)}
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(200)] + [None, "", "a", "a"]
    rows = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "id long, text string, first string, branch string")
    table = spark.createDataFrame(list(lexicon.items()), "phrase string, replacement string")
    got = {r.id: r for r in synonyms.swap_phrases(rows, table).collect()}
    assert {i: r.text for i, r in got.items()} == {i: _swap(t, lexicon) for i, t in enumerate(texts)}
    assert all((r.first, r.branch) == ("x", "y") for r in got.values())


def test_odd_lexicons(spark):
    rows = spark.createDataFrame([(1, "x y"), (1, "x y"), (None, "y")], "id long, text string")
    kind = "phrase string, replacement string"
    none = spark.createDataFrame([], kind)
    assert sorted(r.text for r in synonyms.swap_phrases(rows, none).collect()) == ["x y", "x y", "y"]
    odd = spark.createDataFrame([(None, "n"), ("", "e"), ("y", None), ("x", "b"), ("x", "a"), (" y ", "z")], kind)
    assert sorted(r.text for r in synonyms.swap_phrases(rows, odd).collect()) == ["a z", "a z", "z"]
    assert synonyms.swap_phrases(rows.limit(0), odd).count() == 0
