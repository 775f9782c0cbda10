import random

import pytest

from corpuswright.operators import sketches


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    entries = [(rng.choice(["train", "val"]), rng.choice(["a", "b"]), f"f{i // 2}", int(rng.lognormvariate(4, 1)), rng.randrange(400)) for i in range(30_000)]
    return spark.createDataFrame(entries, "split string, source string, family_id string, text_len_char int, text_len_word int")


def test_merged_parts_answer_like_the_whole(rows):
    local = rows.collect()
    old, new = rows.filter("text_len_char % 2 = 0"), rows.filter("text_len_char % 2 = 1")
    states = sketches.sketch_states(old).unionByName(sketches.sketch_states(new))
    for r in sketches.sketch_answers(sketches.merge_states(states)).collect():
        own = [x for x in local if x.split == r.split]
        assert r.rows == len(own)
        families = len({x.family_id for x in own})
        assert abs(r.families - families) <= sketches.DISTINCT_ERROR * families
        for name, column in (("chars", "text_len_char"), ("words", "text_len_word")):
            ordered = sorted(x[column] for x in own)
            for q in (0.25, 0.5, 0.75):
                value = r[f"{name}_p{round(100 * q)}"]
                below, upto = sum(v < value for v in ordered) / len(own), sum(v <= value for v in ordered) / len(own)
                assert below - sketches.RANK_ERROR <= q <= upto + sketches.RANK_ERROR
        assert abs(r.share_within - sum(x.text_len_word <= 256 for x in own) / len(own)) <= sketches.RANK_ERROR


def test_states_stay_small_and_empty_tables_have_none(rows):
    states = sketches.sketch_states(rows).collect()
    assert len(states) == 4 and all(len(s.chars) < 8_000 and len(s.families) < 8_000 for s in states)
    assert sketches.sketch_states(rows.limit(0)).count() == 0
