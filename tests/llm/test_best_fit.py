"""Rounds of best fit over rows against one-by-one sweeps and the plan over a histogram."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from corpuswright.llm import best_fit as fit
from corpuswright.llm.packing import plan_runs
from corpuswright.sources.staging import stage


def items_of(spark, lengths):
    return stage(spark.createDataFrame(list(enumerate(lengths)), "item long, length int"), "items")


def check(rows, lengths, capacity):
    """Every item once, sequences filled from 0 without a gap; the number of sequences."""
    assert sorted(r["item"] for r in rows) == list(range(len(lengths)))
    inside = defaultdict(list)
    for r in rows:
        assert r["length"] == lengths[r["item"]]
        inside[r["sequence"]].append((r["offset"], r["length"]))
    for places in inside.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(inside)


def test_ranks_of_ranges_meet_as_in_one_sweep():
    draw = random.Random(5)
    for _ in range(200):
        left_over = {p: (draw.randrange(4), draw.randrange(4)) for p in draw.sample(range(9), 6)}
        stack, expected = [], set()
        for part in sorted(left_over):
            for i in range(left_over[part][0]):
                if stack:
                    expected.add(((part, i), stack.pop()))
            stack += [(part, i) for i in range(left_over[part][1])]
        stretches = fit.matched_ranks(left_over)
        got = [((p, first + x), (q, low + n - 1 - x)) for p, first, q, low, n, _ in stretches for x in range(n)]
        assert len(got) == len(set(got)) and set(got) == expected
        assert [s[5] for s in stretches] == [sum(s[4] for s in stretches[:i]) for i in range(len(stretches))]


@pytest.mark.parametrize("sweep_rows", [7, 40, 1000])
def test_successors_are_those_of_best_fit(spark, sweep_rows):
    draw = random.Random(sweep_rows)
    lengths = [draw.randrange(31, 61) for _ in range(90)] + [44] * 40
    spaces = [draw.randrange(31, 60) for _ in range(70)] + [44] * 20
    gaps = spark.createDataFrame(list(enumerate(spaces)), "sequence long, gap int")
    matches, rest, met, _ = fit._take_successors(items_of(spark, lengths), gaps, len(lengths) + len(spaces), sweep_rows)
    free, expected = sorted(spaces), Counter()
    for length in sorted(lengths, reverse=True):
        at = next((i for i, gap in enumerate(free) if gap >= length), None)
        expected[length, None if at is None else free.pop(at)] += 1
    rows = matches.collect()
    assert met == len(rows) == len({r["sequence"] for r in rows}) == len({r["item"] for r in rows})
    got = Counter((r["length"], r["gap"]) for r in rows) + Counter((r["length"], None) for r in rest.collect())
    assert got == expected


@pytest.mark.parametrize("sweep_rows", [60, 100_000])
def test_sequences_are_nearly_as_few_as_one_by_one(spark, sweep_rows):
    draw = random.Random(9)
    lengths = [min(60, int(draw.paretovariate(0.8))) for _ in range(900)] + [17] * 300 + [60] * 5
    rows = fit.best_fit(items_of(spark, lengths), 60, sweep_rows).collect()
    plain = sum(r.count for r in plan_runs(Counter(lengths), 60) if r.offset == 0)
    assert check(rows, lengths, 60) <= plain * 1.01 + 1


def test_ties_empty_tables_and_wrong_lengths(spark):
    assert check(fit.best_fit(items_of(spark, [21] * 50), 60, 9).collect(), [21] * 50, 60) == 25
    assert check(fit.best_fit(items_of(spark, [1] * 130), 60).collect(), [1] * 130, 60) == 3
    empty = fit.best_fit(items_of(spark, [1]).filter("item < 0"), 60)
    assert empty.count() == 0 and empty.columns == ["item", "length", "sequence", "offset"]
    for wrong in (0, 61, None):
        with pytest.raises(ValueError):
            fit.best_fit(items_of(spark, [5, wrong]), 60)


def test_written_rounds_are_read_again(spark):
    """Two readings of the result agree: nothing in it is computed anew."""
    draw = random.Random(3)
    placed = fit.best_fit(items_of(spark, [draw.randrange(1, 61) for _ in range(200)]), 60, 50)
    key = F.sum(F.xxhash64("item", "sequence", "offset") % 1_000_003)
    assert placed.agg(key).first() == placed.repartition(3).agg(key).first()
    assert all("packed-" in file for file in placed.inputFiles())
