"""Bulk-synchronous best fit of items into sequences, by rounds over rows.

Items are taken by length bands (capacity / 2, capacity], (capacity / 4, capacity / 2] and
so on, the longest first. A round of a band has two steps:

1. Gaps within the band hold one item of it each. Items and gaps are range-sorted
   together, largest first and gaps before items of equal size. A task sweeps its range
   with the gaps not taken yet at hand: an item takes its successor, the smallest of them.
   What a range leaves over are items without a gap, and after them gaps without an item.
   The counts of both, one pair a range, settle which ranks of the items in one range meet
   which ranks of the gaps in another: as one sweep over all ranges would match them.
2. Gaps as wide as the longest item of the band hold several. Each offers as many places
   as it holds for certain; smallest gaps first, the k-th item takes the k-th place.

Then the gaps are updated, and rounds repeat while wide gaps are left. After that no gap
is as long as any item left: what step 1 leaves over is longer than the gaps it leaves. So
the items left open new sequences. They are dealt over tasks, whatever their lengths, and
each task fits its share into sequences of its own, one by one. The items of each task's
last sequence go through another round together, with fewer tasks, until one task is left.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from corpuswright.sources.staging import new_location, remove, stage

# Rows that one task sorts and sweeps.
SWEEP_ROWS = 200_000
_SWEPT = "part int, ordinal long, item long, length int, sequence long, gap int"
_PLACED = "item long, length int, sequence long, offset long"


def _sweep(batches: Iterator) -> Iterator:
    """Match (size, kind, id) rows of one range; kind is 0 for a gap and 1 for an item."""
    import pyarrow as pa
    from pyspark import TaskContext

    part, gaps, alone = TaskContext.get().partitionId(), [], 0
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
    names = ["part", "ordinal", "item", "length", "sequence", "gap"]

    def table(rows):
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    for batch in batches:
        out = []
        for size, kind, key in zip(*(c.to_pylist() for c in batch.columns)):
            if kind == 0:
                gaps.append((key, size))
            elif gaps:
                out.append((part, None, key, size, *gaps.pop()))
            else:
                out.append((part, alone, key, size, None, None))
                alone += 1
        yield table(out)
    for at in range(0, len(gaps), 10_000):
        yield table([(part, at + i, None, None, *gap) for i, gap in enumerate(gaps[at : at + 10_000])])


def matched_ranks(left_over: dict[int, tuple[int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """How items and gaps that ranges leave over meet: {range: (items, gaps)} to stretches.

    A stretch (range of items, first item, range of gaps, first gap, count, number) says
    that its items, rising, take its gaps, falling; its matches have numbers from number on.
    There are at most two stretches a range.
    """
    stretches, free, number = [], [], 0
    for part in sorted(left_over):
        items, gaps = left_over[part]
        first = 0
        while first < items and free:
            owner, top = free.pop()
            count = min(items - first, top)
            stretches.append((part, first, owner, top - count, count, number))
            first, number = first + count, number + count
            if top > count:
                free.append((owner, top - count))
        if gaps:
            free.append((part, gaps))
    return stretches


def _ranges(rows: int, sweep_rows: int) -> int:
    return max(1, -(-rows // sweep_rows))


def _sorted(frame: DataFrame, rows: int, sweep_rows: int, *order: Column) -> DataFrame:
    return frame.repartitionByRange(_ranges(rows, sweep_rows), *order).sortWithinPartitions(*order)


def _take_successors(items: DataFrame, gaps: DataFrame, rows: int, sweep_rows: int) -> tuple[DataFrame, DataFrame, int, DataFrame]:
    """Step 1: (matches, items left, number of matches, the table that both read)."""
    spark = items.sparkSession
    both = gaps.select(F.col("gap").alias("size"), F.lit(0).alias("kind"), F.col("sequence").alias("id")).unionByName(
        items.select(F.col("length").alias("size"), F.lit(1).alias("kind"), F.col("item").alias("id")))
    swept = stage(_sorted(both, rows, sweep_rows, F.col("size").desc(), F.col("kind"), F.col("id")).mapInArrow(
        _sweep, _SWEPT), "swept")
    # One row per range.
    counts = swept.groupBy("part").agg(
        F.count_if(F.col("sequence").isNull()).alias("items"), F.count_if(F.col("item").isNull()).alias("gaps"),
        F.count_if(F.col("ordinal").isNull()).alias("met")).collect()
    stretches = matched_ranks({r["part"]: (r["items"], r["gaps"]) for r in counts})
    found = F.broadcast(spark.createDataFrame(
        stretches, "item_part int, first_item long, gap_part int, first_gap long, n long, number long"))
    ordinal = F.col("ordinal")
    lone = swept.filter("sequence IS NULL").join(
        found, (F.col("part") == F.col("item_part")) & (ordinal >= F.col("first_item"))
        & (ordinal < F.col("first_item") + F.col("n")), "left",
    ).select("item", "length", (F.col("number") + ordinal - F.col("first_item")).alias("number"))
    free = swept.filter("item IS NULL").join(
        found, (F.col("part") == F.col("gap_part")) & (ordinal >= F.col("first_gap"))
        & (ordinal < F.col("first_gap") + F.col("n")),
    ).select("sequence", "gap", (F.col("number") + F.col("first_gap") + F.col("n") - 1 - ordinal).alias("number"))
    columns = ["item", "length", "sequence", "gap"]
    matches = swept.filter("ordinal IS NULL").select(*columns).unionByName(
        lone.filter("number IS NOT NULL").join(free, "number").select(*columns))
    met = sum(r["met"] for r in counts) + sum(s[4] for s in stretches)
    return matches, lone.filter("number IS NULL").select("item", "length"), met, swept


def _numbered(frame: DataFrame, amount: Column, rows: int, sweep_rows: int, *order: Column) -> tuple[DataFrame, DataFrame]:
    """frame with the sum of amount over all rows before in the order, as first; and its table."""
    spark = frame.sparkSession
    place = F.monotonically_increasing_id()
    table = stage(_sorted(frame, rows, sweep_rows, *order).withColumn("place", place).withColumn("amount", amount), "sorted")
    part = F.shiftright("place", 33)
    totals, before, starts = table.groupBy(part.alias("part")).agg(F.sum("amount").alias("n")).collect(), 0, []
    for row in sorted(totals):
        starts.append((row["part"], before))
        before += row["n"]
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    numbered = (
        table.withColumn("part", part).withColumn("inside", F.coalesce(F.sum("amount").over(within), F.lit(0)))
        .join(F.broadcast(spark.createDataFrame(starts, "part long, before long")), "part")
        .withColumn("first", F.col("before") + F.col("inside")).drop("part", "place", "inside", "before")
    )
    return numbered, table


def _take_places(items: DataFrame, n: int, gaps: DataFrame, n_gaps: int, longest: int, sweep_rows: int):
    """Step 2: (matches with a rank, items left, tables that they read)."""
    ranked, one = _numbered(items, F.lit(1).cast("long"), n, sweep_rows, F.col("length").desc(), F.col("item"))
    places, two = _numbered(
        gaps, F.floor(F.col("gap") / longest).cast("long"), n_gaps, sweep_rows, F.col("gap"), F.col("sequence"))
    last = F.least(F.col("first") + F.col("amount"), F.lit(n)) - 1
    offered = places.filter(F.col("first") < n).select("sequence", "gap", F.explode(F.sequence("first", last)).alias("first"))
    ranked = ranked.select("item", "length", "first")
    matches = ranked.join(offered, "first").select("item", "length", "sequence", "gap", F.col("first").alias("rank"))
    return matches, ranked, [one, two]


def _opened(capacity: int, first: int) -> Callable:
    """Fit (item, length) rows, longest first, into new sequences of the task, numbered from first on."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        sequence, waiting, sizes = first + (TaskContext.get().partitionId() << 28), {}, []
        for batch in batches:
            places, offsets = [], []
            for length in batch.column(1).to_pylist():
                at = bisect_left(sizes, length)
                if at < len(sizes):
                    gap = sizes[at]
                    place = waiting[gap].pop()
                    if not waiting[gap]:
                        del waiting[gap], sizes[at]
                else:
                    gap, place, sequence = capacity, sequence, sequence + 1
                places.append(place)
                offsets.append(capacity - gap)
                if gap > length:
                    if gap - length not in waiting:
                        waiting[gap - length] = []
                        insort(sizes, gap - length)
                    waiting[gap - length].append(place)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places, pa.int64()), pa.array(offsets, pa.int64())],
                ["item", "length", "sequence", "offset"])

    return run


def _with_offsets(matches: DataFrame, capacity: int) -> DataFrame:
    """Items of a sequence behind each other by rank; it takes at most as many at once as it has tokens."""
    along = Window.partitionBy("sequence").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    offset = capacity - F.col("gap") + F.coalesce(F.sum("length").over(along), F.lit(0))
    return matches.select("item", "length", "sequence", offset.cast("long").alias("offset"))


def best_fit(items: DataFrame, capacity: int, sweep_rows: int = SWEEP_ROWS) -> DataFrame:
    """(item, length, sequence, offset): each item's place in a sequence of the capacity.

    items: item (unique) and length (between 1 and the capacity), a written table. The
    items of a sequence follow each other from offset 0 without a gap. Equal lengths are
    taken in the order of item. An empty table gives an empty one.
    """
    spark: SparkSession = items.sparkSession
    items = items.select(F.col("item").cast("long"), F.col("length").cast("int"))
    bounds = [capacity]
    while bounds[-1]:
        bounds.append(bounds[-1] // 2)
    band = F.lit(None)
    for level, low in reversed(list(enumerate(bounds[1:]))):
        band = F.when(F.col("length") > low, level).otherwise(band)
    band = F.when(F.col("length") > capacity, None).otherwise(band)
    # At most one row per band.
    sizes = {r["band"]: r["n"] for r in items.groupBy(band.alias("band")).agg(F.count("*").alias("n")).collect()}
    if None in sizes:
        raise ValueError(f"{sizes[None]} lengths that are not between 1 and {capacity}")
    root, rounds = new_location(spark, "packed"), 0
    gaps, former = spark.createDataFrame([], "sequence long, gap int"), None
    for level in sorted(sizes):
        longest, low, left = bounds[level], bounds[level + 1], sizes[level]
        rest, held = items.filter((F.col("length") > low) & (F.col("length") <= longest)), []
        while left:
            near, wide, places = gaps.agg(
                F.count_if((F.col("gap") > low) & (F.col("gap") < longest)), F.count_if(F.col("gap") >= longest),
                F.coalesce(F.sum(F.floor(F.col("gap") / longest)), F.lit(0))).first() if rounds else (0, 0, 0)
            found, used = [], []
            if near:
                within = gaps.filter((F.col("gap") > low) & (F.col("gap") < longest))
                matches, rest, met, table = _take_successors(rest, within, left + near, sweep_rows)
                # One item a gap.
                found.append(matches.select("item", "length", "sequence", (capacity - F.col("gap")).cast("long").alias("offset")))
                used.append(table)
                left -= met
            if left and places:
                matches, ranked, tables = _take_places(
                    rest, left, gaps.filter(F.col("gap") >= longest), wide, longest, sweep_rows)
                found.append(_with_offsets(matches, capacity))
                taken = min(left, places)
                rest = ranked.filter(F.col("first") >= taken).select("item", "length")
                used += tables
                left -= taken
            elif left:
                # A share is worth several sequences at least.
                tasks = _ranges(left, max(sweep_rows, 4 * capacity // (low + 1)))
                dealt = rest.select("item", "length").repartition(tasks, "item")
                opened = dealt.sortWithinPartitions(F.col("length").desc(), "item").mapInArrow(
                    _opened(capacity, rounds << 48), _PLACED)
                left = 0
                if tasks > 1:
                    # What lies in the last sequence of each task, hardly filled yet, goes on together.
                    opened = stage(opened, "opened")
                    task = F.shiftright("sequence", 28).alias("task")
                    last = F.broadcast(opened.groupBy(task).agg(F.max("sequence").alias("sequence")).select("sequence"))
                    used.append(opened)
                    rest = opened.join(last, "sequence", "left_semi").select("item", "length")
                    left = rest.count()
                    opened = opened.join(last, "sequence", "left_anti").select("item", "length", "sequence", "offset")
                found.append(opened)
            matches = found[0] if len(found) == 1 else found[0].unionByName(found[1])
            matches.write.parquet(f"{root}/round={rounds}")
            placed = spark.read.schema(_PLACED).parquet(f"{root}/round={rounds}")
            filled = placed.groupBy("sequence").agg(F.sum("length").alias("filled"))
            updated = stage(
                gaps.join(filled, "sequence", "full").select(
                    "sequence",
                    (F.coalesce("gap", F.lit(capacity)) - F.coalesce("filled", F.lit(0))).cast("int").alias("gap"))
                .filter("gap > 0"), "gaps")
            rounds += 1
            # Items left are read from this round's tables, written gaps from none.
            for table in [*held, former] if former is not None else held:
                remove(table)
            gaps, former, held = updated, updated, used
        for table in held:
            remove(table)
    if not rounds:
        return spark.createDataFrame([], _PLACED)
    return spark.read.schema(_PLACED).parquet(root).drop("round")
