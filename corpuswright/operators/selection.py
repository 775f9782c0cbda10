"""The first k rows of every group, exactly, without sorting a group.

An order is described by digits of 16 bits, most significant first: the rows are counted
per digit, combined inside the map tasks, and the counts tell at which digit the k-th row
lies. Rows before it are taken, rows behind it are left, and only where too many rows
share the digit the next one is counted. Few rows at the cut remain to be ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

DIGIT_BITS = 16
# Rows of a group at the cut that one task may sort.
_RANKED = 100_000
_NULL = "\u0000"


def hex_digits(text: Column, length: int = 32) -> list[Column]:
    """Digits of an order by hexadecimal text of fixed length."""
    return [F.conv(F.substring(text, at, 4), 16, 10).cast("int") for at in range(1, length, 4)]


def text_digits(text: Column, bytes_used: int = 64) -> list[Column]:
    """Digits of an order by text, as Spark orders it: by its UTF-8 bytes."""
    coded = F.hex(F.substring(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 1, bytes_used))
    return [F.coalesce(F.conv(F.rpad(F.substring(coded, at, 4), 4, "0"), 16, 10).cast("int"), F.lit(0))
            for at in range(1, 2 * bytes_used, 4)]


def number_digits(number: Column, largest: int) -> list[Column]:
    """Digits of an ascending order by numbers from 0 to largest."""
    count = max(1, -(-int(largest).bit_length() // DIGIT_BITS))
    return [F.shiftrightunsigned(number.cast("long"), DIGIT_BITS * i).bitwiseAND((1 << DIGIT_BITS) - 1).cast("int")
            for i in reversed(range(count))]


def _name(group: str | None) -> Column:
    return F.lit(_NULL) if group is None else F.coalesce(F.col(group).cast("string"), F.lit(_NULL))


def _crossings(rows: DataFrame, name: Column, digit: Column, wanted: Mapping[str, int]) -> dict:
    """Per group the digit at which the wanted number of rows is reached: (digit, rows before, rows there)."""
    counts = rows.groupBy(name.alias("name"), digit.alias("digit")).agg(F.count("*").alias("rows"))
    ordered = Window.partitionBy("name").orderBy("digit")
    limit = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])[F.col("name")]
    reached = counts.withColumn("before", F.sum("rows").over(ordered) - F.col("rows"))
    found = reached.filter((F.col("before") < limit) & (F.col("before") + F.col("rows") >= limit))
    return {r["name"]: (r["digit"], r["before"], r["rows"]) for r in found.collect()}


def _at(digits: Sequence[Column], prefix: Sequence[int]) -> Column:
    return reduce(lambda a, b: a & b, [d == p for d, p in zip(digits, prefix)])


def _before(digits: Sequence[Column], prefix: Sequence[int]) -> Column:
    parts = [_at([*digits[:i], F.lit(True)], [*prefix[:i], True]) & (digits[i] < p) for i, p in enumerate(prefix)]
    return reduce(lambda a, b: a | b, parts)


def first_per_group(
    rows: DataFrame, group: str | None, n: int | Mapping[str, int], order: Sequence[Column], digits: Sequence[Column],
) -> DataFrame:
    """The first n rows by order within every group (one group without a column).

    digits: 16-bit numbers that never fall along the order. n may name the group values,
    by their text form; groups that it does not name are left out. Ties beyond the order
    are broken arbitrarily, so order should be unique. The groups come to the driver,
    with a few numbers each. rows is read once per digit needed, usually one, and once
    more; stage it if it is costly.
    """
    name = _name(group)
    if isinstance(n, Mapping):
        wanted = {str(k): v for k, v in n.items() if v > 0}
        rows = rows.filter(name.isin(*wanted)) if wanted else rows.limit(0)
    elif group is None:
        wanted = {_NULL: n}
    else:
        wanted = {r[0]: n for r in rows.select(name.alias("name")).distinct().collect()}
    if not wanted or min(wanted.values()) <= 0:
        return rows.limit(0)
    open_groups, cuts, level = {g: ((), k) for g, k in wanted.items()}, {}, 0
    while open_groups:
        here = [(name == g) & _at([*digits[:level], F.lit(True)], [*prefix, True]) for g, (prefix, _) in open_groups.items()]
        inside = rows.filter(reduce(lambda a, b: a | b, here)) if level else rows
        found = _crossings(inside, name, digits[level], {g: k for g, (_, k) in open_groups.items()})
        following = {}
        for g, (digit, before, there) in found.items():
            prefix, left = (*open_groups[g][0], digit), open_groups[g][1] - before
            if there > max(left, _RANKED) and level + 1 < len(digits):
                following[g] = (prefix, left)
            else:
                cuts[g] = (prefix, left, there)
        open_groups, level = following, level + 1
    if not cuts:
        return rows
    whole = reduce(lambda a, b: a | b, [
        (name == g) & (_before(digits, p) | _at(digits, p) if there <= left else _before(digits, p))
        for g, (p, left, there) in cuts.items()])
    taken = rows.filter(whole | ~name.isin(*cuts))
    ranked = {g: (p, left) for g, (p, left, there) in cuts.items() if there > left}
    if not ranked:
        return taken
    edge = rows.filter(reduce(lambda a, b: a | b, [(name == g) & _at(digits, p) for g, (p, _) in ranked.items()]))
    limit = F.create_map(*[F.lit(x) for g, (_, left) in ranked.items() for x in (g, left)])[F.col("__name")]
    nth = F.row_number().over(Window.partitionBy("__name").orderBy(*order))
    last = edge.withColumn("__name", name).withColumn("__nth", nth).filter(F.col("__nth") <= limit)
    return taken.unionByName(last.drop("__name", "__nth"))


def with_rank(rows: DataFrame, group: str | None, order: Sequence[Column], digit: Column, output: str) -> DataFrame:
    """Number the rows of every group from 1 along the order, sorting one digit's rows at a time."""
    keyed = rows.withColumn("__name", _name(group)).withColumn("__digit", digit)
    ordered = Window.partitionBy("__name").orderBy("__digit")
    counts = keyed.groupBy("__name", "__digit").agg(F.count("*").alias("__rows"))
    starts = counts.select("__name", "__digit", (F.sum("__rows").over(ordered) - F.col("__rows")).alias("__start"))
    within = F.row_number().over(Window.partitionBy("__name", "__digit").orderBy(*order))
    numbered = keyed.withColumn("__nth", within).join(starts, ["__name", "__digit"])
    return numbered.withColumn(output, (F.col("__start") + F.col("__nth")).cast("int")).select(*rows.columns, output)
