"""Bounded samples of labelled rows, for classifiers that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def sample_by_label(rows: DataFrame, label: str, key: str, max_rows: int) -> DataFrame:
    """About max_rows rows, as equal as possible over the labels (at most max_rows labels).

    Every label gets the same share of max_rows. The fractions come from counts over all
    rows; rows are chosen by a hash of their key and place, so that a key that repeats
    does not come whole.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().orderBy(F.desc("count"), label).limit(max_rows).collect()}
    if not counts:
        return rows.limit(0)
    left, shares = max_rows, {}
    for i, (value, n) in enumerate(sorted(counts.items(), key=lambda x: x[1])):
        shares[value] = min(n, left // (len(counts) - i))
        left -= shares[value]
    limits = F.create_map(*[F.lit(x) for value, n in counts.items() for x in (value, shares[value] / n)])
    drawn = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string"), F.monotonically_increasing_id()), 11) / F.lit(float(2**53))
    return rows.filter(drawn < limits[F.col(label)])
