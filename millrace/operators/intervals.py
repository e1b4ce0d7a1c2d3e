"""Rows of many key intervals: what to read, and to which interval a row belongs.

The intervals are a setting of a run (its id ranges), never of the data: some ten thousand at most, held by the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Conditions that a scan's filter may have.
MOST_CONDITIONS = 64
#: Intervals that are told apart by plain conditions instead of a join.
FEW = 8
#: Bins an interval covers at most on average.
BINS = 4


@dataclass(frozen=True)
class Interval:
    """Keys from ``low`` to ``high``, both included, with values that its rows get."""

    low: int
    high: int
    values: tuple = ()


def covering(intervals: Sequence[Interval], most: int = MOST_CONDITIONS) -> list[tuple[int, int]]:
    """At most ``most`` spans that cover all intervals: neighbours are one span, and so are those with the smallest
    gaps between them."""
    spans: list[list[int]] = []
    for one in sorted(intervals, key=lambda i: i.low):
        if one.high < one.low:
            continue
        if spans and one.low <= spans[-1][1] + 1:
            spans[-1][1] = max(spans[-1][1], one.high)
        else:
            spans.append([one.low, one.high])
    gaps = sorted((b[0] - a[1] for a, b in zip(spans, spans[1:])), reverse=True)
    least = gaps[most - 1] if len(gaps) >= most else 0
    out: list[list[int]] = []
    for span in spans:
        if out and span[0] - out[-1][1] <= least:
            out[-1][1] = span[1]
        else:
            out.append(span)
    return [(low, high) for low, high in out]


def inside(key: str, intervals: Sequence[Interval], most: int = MOST_CONDITIONS) -> Column:
    """A condition of literals that every row of the intervals meets; the file scan prunes by it."""
    tests = [F.col(key).between(low, high) for low, high in covering(intervals, most)]
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def rows_of(df: DataFrame, intervals: Sequence[Interval], fields: Sequence[T.StructField], key: str = "id") -> DataFrame:
    """The rows of the intervals, which do not overlap, with the values of theirs as ``fields``.

    A few intervals are plain conditions. More are met by bins of keys: every interval is listed under the bins it
    covers, a row looks into its own bin only, and the list is broadcast, since its length is bounded by the intervals.
    """
    intervals = [i for i in intervals if i.high >= i.low]
    found = df.filter(inside(key, intervals))
    if len(intervals) <= FEW:
        for at, field in enumerate(fields):
            value = F.lit(None).cast(field.dataType)
            for one in intervals:
                hit = F.col(key).between(one.low, one.high)
                value = F.when(hit, F.lit(one.values[at]).cast(field.dataType)).otherwise(value)
            found = found.withColumn(field.name, value)
        return found
    # Bins as wide as the middle interval; wider where a few very long intervals would fill too many.
    width = max(1, int(median(i.high - i.low + 1 for i in intervals)))
    width = max(width, -(-sum(i.high - i.low + 1 for i in intervals) // (BINS * len(intervals))))
    rows = [
        (number, one.low, one.high, *one.values)
        for one in intervals
        for number in range(one.low // width, one.high // width + 1)
    ]
    long = T.LongType()
    named = [T.StructField(name, long) for name in ("_bin", "_low", "_high")]
    listed = df.sparkSession.createDataFrame(rows, T.StructType([*named, *fields]))
    whole = F.col(key) - F.pmod(F.col(key), F.lit(width))
    joined = found.withColumn("_bin", F.call_function("div", whole, F.lit(width)).cast("long")).join(F.broadcast(listed), "_bin")
    return joined.filter(F.col(key).between(F.col("_low"), F.col("_high"))).drop("_bin", "_low", "_high")
