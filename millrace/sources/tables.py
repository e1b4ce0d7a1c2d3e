"""Scans over tables: ordered, by id range, by page, by state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordering import Bounds, range_number


def scan_ordered(df: DataFrame, key: str, columns: list[str], ordered: bool = True) -> DataFrame:
    """The named columns of the whole table in key order, whatever the rows' state.

    Pass ``ordered=False`` when a later step sorts or aggregates anyway: the order matters at
    the output only, and a range-partitioned sort is the price of it.
    """
    out = df.select(key, *[c for c in columns if c != key])
    return out.orderBy(key) if ordered else out


def scan_id_ranges(df: DataFrame, key: str, n: int, bounds: Bounds | None = None) -> DataFrame:
    """The table with the number of the closed id range each row falls into."""
    return df.withColumn("range_no", range_number(F.col(key), bounds or Bounds.lazily(df, key), n))


def scan_one_range(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """One closed id range; both limits reach the file scan."""
    return df.filter(F.col(key).between(low, high))


def range_predicates(key: str, ranges: list[tuple[int, int]]) -> list[str]:
    """One SQL predicate per closed range, for a partitioned database read."""
    return [f"{key} BETWEEN {low} AND {high}" for low, high in ranges]


def scan_jdbc_ranges(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    ranges: list[tuple[int, int]],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table read with exactly one task per id range."""
    return spark.read.jdbc(
        url, table, predicates=range_predicates(key, ranges), properties=properties or {}
    )


def scan_keyset(df: DataFrame, key: str, after: int = 0, limit: int | None = None) -> DataFrame:
    """Unprocessed rows behind ``after`` in key order: one page, or all of them without a limit."""
    rest = df.filter((F.col(key) > after) & ~F.col("processed"))
    return rest if limit is None else rest.orderBy(key).limit(limit)


def scan_undispatched(df: DataFrame, group: str = "group_no") -> DataFrame:
    return df.filter(F.col(group).isNull())


def scan_by_status(df: DataFrame, status: str, column: str = "dispatch_status") -> DataFrame:
    return df.filter(F.col(column) == status)
