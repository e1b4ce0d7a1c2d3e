"""Id ranges, global positions and chunks without a one-task sort."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.session import stable

# Rows one window task should sort.
ROWS_PER_BUCKET = 1_000_000


# ---- id ranges ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Bounds:
    """Smallest and largest id; an empty table has ``low > high``."""

    low: Column
    high: Column

    @staticmethod
    def fixed(low: int, high: int) -> Bounds:
        return Bounds(F.lit(low).cast("bigint"), F.lit(high).cast("bigint"))

    @staticmethod
    def lazily(df: DataFrame, key: str) -> Bounds:
        """Bounds as a scalar subquery: the plan stays one query and reads only the key column."""
        both = id_bounds(df, key).select(F.struct("min_id", "max_id").alias("b")).scalar()
        return Bounds(both.getField("min_id"), both.getField("max_id"))


def id_bounds(df: DataFrame, key: str) -> DataFrame:
    """One row ``(min_id, max_id)``; an empty table gives ``(1, 0)``."""
    return df.agg(
        F.coalesce(F.min(key), F.lit(1)).cast("bigint").alias("min_id"),
        F.coalesce(F.max(key), F.lit(0)).cast("bigint").alias("max_id"),
    )


def _width(low: Column, high: Column, n: int) -> Column:
    return F.call_function("div", high - low, F.lit(n).cast("bigint"))


def id_ranges(bounds: DataFrame, n: int) -> DataFrame:
    """The ``n`` closed ranges ``(range_no, name, min_id, max_id)`` of a ``(min_id, max_id)`` row.

    All ranges are equally wide, the last one takes the remainder; with fewer ids than ranges
    all but the last are empty. An empty table has the single range ``(1, 0)``.
    """
    low, high = F.col("min_id"), F.col("max_id")
    width = _width(low, high, n)
    no = F.col("range_no").cast("bigint")
    last = F.when(low > high, F.lit(0)).otherwise(F.lit(n - 1))
    return bounds.select(low, high, F.explode(F.sequence(F.lit(0), last)).alias("range_no")).select(
        "range_no",
        F.concat(F.lit("partition"), F.col("range_no").cast("string")).alias("name"),
        (low + no * width).alias("min_id"),
        F.when(no == last, high).otherwise(low + (no + 1) * width - 1).alias("max_id"),
    )


def range_number(key: Column, bounds: Bounds, n: int) -> Column:
    """The number of the range that holds the id, by arithmetic alone."""
    width = _width(bounds.low, bounds.high, n)
    index = F.call_function("div", key - bounds.low, F.nullif(width, F.lit(0).cast("bigint")))
    return F.least(F.lit(n - 1), F.coalesce(index, F.lit(n - 1))).cast("int")


def assign_id_range(
    df: DataFrame, key: str, n: int, bounds: Bounds | None = None, name: str = "range_no"
) -> DataFrame:
    return df.withColumn(name, range_number(F.col(key), bounds or Bounds.lazily(df, key), n))


# ---- positions ----------------------------------------------------------------------------


def running_total(
    df: DataFrame,
    order: list[str],
    groups: list[str] | None = None,
    weight: str | None = None,
    name: str = "position",
    total: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Sum of the weights (default 1) of all rows before this one, per group, in ``order``.

    ``order`` must be total within a group. Groups of up to ``rows_per_bucket`` rows are ordered by one window. Larger
    ones (or a large table without groups) are cut into buckets by sampled ranges over groups and order, written once
    so that both passes see the same cut; each bucket is summed, the sums give every bucket its offset, and rows are
    ordered only inside their bucket. So neither a table without groups nor a group with a third of all rows meets in
    one task, and small groups have no buckets at all.

    The input is read more than once: pass a table or a stored frame, not a long plan.
    """
    groups = groups or []
    columns = [*df.columns, name, *([total] if total else [])]
    sizes = df.groupBy(*groups).agg(F.count("*").alias("_rows"))
    n = sizes.agg(F.sum(F.when(F.col("_rows") > rows_per_bucket, F.col("_rows")))).first()[0]
    if not n:
        return _plain_total(df, order, groups, weight, name, total).select(*columns)
    out = []
    large = df
    if groups:
        # At most one row for each rows_per_bucket rows.
        named = stable(sizes.filter(F.col("_rows") > rows_per_bucket).select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]))
        same = reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)])
        out.append(_plain_total(df.join(named, same, "left_anti"), order, groups, weight, name, total))
        large = df.join(named, same, "left_semi")
    buckets = max(math.ceil(n / rows_per_bucket), df.sparkSession.sparkContext.defaultParallelism)
    split = stable(large.repartitionByRange(buckets, *groups, *order).withColumn("_bucket", F.spark_partition_id()))
    sums = _bucket_sums(split, groups, weight)

    per_group = W.partitionBy(*groups) if groups else W.partitionBy()
    before = per_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    heads = sums.select(
        *groups,
        "_bucket",
        F.lit(True).alias("_head"),
        F.coalesce(F.sum("_weight").over(before), F.lit(0)).alias("_add"),
        F.sum("_weight").over(per_group).alias("_total"),
    )
    rows = split.withColumns(
        {
            "_head": F.lit(False),
            "_add": F.col(weight) if weight else F.lit(1).cast("bigint"),
            "_total": F.lit(None).cast(heads.schema["_total"].dataType),
        }
    )
    # Each bucket's offset joins its rows as a leading row of the same window: one shuffle, no join.
    inside = W.partitionBy(*groups, "_bucket").orderBy(F.desc("_head"), *order)
    so_far = inside.rowsBetween(W.unboundedPreceding, -1)
    cut = rows.unionByName(heads, allowMissingColumns=True).withColumn(name, F.sum("_add").over(so_far).cast("bigint"))
    if total:
        cut = cut.withColumn(total, F.first("_total").over(inside.rowsBetween(W.unboundedPreceding, 0)))
    out.append(cut.filter(~F.col("_head")))
    return reduce(DataFrame.union, [x.select(*columns) for x in out])


def _plain_total(df: DataFrame, order: list[str], groups: list[str], weight: str | None, name: str, total: str | None) -> DataFrame:
    """The same by one window per group."""
    group = W.partitionBy(*groups) if groups else W.partitionBy()
    add = F.col(weight) if weight else F.lit(1).cast("bigint")
    so_far = group.orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = df.withColumn(name, F.coalesce(F.sum(add).over(so_far), F.lit(0)).cast("bigint"))
    return out.withColumn(total, F.sum(add).over(group)) if total else out


def _bucket_sums(split: DataFrame, groups: list[str], weight: str | None) -> DataFrame:
    weights = F.sum(weight) if weight else F.count("*")
    return stable(split.groupBy(*groups, "_bucket").agg(weights.alias("_weight")))


# Bits of a generated row id that count rows inside one task; the rest is the task's number.
_ROW_BITS = 33


def number_rows(df: DataFrame, start: int = 1, name: str = "id") -> DataFrame:
    """Rows numbered without gaps from ``start`` in the order they are read.

    The rows are written once with the id Spark generates from task number and row number. The rows of each
    task are added up, and their running total is joined back; the planner broadcasts it only where it is small.
    """
    read = stable(df.withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", _ROW_BITS)
    sums = stable(read.groupBy(task.alias("_task")).agg(F.count("*").alias("_n")))
    offsets = running_total(sums, ["_task"], weight="_n", name="_before").select("_task", "_before")
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        read.withColumn("_task", task)
        .join(offsets, "_task")
        .select((F.col("_before") + row + start).alias(name), *df.columns)
    )


def assign_chunk(
    df: DataFrame,
    key: str,
    size: int,
    groups: list[str] | None = None,
    name: str = "chunk_no",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The i-th row in key order belongs to chunk ``i div size``, per group."""
    ranked = running_total(df, [key], groups, name="_position", rows_per_bucket=rows_per_bucket)
    chunk = F.call_function("div", F.col("_position"), F.lit(size).cast("bigint"))
    return ranked.withColumn(name, chunk).drop("_position")


def page_of(df: DataFrame, key: str, limit: int) -> DataFrame:
    """The first ``limit`` rows in key order, as a top-k."""
    return df.orderBy(key).limit(limit)
