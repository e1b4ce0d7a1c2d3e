"""Joins of the pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import ROWS_PER_BUCKET, assign_chunk
from millrace.session import stable


def event_files(files: DataFrame, tickets: DataFrame, event_id: int | None = None) -> DataFrame:
    """Registered files with the event of their ticket, for one event or all of them."""
    wanted = tickets.select(F.col("id").alias("ticket_id"), "event_id")
    if event_id is not None:
        wanted = wanted.filter(F.col("event_id") == event_id)
    return files.join(wanted, "ticket_id")


def pages_of(
    rows: DataFrame,
    group: str,
    key: str,
    item: Column,
    size: int,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Items of each group in key order as arrays of at most ``size``: ``(group, page, items)``.

    A list per group would have no bound; pages keep every row and bound every array.
    """
    paged = assign_chunk(
        rows.withColumn("_item", item), key, size, [group], "page", rows_per_bucket
    )
    ordered = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col("_item").alias("v"))))
    return paged.groupBy(group, "page").agg(
        F.transform(ordered, lambda e: e.getField("v")).alias("items")
    )


def group_members(
    groups: DataFrame,
    members: DataFrame,
    item: Column,
    size: int,
    group: str = "group_no",
    key: str = "id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Groups with their members as pages of at most ``size``; a group without any has one empty
    page. ``members_total`` counts over all pages of the group."""
    # Only the wanted groups' members are counted and put in pages.
    members = stable(members.join(groups.select(group), group, "left_semi").withColumn("_item", item).select(group, key, "_item"))
    pages = pages_of(members, group, key, F.col("_item"), size, rows_per_bucket)
    totals = members.groupBy(group).agg(F.count("*").alias("members_total"))
    none = F.lit(0).cast("bigint")
    counted = groups.join(totals, group, "left").withColumn(
        "members_total", F.coalesce("members_total", none)
    )
    # The pages of a hot group are on the left of an inner join, where a skewed partition can be
    # split; as the right side of an outer join they could not.
    filled = pages.join(counted, group).select(*counted.columns, "page", "items")
    empty = F.array().cast(pages.schema["items"].dataType)
    missing = counted.filter(F.col("members_total") == 0).withColumns({"page": none, "items": empty})
    return filled.unionByName(missing)


def anti_existing(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not exist yet."""
    return df.join(existing.select(key).distinct(), key, "left_anti")


def not_exists_any(df: DataFrame, other: DataFrame) -> DataFrame:
    """All rows if ``other`` is empty, none otherwise; ``other`` is read up to its first row."""
    return df.where(~other.exists())


def enrich(
    df: DataFrame, lookup: DataFrame, key: str = "id", value: str = "value", required: bool = True
) -> DataFrame:
    """Rows with their looked-up value; a missing value fails the query.

    The lookup may be as large as the table, so the join strategy is left to the planner, which
    broadcasts it only when its measured size allows.
    """
    # A repeated key would multiply rows; it fails the query.
    many = F.raise_error(F.concat(F.lit(f"more than one {value} for {key}="), F.col(key).cast("string")))
    once = lookup.groupBy(key).agg(F.first(value).alias(value), F.count("*").alias("_n"))
    once = once.select(key, F.when(F.col("_n") > 1, many.cast(lookup.schema[value].dataType)).otherwise(F.col(value)).alias(value))
    joined = df.join(once, key, "left")
    if not required:
        return joined
    there = F.col(value).isNotNull() | F.raise_error(
        F.concat(F.lit(f"no {value} for {key}="), F.col(key).cast("string"))
    ).cast("boolean")
    return joined.filter(there)


def with_definition(runs: DataFrame, definitions: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Runs with the definition of their job; without one there is nothing to audit."""
    known = definitions.select("job_name", "definition_id", "version")
    return runs.join(known, "job_name", "left" if keep_unknown else "inner")
