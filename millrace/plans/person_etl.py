"""Person ETL: load a delimited file, snapshot with a looked-up value, dispatch in groups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.checks import MaxLength, NotNull, Rule, check_date
from millrace.functions.text import key_uuid, snapshot, to_payload_json, upper_names
from millrace.operators.faults import DISPATCH_SIZE, KNOWN_CLASSES, dispatch, read_skips, write_skips
from millrace.operators.joins import enrich
from millrace.operators.ordering import number_rows
from millrace.operators.sinks import (
    append_to,
    dead_letter,
    insert_if_absent,
    insert_if_absent_into,
    read_table,
    split_by_rules,
    store_letters,
)
from millrace.plans.params import require, text
from millrace.schemas import DEAD_LETTER, DISPATCHED_GROUP, GROUP_MEMBER, MARK, PERSONS, PERSONS_V2
from millrace.session import stable
from millrace.sources.files import scan_delimited, scan_permissive

CSV_COLUMNS = ["first_name", "last_name", "email", "profession"]

# What the snapshot table asks of a row; the first table is wider and takes NULL.
PERSON_RULES: list[Rule] = [
    NotNull("first_name"),
    NotNull("last_name"),
    NotNull("email"),
    NotNull("profession"),
    MaxLength("first_name", 50),
    MaxLength("last_name", 50),
    MaxLength("email", 50),
    MaxLength("profession", 15),
]


class SkipLimitExceeded(RuntimeError):
    """More rows were skipped than a run may skip; their dead letters are stored."""


@dataclass(frozen=True)
class Payload:
    """What one run sends out: ``(group_no, payload)`` with the JSON text of each group."""

    groups: DataFrame


def load_persons(
    spark: SparkSession, csv_path: str, root: str, run_id: int, skip_limit: int | None = None
) -> DataFrame:
    """Step 1: the file's rows with upper-case names, numbered behind the rows already stored.

    A broken line fails the read. With a ``skip_limit`` up to so many of them become dead letters of the READ phase
    instead; they are stored first, and one more fails the run before any row is.

    Each run owns one folder and a range of ids; a repeated run replaces its folder and keeps its range, so that
    marks, snapshots and groups still fit. It is refused if its file has grown into the ids of a later run.
    """
    path = f"{root}/persons"
    stored = read_table(spark, path, f"{PERSONS}, run_id BIGINT")
    mine = F.col("run_id") == run_id
    last, first, own_last = stored.agg(F.max("id"), F.min(F.when(mine, F.col("id"))), F.max(F.when(mine, F.col("id")))).first()
    start = (last or 0) if first is None else first - 1
    if skip_limit is None:
        read = scan_delimited(spark, csv_path, CSV_COLUMNS)
    else:
        read, broken = scan_permissive(spark, csv_path, CSV_COLUMNS)
        skips = read_skips(broken, len(CSV_COLUMNS))
        letters = stable(dead_letter(skips, run_id, F.current_timestamp(), KNOWN_CLASSES))
        store_letters(letters, f"{root}/dead_letter", DEAD_LETTER, run_id)
        if letters.count() > skip_limit:
            raise SkipLimitExceeded(f"run {run_id} has met more than {skip_limit} lines it cannot read")
    rows = upper_names(read)
    out = number_rows(rows, start + 1).select(
        "id",
        "first_name",
        "last_name",
        "profession",
        "email",
        F.lit(False).alias("processed"),
        F.lit(run_id).cast("bigint").alias("run_id"),
    )
    if first is not None and last > own_last:
        out = stable(out)
        if (out.agg(F.max("id")).first()[0] or 0) > own_last:
            raise ValueError(f"run {run_id} has more rows than before, and later runs have the ids behind them")
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id"
    ).parquet(path)
    return read_table(spark, path, f"{PERSONS}, run_id BIGINT")


def open_persons(persons: DataFrame, marks: DataFrame) -> DataFrame:
    """Persons neither flagged nor marked as processed."""
    return persons.filter(~F.col("processed")).join(marks.select("id"), "id", "left_anti")


def snapshot_persons(
    persons: DataFrame,
    lookup: DataFrame,
    root: str,
    date: str,
    run_id: int,
    rules: list[Rule] | None = None,
) -> DataFrame:
    """Step 2: snapshot rows of all open persons, then their marks.

    Only rows of the same date can be there already; the UUID follows from date and person, so a
    repeated run would write the very same row. Persons that break one of ``rules`` are not written: they get a dead
    letter of the WRITE phase, which is stored first, and stay open.
    """
    spark = persons.sparkSession
    require(spark, check_date(text(date)))
    marks_path, path = f"{root}/persons_processed", f"{root}/persons_v2"
    todo = open_persons(persons, read_table(spark, marks_path, MARK))
    if rules:
        todo, refused = split_by_rules(todo, rules)
        skips = write_skips(refused, to_payload_json(F.struct(*CSV_COLUMNS)))
        letters = dead_letter(skips, run_id, F.current_timestamp(), KNOWN_CLASSES)
        store_letters(letters, f"{root}/dead_letter", DEAD_LETTER, run_id)
    rows = snapshot(enrich(todo, lookup), date)
    today = F.col("snapshot_date") == F.lit(date).cast("date")
    same_day = read_table(spark, path, PERSONS_V2).filter(today)
    append_to(insert_if_absent(rows, same_day, "source_id", unique_keys=True), path)
    done = read_table(spark, path, PERSONS_V2).filter(today)
    marks = done.select(F.col("source_id").alias("id"), F.lit(run_id).cast("bigint").alias("run_id"))
    insert_if_absent_into(marks, marks_path, "id", MARK, unique_keys=True)
    return read_table(spark, path, PERSONS_V2)


def dispatch_persons(
    people: DataFrame, accepted: DataFrame, root: str, size: int = DISPATCH_SIZE
) -> Payload:
    """Step 3: members without a group, sent in groups of ``size``.

    Group numbers continue behind the stored ones. Tags of accepted groups are stored before the
    groups, so an interrupted run never sends a member again under another group; groups known
    by their tags only are completed first.
    """
    spark = people.sparkSession
    groups_path, tags_path = f"{root}/dispatched_group", f"{root}/group_member"
    tagged = read_table(spark, tags_path, GROUP_MEMBER)
    _complete_groups(tagged, groups_path)
    start = _next_group(spark, groups_path)
    open_ = stable(
        people.withColumnRenamed("source_id", "id").join(tagged.select("id"), "id", "left_anti")
    )
    renumbered = accepted.withColumn("group_no", F.col("group_no") - F.lit(start))
    groups, tags, payloads = dispatch(open_, renumbered, size)
    number = F.col("group_no") + F.lit(start)
    insert_if_absent_into(
        tags.withColumn("group_no", number), tags_path, "id", GROUP_MEMBER, unique_keys=True
    )
    append_to(_group_rows(groups.withColumn("group_no", number)), groups_path)
    body = to_payload_json(F.struct("items_size", "items"))
    return Payload(payloads.select(number.alias("group_no"), body.alias("payload")))


def _group_rows(groups: DataFrame) -> DataFrame:
    return groups.select(
        "group_no",
        key_uuid(F.lit("group"), F.col("group_no").cast("string")).alias("uuid_v4"),
        "dispatch_status",
        "records_included",
    )


def _next_group(spark: SparkSession, groups_path: str) -> int:
    stored = read_table(spark, groups_path, DISPATCHED_GROUP)
    return stored.agg(F.coalesce(F.max("group_no") + 1, F.lit(0))).first()[0]


def _complete_groups(tagged: DataFrame, groups_path: str) -> None:
    """Store groups whose tags exist but whose own row is missing after a broken run."""
    spark = tagged.sparkSession
    lost = tagged.filter(F.col("group_no") >= _next_group(spark, groups_path))
    if lost.isEmpty():
        return
    sent = lost.groupBy("group_no").agg(F.count("*").alias("records_included"))
    append_to(_group_rows(sent.withColumn("dispatch_status", F.lit("SENT"))), groups_path)


def run_person_etl(
    spark: SparkSession,
    csv_path: str,
    lookup: DataFrame,
    accepted: DataFrame,
    root: str,
    date: str,
    run_id: int,
    skip_limit: int | None = None,
) -> Payload:
    """All three steps; only rows that keep the snapshot table's rules reach it."""
    persons = load_persons(spark, csv_path, root, run_id, skip_limit)
    people = snapshot_persons(persons, lookup, root, date, run_id, PERSON_RULES)
    return dispatch_persons(people, accepted, root)
