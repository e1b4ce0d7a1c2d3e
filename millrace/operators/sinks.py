"""Idempotent writes.

Each sink has a pure form, which returns the rows to write or the resulting table, and a small
writer that stores them. Appends go to a folder of files; a key-replacing table keeps versions, of which the newest
published one counts.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.checks import Rule, first_violation
from millrace.functions.text import root_cause, truncate_message
from millrace.operators.claims import claimed, next_number
from millrace.session import local_path


# ---- stored tables ------------------------------------------------------------------------


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The stored table, or an empty one while nothing has been written yet."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not claimed(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def append_to(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


#: Folders that files of their own are dealt to.
FILE_FOLDERS = 256


def write_files(rows: DataFrame, folder: str, key: str, value: str = "value") -> None:
    """A text file for every ``key`` (an integer, not null), its path ending in ``key=number.txt`` or in a text file below
    ``key=number``; it has a line per row of that key. A key that is written again has its file replaced.

    On local and mounted storage the tasks write the files themselves, each under a name of its own and then renamed: so
    a task that is run again leaves the same files. Spark's writer makes a folder, a file and a checksum there per key,
    and was far slower (figures in the README).
    """
    spark = rows.sparkSession
    base = local_path(spark, folder)
    whole = rows.select(F.pmod(F.hash(key), F.lit(FILE_FOLDERS)).alias("_folder"), key, value)
    tasks = min(FILE_FOLDERS, 2 * spark.sparkContext.defaultParallelism)
    whole = whole.repartition(tasks, "_folder").sortWithinPartitions("_folder", key)
    if base is None:
        by_key = whole.select(key, value).write.partitionBy(key).mode("overwrite")
        by_key.option("partitionOverwriteMode", "dynamic").text(folder)
        return
    os.makedirs(base, exist_ok=True)

    def entries(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns))

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        for (number, id_), same in groupby(entries(batches), lambda row: row[:2]):
            into = f"{base}/folder={number}"
            os.makedirs(into, exist_ok=True)
            name = f"{into}/_{uuid.uuid4().hex}"
            with open(name, "wb") as file:
                file.writelines(f"{text or ''}\n".encode() for *_, text in same)
            os.replace(name, f"{into}/{key}={id_}.txt")
            count += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([count], pa.int64())})

    whole.mapInArrow(write, "files long").agg(F.sum("files")).first()


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _manifest(key: str | list[str], schema: str) -> T.StructType:
    """One row per published version: its number, and smallest and largest value of every key column."""
    kinds = T.StructType.fromDDL(schema)
    bounds = [T.StructField(f"{side}_{name}", kinds[name].dataType) for name in _keys(key) for side in ("low", "high")]
    return T.StructType([T.StructField("version", T.LongType()), *bounds])


def replace_in(df: DataFrame, path: str, key: str | list[str], schema: str) -> None:
    """Replace the rows of ``df``'s keys in a table that is kept as versions.

    A writer claims a number that nobody else gets, writes its rows under it, and they count once the number is
    published beside them with the range of its keys, which is one small file: until then, and if the run is lost
    before, readers see the old rows. So writers at once lose nothing; of a key that two of them replace the row with
    the larger number counts. No stored row is rewritten; ``compact_versions`` does that on its own schedule.
    """
    spark, names = df.sparkSession, T.StructType.fromDDL(schema).names
    published = read_table(spark, f"{path}/published", _manifest(key, schema))
    first = published.agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]
    number = next_number(spark, f"{path}/claims", first)
    rows = f"{path}/rows/version={number}"
    last_per_key(df.select(*names), key).write.parquet(rows)
    bounds = [make(name).alias(f"{side}_{name}") for name in _keys(key) for side, make in (("low", F.min), ("high", F.max))]
    written = spark.read.schema(schema).parquet(rows).agg(*bounds, F.count("*").alias("_n"))
    # Without rows there is nothing to publish.
    row = written.filter("_n > 0").drop("_n").select(F.lit(number).cast("bigint").alias("version"), "*")
    # In a folder of its own: writers at once would share the committer's temporary one.
    append_to(row.coalesce(1), f"{path}/published/writer={number}")


def versions_of(spark: SparkSession, path: str, key: str | list[str], schema: str, within: dict[str, tuple] | None = None) -> list[int]:
    """Published versions that may hold a key within the bounds (column: smallest and largest value), all without."""
    rows = read_table(spark, f"{path}/published", _manifest(key, schema))
    for name, (low, high) in (within or {}).items():
        rows = rows.filter((F.col(f"low_{name}") <= F.lit(high)) & (F.col(f"high_{name}") >= F.lit(low)))
    return sorted({row["version"] for row in rows.select("version").collect()})


def read_versions(
    spark: SparkSession, path: str, key: str | list[str], schema: str, within: dict[str, tuple] | None = None
) -> DataFrame:
    """The newest published row of every key; with ``within`` of the keys in these bounds.

    The manifest has a row per version, which compaction keeps few; only files of versions that may hold a wanted key
    are read.
    """
    keys, names = _keys(key), T.StructType.fromDDL(schema).names
    wanted = versions_of(spark, path, key, schema, within)
    rows = read_table(spark, f"{path}/rows", f"{schema}, version BIGINT").filter(F.col("version").isin(wanted))
    for name, (low, high) in (within or {}).items():
        rows = rows.filter(F.col(name).between(F.lit(low), F.lit(high)))
    newest = F.max(F.struct("version", *[c for c in names if c not in keys])).alias("_newest")
    seen = rows.groupBy(*keys).agg(newest)
    return seen.select(*[F.col(c) if c in keys else F.col("_newest").getField(c).alias(c) for c in names])


def compact_versions(spark: SparkSession, path: str, key: str | list[str], schema: str, target: str) -> None:
    """Write the newest rows to a new table at ``target`` as its only version; the old one stays as it is."""
    replace_in(read_versions(spark, path, key, schema), target, key, schema)


# ---- append and insert --------------------------------------------------------------------


def append(df: DataFrame, target: DataFrame, defaults: dict[str, Column] | None = None) -> DataFrame:
    """The target with the rows added; ``defaults`` fill columns the rows do not bring."""
    given = set(df.columns)
    extra = {name: col for name, col in (defaults or {}).items() if name not in given}
    rows = df.withColumns(extra) if extra else df
    return target.unionByName(rows, allowMissingColumns=True)


def first_per_key(df: DataFrame, key: str, order: list[str] | None = None) -> DataFrame:
    """One row per key, the first in ``order`` with all columns as tie-break.

    A key repeated over a third of the input shrinks to one row per task before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    lead = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order or [])]
    pick = F.min(F.struct(*lead, *[F.col(c) for c in rest])).alias("_first")
    return (
        df.groupBy(key)
        .agg(pick)
        .select(*[F.col(c) if c == key else F.col("_first").getField(c).alias(c) for c in df.columns])
    )


def last_per_key(df: DataFrame, key: str | list[str]) -> DataFrame:
    """One row per key, the largest by all other columns."""
    keys = _keys(key)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_last"))
    return kept.select(*[F.col(c) if c in keys else F.col("_last").getField(c).alias(c) for c in df.columns])


def insert_if_absent(
    df: DataFrame,
    target: DataFrame,
    key: str,
    order: list[str] | None = None,
    unique_keys: bool = False,
) -> DataFrame:
    """The rows of ``df`` to add: keys not in the target, the first row of each repeated key.

    The anti join comes first, so that only new keys are reduced. ``unique_keys`` states that the input holds no key
    twice and saves the aggregate.
    """
    fresh = df.join(target.select(key), key, "left_anti").select(*df.columns)
    return fresh if unique_keys else first_per_key(fresh, key, order)


def near(target: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """The target rows within the key range of ``df``, the only ones its keys can meet.

    Two scalars are read first, so that the range reaches the file scan of the target as literals: a
    run over new ids does not read all that was stored before.
    """
    low, high = df.agg(F.min(key), F.max(key)).first()
    return target.filter(F.col(key).between(low, high) if low is not None else F.lit(False))


def insert_if_absent_into(
    df: DataFrame,
    path: str,
    key: str,
    schema: str,
    order: list[str] | None = None,
    unique_keys: bool = False,
    clustered: bool = False,
) -> None:
    """Append what is absent. Running it again, also after a broken run, adds nothing twice.

    Set ``clustered`` when the new keys lie close together compared with the stored ones.
    """
    stored = read_table(df.sparkSession, path, schema)
    if clustered:
        stored = near(stored, df, key)
    append_to(insert_if_absent(df, stored, key, order, unique_keys), path)


def seed_if_empty(seed: DataFrame, target: DataFrame) -> DataFrame:
    """The seed rows if the target has no row at all, otherwise none."""
    return seed.where(~target.exists())


# ---- replace and update -------------------------------------------------------------------


def replace_by_key(df: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The target without the rows of ``df``'s keys, plus one row of ``df`` for each of its keys."""
    return target.join(df.select(key), key, "left_anti").unionByName(last_per_key(df, key))


def mark_processed(target: DataFrame, ids: DataFrame, key: str = "id", guard: bool = True) -> DataFrame:
    """The target with ``processed`` set for the ids; ``changed`` tells which rows were touched.

    With the guard a row that is processed already is left alone and does not count as changed.
    """
    named = ids.select(key).distinct().withColumn("_named", F.lit(True))
    hit = F.col("_named").isNotNull()
    return (
        target.join(named, key, "left")
        .withColumn("changed", hit & ~F.col("processed") if guard else hit)
        .withColumn("processed", F.col("processed") | hit)
        .drop("_named")
        .select(*target.columns, "changed")
    )


def tag_members(
    target: DataFrame, tags: DataFrame, stamp: Column, key: str = "id", group: str = "group_no"
) -> DataFrame:
    """The target with the group of ``tags`` set and ``updated_at`` refreshed on tagged rows."""
    new = tags.select(key, F.col(group).alias("_group"))
    hit = F.col("_group").isNotNull()
    return (
        target.join(new, key, "left")
        .withColumns(
            {
                group: F.coalesce("_group", group),
                "updated_at": F.when(hit, stamp).otherwise(F.col("updated_at")),
            }
        )
        .select(*target.columns)
    )


def reset_tables(tables: dict[str, DataFrame], production: bool = False) -> dict[str, DataFrame]:
    """Each table emptied, schema kept; refused in production."""
    if production:
        raise PermissionError("tables cannot be reset in production")
    return {name: df.limit(0) for name, df in tables.items()}


# ---- failure records ----------------------------------------------------------------------


def dead_letter(skips: DataFrame, run_id: int, recorded_at: Column, known: list[str]) -> DataFrame:
    """One record per skipped row. Store it with its own append before the main output, so that a
    failure of that output cannot take the records back."""
    cause = root_cause(
        F.col("exception_class"),
        F.col("exception_msg"),
        F.col("cause_class"),
        F.col("cause_msg"),
        known,
    )
    return skips.withColumn("_cause", cause).select(
        F.col("id").alias("source_id"),
        F.col("payload").alias("raw_payload"),
        F.col("phase").alias("failure_phase"),
        F.col("outcome").alias("failure_type"),
        F.col("_cause.exception_class").alias("exception_class"),
        truncate_message(F.col("_cause.exception_msg")).alias("exception_msg"),
        F.col("attempt_count").cast("int").alias("attempt_count"),
        F.lit(run_id).cast("bigint").alias("job_execution_id"),
        recorded_at.cast("timestamp_ntz").alias("recorded_at"),
    )


def split_by_rules(df: DataFrame, rules: list[Rule], name: str = "rule") -> tuple[DataFrame, DataFrame]:
    """``(taken, refused)``: rows that keep all row rules, and the others with the first one they break as ``name``."""
    judged = df.withColumn(name, first_violation(rules))
    return judged.filter(F.col(name).isNull()).select(*df.columns), judged.filter(F.col(name).isNotNull())


def store_letters(letters: DataFrame, path: str, schema: str, run_id: int) -> None:
    """Append dead letters of a run once: a repeated attempt leaves out those it finds of its own number.

    Letters are told apart by phase, source id and payload; of lines without an id the payload is all there is, so a
    repeated attempt adds none of a line it finds stored.
    """
    mine = read_table(letters.sparkSession, path, schema).filter(F.col("job_execution_id") == run_id)
    names = ["failure_phase", "source_id", "raw_payload"]
    known = mine.select(*[F.col(name).alias(f"_{name}") for name in names]).distinct()
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in names]
    append_to(letters.join(known, same, "left_anti"), path)


def write_expecting(
    df: DataFrame, target: DataFrame, registry: DataFrame, key: str, target_key: str | None = None
) -> DataFrame:
    """``df`` if each of its keys names exactly one target row and is new to the registry.

    Anything else fails the query. Only the target's and the registry's rows of ``df``'s keys are counted, all three
    by one aggregate.
    """
    target_key = target_key or key
    keys = df.select(key)

    def tagged(rows: DataFrame, tag: str) -> DataFrame:
        return rows.select(F.col(key), *[F.lit(int(tag == t)).alias(t) for t in ("_given", "_found", "_known")])

    found = target.select(F.col(target_key).alias(key)).join(keys, key, "left_semi")
    known = registry.select(key).join(keys, key, "left_semi")
    every = tagged(keys, "_given").unionByName(tagged(found, "_found")).unionByName(tagged(known, "_known"))
    counts = every.groupBy(key).agg(*[F.sum(t).alias(t) for t in ("_given", "_found", "_known")])
    ok = (
        F.when(F.col("_found") != 1, _fail("rows of the target to mark, 1 expected, for ", key, F.col("_found")))
        .when((F.col("_known") > 0) | (F.col("_given") != 1), _fail("new rows to insert, 1 expected, for ", key, F.col("_given")))
        .otherwise(F.lit(True))
    )
    return df.join(counts, key).filter(ok).select(*df.columns)


def _fail(text: str, key: str, n: Column) -> Column:
    return F.raise_error(
        F.concat(F.lit(f"{text}{key}="), F.col(key).cast("string"), F.lit(": "), n.cast("string"))
    ).cast("boolean")
