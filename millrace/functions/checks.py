"""Predicates and row validation. Every check is a column: NULL when fine, else the reason."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import is_blank, strip_edges
from millrace.functions.tokens import MIN_SECRET_BYTES

# Archive magic bytes, safe path component, qualified class name.
ZIP_MAGIC = bytes([0x50, 0x4B, 0x03, 0x04])
SAFE_NAME = r"[a-zA-Z0-9._\-]+"
QUALIFIED_CLASS = r"([a-zA-Z_$][a-zA-Z0-9_$]*\.)+[a-zA-Z_$][a-zA-Z0-9_$]*"

# The reasons reported; most are followed by the value refused.
DATE_MISSING = "{} parameter is required"
DATE_INVALID = "{} must be a valid date in yyyy-MM-dd format, got: "
LONG_MISSING = "{} is required"
LONG_INVALID = "{} must be a numeric value, got: "
LONG_NOT_POSITIVE = "{} must be a positive long, got: "
OPTIONAL_LONG_INVALID = "{} must be a number: "
SECRET_MISSING = "{} is required and must not be blank"
SECRET_SHORT = "{} must be at least {} bytes for HMAC-SHA256 strength"
FIXED_VALUE = "{} is fixed at {} and cannot be overridden, got: "
UNSAFE_KEY = "Illegal storage key (path traversal): "
WRONG_EXTENSION = "File must have .jar extension; received: "
EMPTY_FILE = "File is empty — cannot read magic bytes"
WRONG_MAGIC = "File is not a valid JAR — missing ZIP/PK magic bytes. Expected 0x504B0304, got: "
CLASS_MISSING = "mainClassName must not be blank"
CLASS_INVALID = "mainClassName must be a fully-qualified Java class name (e.g. com.example.MyClass): "
NAME_MISSING = "Job name and version must not be blank"
NAME_TAKEN = ("A job definition with name '", "' already exists")
NAME_UNSAFE = "Job name and version must contain only alphanumeric, dot, dash, or underscore: "


# ---- filters ------------------------------------------------------------------------------


def unprocessed(df: DataFrame, event_id: str | int | None = None) -> DataFrame:
    """Rows not yet processed, of one event if a non-blank event id is given."""
    out = df.filter(~F.col("processed"))
    if event_id is not None and str(event_id).strip():
        out = out.filter(F.col("event_id") == int(str(event_id).strip()))
    return out


def in_ids(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is among ``ids``; a semi join, so the id set may be of any size.

    Repeated ids shrink to one per task before the shuffle.
    """
    return df.join(ids.select(key).distinct(), key, "left_semi")


def worker_steps(df: DataFrame, prefix: str, status: str = "COMPLETED") -> DataFrame:
    """Step executions of one worker family with the given status."""
    return df.filter(F.col("step_name").startswith(prefix) & (F.col("status") == status))


# ---- parameter checks ---------------------------------------------------------------------


def as_date(col: Column) -> Column:
    """Strict ``yyyy-MM-dd`` after trimming, else NULL."""
    text = strip_edges(col)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def as_long(col: Column) -> Column:
    """A signed 64-bit decimal number after trimming, else NULL."""
    text = strip_edges(col)
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))


def check_date(col: Column, name: str = "DATE") -> Column:
    return F.when(is_blank(col), F.lit(DATE_MISSING.format(name))).when(
        as_date(col).isNull(),
        F.concat(F.lit(DATE_INVALID.format(name)), col),
    )


def check_positive_long(col: Column, name: str = "EVENT_ID") -> Column:
    number = as_long(col)
    return (
        F.when(is_blank(col), F.lit(LONG_MISSING.format(name)))
        .when(number.isNull(), F.concat(F.lit(LONG_INVALID.format(name)), col))
        .when(
            number <= 0,
            F.concat(F.lit(LONG_NOT_POSITIVE.format(name)), number.cast("string")),
        )
    )


def check_optional_long(col: Column, name: str = "EVENT_ID") -> Column:
    """Absent or blank is fine; anything else must be a number."""
    return F.when(
        ~is_blank(col) & as_long(col).isNull(), F.concat(F.lit(OPTIONAL_LONG_INVALID.format(name)), col)
    )


def check_min_bytes(col: Column, size: int = MIN_SECRET_BYTES, name: str = "TOKEN_SECRET") -> Column:
    """Not blank and at least ``size`` UTF-8 bytes; the value itself is not reported."""
    return F.when(is_blank(col), F.lit(SECRET_MISSING.format(name))).when(
        F.octet_length(F.encode(col, "UTF-8")) < size,
        F.lit(SECRET_SHORT.format(name, size)),
    )


def check_fixed(col: Column, expected: int, name: str) -> Column:
    """Absent is fine; a different value cannot take effect and is refused."""
    return F.when(
        col.isNotNull() & (col != expected),
        F.concat(F.lit(FIXED_VALUE.format(name, expected)), col.cast("string")),
    )


def check_path_safe(key: Column) -> Column:
    """A storage key must be relative and must not step above its base at any point."""
    depth = F.aggregate(
        F.split(key, "/"),
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("low")),
        lambda acc, part: _step(acc, part),
    )
    bad = key.startswith("/") | (depth.getField("low") < 0)
    return F.when(key.isNull(), F.lit(UNSAFE_KEY + "null")).when(bad, F.concat(F.lit(UNSAFE_KEY), key))


def _step(acc: Column, part: Column) -> Column:
    move = F.when(part == "..", -1).when((part == "") | (part == "."), 0).otherwise(1)
    at = acc.getField("at") + move
    return F.struct(at.alias("at"), F.least(acc.getField("low"), at).alias("low"))


def _whole(pattern: str) -> str:
    """The pattern must cover the whole text, line ends included."""
    return rf"\A(?:{pattern})\z"


def check_upload(
    file_name: Column, content: Column, job_name: Column, version: Column, class_name: Column
) -> Column:
    """The first reason why an uploaded archive is refused, NULL when it is accepted."""
    head = F.substring(content, 1, len(ZIP_MAGIC))
    reasons = [
        F.when(
            file_name.isNull() | ~F.lower(file_name).endswith(".jar"),
            F.concat(F.lit(WRONG_EXTENSION), F.coalesce(file_name, F.lit("null"))),
        ),
        F.when(F.coalesce(F.octet_length(content), F.lit(0)) == 0, F.lit(EMPTY_FILE)),
        F.when(head != F.lit(ZIP_MAGIC), F.concat(F.lit(WRONG_MAGIC), F.lower(F.hex(head)))),
        F.when(is_blank(class_name), F.lit(CLASS_MISSING)),
        F.when(
            ~class_name.rlike(_whole(QUALIFIED_CLASS)), F.concat(F.lit(CLASS_INVALID), class_name)
        ),
    ]
    for part in (job_name, version):
        reasons.append(F.when(is_blank(part), F.lit(NAME_MISSING)))
        reasons.append(
            F.when(~part.rlike(_whole(SAFE_NAME)), F.concat(F.lit(NAME_UNSAFE), part))
        )
    return F.coalesce(*reasons)


def check_uploads(uploads: DataFrame, definitions: DataFrame) -> DataFrame:
    """``uploads`` with the ``reason`` why each is refused, NULL when it is accepted.

    After the checks of the archive itself a job name must be new: not among the stored ``definitions``, and of several
    uploads of a name that pass so far only the first one by ``upload_id`` is taken. Names are looked up by one
    aggregate over both tables.
    """
    parts = [F.col(name) for name in ("file_name", "content", "job_name", "version", "class_name")]
    judged = uploads.withColumn("_own", check_upload(*parts))
    none = F.lit(None).cast(uploads.schema["upload_id"].dataType)
    fine = judged.filter(F.col("_own").isNull()).select("job_name", "upload_id", F.lit(False).alias("_stored"))
    named = fine.unionByName(definitions.select("job_name", none.alias("upload_id"), F.lit(True).alias("_stored")))
    names = named.groupBy("job_name").agg(F.min("upload_id").alias("_first"), F.max("_stored").alias("_stored"))
    taken = F.col("_own").isNull() & (F.col("_stored") | (F.col("upload_id") > F.col("_first")))
    repeated = F.when(taken, F.concat(F.lit(NAME_TAKEN[0]), F.col("job_name"), F.lit(NAME_TAKEN[1])))
    return judged.join(names, "job_name", "left").select(*uploads.columns, F.coalesce("_own", repeated).alias("reason"))


# ---- table constraints --------------------------------------------------------------------


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class MaxLength:
    column: str
    length: int


@dataclass(frozen=True)
class AtLeast:
    column: str
    minimum: int


@dataclass(frozen=True)
class Unique:
    column: str


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: DataFrame
    parent_column: str


Rule = NotNull | MaxLength | AtLeast | Unique | ForeignKey


def _row_rule(rule: Rule) -> tuple[str, Column] | None:
    """Name and condition of a rule that one row can break by itself."""
    col = F.col(rule.column)
    match rule:
        case NotNull():
            return f"not_null({rule.column})", col.isNull()
        case MaxLength():
            return f"max_length({rule.column})", F.length(col) > rule.length
        case AtLeast():
            return f"at_least({rule.column})", col < rule.minimum
    return None


def first_violation(rules: list[Rule]) -> Column:
    """Name of the first row rule a row breaks, in the order given; NULL when it breaks none."""
    found = [F.lit(None).cast("string")]
    for rule in rules:
        named = _row_rule(rule)
        if named is None:
            raise ValueError(f"no rule for one row: {type(rule).__name__}({rule.column})")
        found.append(F.when(named[1], F.lit(named[0])))
    return F.coalesce(*found)


def check_constraints(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(rule, violations)`` for every rule, by one scan of the table, one of each parent, and one exchange.

    A row becomes one entry per key column of its UNIQUE and FOREIGN KEY rules, a parent row one entry per rule that
    names it; entries are counted by column and key, on the map side first, so a key held by a third of all rows costs
    one row per task. Row rules are counted along on the first entry. Keys meet as text, a parent's after the cast to
    the type of the column that refers to it.
    """
    named = [(rule, _row_rule(rule)) for rule in rules]
    row_rules = [found for _, found in named if found]
    columns = list(dict.fromkeys(rule.column for rule, found in named if found is None))
    parents = [rule for rule in rules if isinstance(rule, ForeignKey)]
    counted = [f"_r{i}" for i in range(len(row_rules))]
    held = [f"_p{i}" for i in range(len(parents))]

    def entry(number: int, key: Column) -> Column:
        flags = [
            F.when(bad, 1).otherwise(0).cast("bigint").alias(name) if number == 0 else F.lit(0).cast("bigint").alias(name)
            for name, (_, bad) in zip(counted, row_rules)
        ]
        return F.struct(F.lit(number).alias("_column"), key.alias("_key"), F.lit(1).cast("bigint").alias("_n"), *flags)

    # Without key rules one entry a row carries the row rules.
    keys = [F.col(column).cast("string") for column in columns] or [F.lit(None).cast("string")]
    stacked = df.select(F.explode(F.array(*[entry(i, key) for i, key in enumerate(keys)])).alias("_e")).select("_e.*")
    zeros = {name: F.lit(0).cast("bigint") for name in held}
    every = stacked.withColumns(zeros) if held else stacked
    for i, rule in enumerate(parents):
        key = F.col(rule.parent_column).cast(df.schema[rule.column].dataType).cast("string")
        marks = {name: F.lit(int(name == held[i])).cast("bigint") for name in held}
        nothing = {name: F.lit(0).cast("bigint") for name in counted}
        number = F.lit(columns.index(rule.column))
        rows = rule.parent.select(number.alias("_column"), key.alias("_key"), F.lit(0).cast("bigint").alias("_n"))
        every = every.unionByName(rows.withColumns({**nothing, **marks}))
    per_key = every.groupBy("_column", "_key").agg(*[F.sum(c).alias(c) for c in ("_n", *counted, *held)])

    def total(col: Column) -> Column:
        return F.coalesce(F.sum(col), F.lit(0)).cast("bigint")

    def of(column: str) -> Column:
        return (F.col("_column") == columns.index(column)) & F.col("_key").isNotNull() & (F.col("_n") > 0)

    names, sums, rows_left, parents_left = [], [], iter(counted), iter(held)
    for rule, found in named:
        if found:
            names.append(found[0])
            sums.append(total(F.col(next(rows_left))))
        elif isinstance(rule, Unique):
            names.append(f"unique({rule.column})")
            sums.append(F.count_if(of(rule.column) & (F.col("_n") > 1)))
        else:
            names.append(f"foreign_key({rule.column})")
            sums.append(total(F.when(of(rule.column) & (F.col(next(parents_left)) == 0), F.col("_n"))))
    counts = per_key.agg(*[value.alias(f"_v{i}") for i, value in enumerate(sums)])
    pairs = [F.struct(F.lit(name).alias("rule"), F.col(f"_v{i}").alias("violations")) for i, name in enumerate(names)]
    return counts.select(F.explode(F.array(*pairs)).alias("_e")).select("_e.*")
