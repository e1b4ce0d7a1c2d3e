"""Classification, retry, skip limit, committed prefix, restart and dispatch.

A run is defined in key order: rows are committed in chunks, a skip beyond the limit or an abort
fails the run, and the chunk it happens in is rolled back. None of this needs the rows in order in
one place: the failing row comes from a top-k or a minimum, its position from a count, and the start
of its chunk from the few largest keys below it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.money import rate_exact, rate_or_null
from millrace.functions.text import fill, payload_item
from millrace.operators.intervals import Interval, inside, rows_of
from millrace.operators.ordering import ROWS_PER_BUCKET, Bounds, assign_chunk, assign_id_range
from millrace.session import stable

# Exception names as they appear in stored records.
POISON_CLASS = "PoisonItemException"
TRANSIENT_CLASS = "TransientProcessingException"
ABORT_CLASS = "AbortJobException"
KNOWN_CLASSES = [POISON_CLASS, TRANSIENT_CLASS, ABORT_CLASS]

# Names and messages of skips outside processing: a line that cannot be read, a row that the target refuses.
MALFORMED_CLASS = "MalformedLineException"
REFUSED_CLASS = "ConstraintViolationException"
MALFORMED_MESSAGE = "Line has {found} fields, {expected} expected"
REFUSED_MESSAGE = "Row breaks {rule}"

# Messages as they appear in stored records, around the id of the row.
POISON_MESSAGE = "Poison item detected for harvest_source.id={id}"
TRANSIENT_MESSAGE = (
    "Transient failure for harvest_source.id={id} retryCount={retries} threshold={threshold}"
)
ABORT_MESSAGE = "Abort triggered by harvest_source.id={id} (abort_flag=TRUE)"

# Settings of the fault-tolerant job.
CHUNK_SIZE = 5
SKIP_LIMIT = 5
RETRY_LIMIT = 3
DISPATCH_SIZE = 32

#: Keys of a slice of an id range, as a power of two: what one task ranks.
SLICE_BITS = 16

OK, ABORT, SKIP, EXHAUSTED = "OK", "ABORT", "SKIP", "RETRY_EXHAUSTED"


# ---- classification and retry -------------------------------------------------------------


def classify(df: DataFrame) -> DataFrame:
    """``fault`` of each row: abort before poison before transient before none."""
    return df.withColumn(
        "fault",
        F.when(F.col("abort_flag"), "ABORT")
        .when(F.col("poison_flag"), "POISON")
        .when(F.col("transient_fail_until_attempt") > 0, "TRANSIENT")
        .otherwise("NONE"),
    )


def retry_outcome(df: DataFrame, retry_limit: int = RETRY_LIMIT) -> DataFrame:
    """What becomes of a classified row: ``outcome``, real ``calls`` and stored ``attempt_count``.

    A transient row succeeds on the call after its threshold if the limit allows that many calls.
    The record of an exhausted row counts one attempt more than the limit.
    """
    threshold = F.col("transient_fail_until_attempt")
    transient = F.col("fault") == "TRANSIENT"
    exhausted = transient & (threshold >= retry_limit)
    return df.withColumns(
        {
            "outcome": F.when(F.col("fault") == "ABORT", ABORT)
            .when(F.col("fault") == "POISON", SKIP)
            .when(exhausted, EXHAUSTED)
            .otherwise(OK),
            "calls": F.when(transient, F.least(threshold + 1, F.lit(retry_limit))).otherwise(1),
            "attempt_count": F.when(exhausted, retry_limit + 1)
            .when(transient, threshold + 1)
            .otherwise(1),
        }
    )


def failing_rows(df: DataFrame, retry_limit: int = RETRY_LIMIT) -> DataFrame:
    """The rows that are not OK.

    The outcome follows from the flags; repeating them as a plain condition lets the file scan skip
    row groups without any failing row.
    """
    may_fail = (
        F.col("abort_flag")
        | F.col("poison_flag")
        | (F.col("transient_fail_until_attempt") >= retry_limit)
    )
    return df.filter(may_fail & (F.col("outcome") != OK))


def describe_failure(df: DataFrame, retry_limit: int = RETRY_LIMIT) -> DataFrame:
    """Adds phase, exception class and message of failed rows; NULL for good ones."""
    outcome = F.col("outcome")
    values = {
        "id": F.col("id"),
        "retries": F.lit(retry_limit - 1),
        "threshold": F.col("transient_fail_until_attempt"),
    }
    return df.withColumns(
        {
            "phase": F.when(outcome != OK, "PROCESS"),
            "exception_class": F.when(outcome == SKIP, POISON_CLASS)
            .when(outcome == EXHAUSTED, TRANSIENT_CLASS)
            .when(outcome == ABORT, ABORT_CLASS),
            "exception_msg": F.when(outcome == SKIP, fill(POISON_MESSAGE, values))
            .when(outcome == EXHAUSTED, fill(TRANSIENT_MESSAGE, values))
            .when(outcome == ABORT, fill(ABORT_MESSAGE, values)),
            "cause_class": F.lit(None).cast("string"),
            "cause_msg": F.lit(None).cast("string"),
        }
    )


def read_skips(broken: DataFrame, expected: int) -> DataFrame:
    """Skips of lines that could not be read, ``(line, n_fields)``: there is no row, so no id; the line is the payload."""
    text = fill(MALFORMED_MESSAGE, {"found": F.col("n_fields"), "expected": F.lit(expected)})
    return _skips(broken, F.lit(None).cast("bigint"), F.col("line"), "READ", MALFORMED_CLASS, text)


def write_skips(refused: DataFrame, payload: Column, key: str = "id", rule: str = "rule") -> DataFrame:
    """Skips of rows the target refuses; ``rule`` names what they break."""
    text = fill(REFUSED_MESSAGE, {"rule": F.col(rule)})
    return _skips(refused, F.col(key).cast("bigint"), payload, "WRITE", REFUSED_CLASS, text)


def _skips(df: DataFrame, key: Column, payload: Column, phase: str, class_name: str, message: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    return df.select(
        key.alias("id"),
        payload.alias("payload"),
        F.lit(phase).alias("phase"),
        F.lit(SKIP).alias("outcome"),
        F.lit(class_name).alias("exception_class"),
        message.alias("exception_msg"),
        none.alias("cause_class"),
        none.alias("cause_msg"),
        F.lit(1).alias("attempt_count"),
    )


# ---- cut and committed prefix -------------------------------------------------------------


def skip_limit_cut(df: DataFrame, limit: int = SKIP_LIMIT, key: str = "id") -> DataFrame:
    """One row ``cut``: the key of skip number ``limit + 1``, NULL if the limit holds. Every task hands on its first
    ``limit + 1`` skips."""
    skips = df.filter(F.col("outcome").isin(SKIP, EXHAUSTED)).select(key)
    first = skips.orderBy(key).limit(limit + 1)
    return first.agg(F.when(F.count("*") > limit, F.max(key)).alias("cut"))


@dataclass(frozen=True)
class RunCut:
    """How far a run got. ``cut`` is the failing key, ``boundary`` the first key not committed;
    both None if the run completes."""

    status: str
    reason: str | None
    cut: int | None
    boundary: int | None

    def committed(self, df: DataFrame, key: str = "id") -> DataFrame:
        return df if self.boundary is None else df.filter(F.col(key) < self.boundary)

    def reached(self, df: DataFrame, key: str = "id") -> DataFrame:
        """Rows the run dealt with before it failed, the rolled-back ones included."""
        return df if self.cut is None else df.filter(F.col(key) < self.cut)


def commit_boundary(df: DataFrame, cut: int, chunk: int, key: str = "id") -> int:
    """First key of the chunk that holds ``cut``, by one pass: the rows below it are counted while the last
    ``chunk - 1`` of them are found."""
    met = Observation()
    below = df.filter(F.col(key) < cut).select(key).observe(met, F.count("*").alias("rows"))
    last = [row[0] for row in below.orderBy(F.desc(key)).limit(max(chunk - 1, 1)).collect()]
    rolled_back = met.get["rows"] % chunk
    return last[rolled_back - 1] if rolled_back else cut


def first_failure(failing: DataFrame, limit: int = SKIP_LIMIT, key: str = "id") -> tuple[str, int] | None:
    """Why and at which key a run over rows that are not OK ends, None if it does not.

    The first ``limit + 1`` of them decide: an abort among them comes before the limit is passed, and without one the
    last of them passes it. Every task hands on its first ``limit + 1`` rows.
    """
    first = failing.select(key, "outcome").orderBy(key).limit(limit + 1)
    abort, found, last = first.agg(
        F.min(F.when(F.col("outcome") == ABORT, F.col(key))), F.count("*"), F.max(key)
    ).first()
    if abort is not None:
        return "ABORT", abort
    return ("SKIP_LIMIT", last) if found > limit else None


def run_cut(
    df: DataFrame,
    limit: int = SKIP_LIMIT,
    chunk: int = CHUNK_SIZE,
    key: str = "id",
    failing: DataFrame | None = None,
) -> RunCut:
    """Where a run over classified rows ends. Only scalars and one chunk's keys leave the executors.

    ``failing`` are the rows that are not OK where the caller can select them more cheaply.
    """
    if failing is None:
        failing = df.filter(F.col("outcome") != OK)
    end = first_failure(failing, limit, key)
    if end is None:
        return RunCut("COMPLETED", None, None, None)
    reason, cut = end
    return RunCut("FAILED", reason, cut, commit_boundary(df, cut, chunk, key))


def resume(df: DataFrame, checkpoints: DataFrame, identity: str, key: str = "id") -> DataFrame:
    """Rows behind the last committed key of this identity; a new identity starts at the front.

    The key is a scalar subquery, so the file scan skips what is committed already.
    """
    front = F.lit(-(1 << 63))
    mine = checkpoints.filter(F.col("identity") == identity)
    start = mine.agg(F.coalesce(F.max("last_id") + 1, front)).scalar()
    return df.filter(F.col(key) >= start)


# ---- partitioned runs ---------------------------------------------------------------------


def range_outcomes(
    df: DataFrame,
    bad: Column,
    chunk: int,
    key: str = "id",
    range_: str = "range_no",
    slice_bits: int = SLICE_BITS,
) -> DataFrame:
    """Per id range ``(range_no, read_rows, first_bad, boundary, status)``.

    A failing range keeps the chunks before its first bad row. The first read counts the rows of every range and slice
    of ``2 ** slice_bits`` keys. These counts say how many rows lie before the slice of the first bad row, so the second
    read takes only that slice, and before it as many as it takes to hold ``chunk - 1`` rows; they alone are ranked.
    """
    at = F.shiftright(F.col(key), slice_bits)
    counts = stable(
        df.groupBy(range_, at.alias("_slice")).agg(
            F.count("*").alias("_n"), F.min(F.when(bad, F.col(key))).alias("first_bad")
        )
    )
    firsts = counts.groupBy(range_).agg(F.sum("_n").alias("read_rows"), F.min("first_bad").alias("first_bad"))
    failed = firsts.filter("first_bad IS NOT NULL").select(
        range_, "first_bad", F.shiftright("first_bad", slice_bits).alias("_last")
    )
    # One row per range, here and below: the number of ranges is a setting of the run, never of the data.
    earlier = counts.drop("first_bad").join(F.broadcast(failed), range_).filter(F.col("_slice") < F.col("_last"))
    before = earlier.groupBy(range_).agg(F.sum("_n").alias("_before"))
    newest = W.partitionBy(range_).orderBy(F.desc("_slice"))
    nearer = F.coalesce(F.sum("_n").over(newest.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    near = (
        earlier.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= max(chunk - 1, 1))
        .withColumn("_nearer", nearer)
        .filter(F.col("_nearer") < chunk - 1)
        .groupBy(range_)
        .agg(F.min("_slice").alias("_from"), F.sum("_n").alias("_near"))
    )
    windows = (
        failed.join(before, range_, "left")
        .join(near, range_, "left")
        .select(
            range_,
            F.col("first_bad").alias("_bad"),
            F.shiftleft(F.coalesce("_from", "_last"), slice_bits).alias("_low"),
            (F.coalesce("_before", F.lit(0)) - F.coalesce("_near", F.lit(0))).alias("_skipped"),
        )
        .collect()
    )
    if not windows:
        none = F.lit(None).cast(df.schema[key].dataType)
        return firsts.select(range_, "read_rows", "first_bad", none.alias("boundary"), F.lit("COMPLETED").alias("status"))
    fields = [df.schema[range_], *[T.StructField(name, T.LongType()) for name in ("_bad", "_low", "_skipped")]]
    listed = df.sparkSession.createDataFrame(windows, T.StructType(fields))
    rows = (
        df.filter(inside(key, [Interval(row["_low"], row["_bad"] - 1) for row in windows]))
        .select(range_, key)
        .join(F.broadcast(listed), range_)
        .filter((F.col(key) >= F.col("_low")) & (F.col(key) < F.col("_bad")))
    )
    group = W.partitionBy(range_)
    tail = (
        rows.withColumns({"_rank": F.row_number().over(group.orderBy(F.desc(key))), "_n": F.count("*").over(group)})
        .filter(F.col("_rank") == (F.col("_skipped") + F.col("_n")) % chunk)
        .select(range_, F.col(key).alias("_start"))
    )
    return firsts.join(F.broadcast(tail), range_, "left").select(
        range_,
        "read_rows",
        "first_bad",
        F.coalesce("_start", "first_bad").alias("boundary"),
        F.when(F.col("first_bad").isNull(), "COMPLETED").otherwise("FAILED").alias("status"),
    )


def committed_rows(
    df: DataFrame, outcomes: DataFrame, key: str = "id", range_: str = "range_no"
) -> DataFrame:
    """Rows of all ranges that lie before their range's boundary."""
    limits = F.broadcast(outcomes.select(range_, "boundary"))
    return (
        df.join(limits, range_)
        .filter(F.col("boundary").isNull() | (F.col(key) < F.col("boundary")))
        .drop("boundary")
    )


def isolate_partitions(
    usage: DataFrame, n: int, chunk: int, bounds: Bounds | None = None
) -> tuple[DataFrame, DataFrame]:
    """Committed charges and range outcomes of a partitioned billing run.

    A row whose product overflows fails its range only.
    """
    rated = assign_id_range(usage, "id", n, bounds)
    cost = rate_or_null(F.col("units"), F.col("rate"))
    outcomes = range_outcomes(rated, cost.isNull(), chunk)
    charges = committed_rows(rated, outcomes).select(
        F.col("id").alias("source_id"),
        "subscriber_id",
        "units",
        "rate",
        rate_exact(F.col("units"), F.col("rate")).alias("cost"),
        "range_no",
    )
    return charges, outcomes


def unfinished_ranges(ledger: DataFrame) -> DataFrame:
    """Latest state of each range of a run, those COMPLETED left out."""
    latest = ledger.groupBy("range_no").agg(
        F.max_by(F.struct("min_id", "max_id", "status"), "run_id").alias("s")
    )
    return latest.select("range_no", "s.*").filter(F.col("status") != "COMPLETED")


def restart_partitions(df: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """Rows of the ranges still to do, by the **saved** bounds, with their range number.

    The ledger holds one row per range and run, a number set by the job's grid, so reading the open ranges is bounded.
    They become the file filter, which prunes finished ranges, and a row finds its range by bins of keys.
    """
    todo = unfinished_ranges(ledger).collect()
    intervals = [Interval(row["min_id"], row["max_id"], (row["range_no"],)) for row in todo]
    return rows_of(df, intervals, [T.StructField("range_no", T.IntegerType())], key)


# ---- dispatch and recovery ----------------------------------------------------------------


def dispatch(
    members: DataFrame,
    accepted: DataFrame,
    size: int = DISPATCH_SIZE,
    key: str = "id",
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members in key order cut into groups of ``size``: ``(groups, tags, payloads)``.

    ``accepted`` has ``group_no`` and a boolean. A refused group is kept as ERROR with no records
    and its members stay untagged.
    """
    chunked = assign_chunk(members, key, size, name="group_no", rows_per_bucket=rows_per_bucket)
    answer = accepted.select("group_no", F.col("accepted").alias("_yes"))
    ordered = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), payload_item().alias("v"))))
    payloads = chunked.groupBy("group_no").agg(
        F.count("*").cast("int").alias("items_size"),
        F.transform(ordered, lambda e: e.getField("v")).alias("items"),
    )
    # All groups but the last are full, so their sizes follow from the number of members.
    n = members.count()
    number = F.col("id").alias("group_no")
    filled = F.least(F.lit(size), F.lit(n) - F.col("id") * size).alias("n")
    sizes = members.sparkSession.range(math.ceil(n / size)).select(number, filled)
    yes = F.coalesce("_yes", F.lit(False))
    groups = sizes.join(answer, "group_no", "left").select(
        "group_no",
        F.when(yes, "SENT").otherwise("ERROR").alias("dispatch_status"),
        F.when(yes, F.col("n")).otherwise(0).cast("bigint").alias("records_included"),
    )
    tags = chunked.join(answer.filter("_yes"), "group_no", "left_semi").select(key, "group_no")
    return groups, tags, payloads


def recover(groups: DataFrame, members: DataFrame, accepted: DataFrame) -> DataFrame:
    """Groups after another attempt, with ``failed`` on those refused again.

    A SENT group is left alone. Only counts are needed here; the payload pages of a group come
    from ``group_members``.
    """
    wanted = groups.filter(F.col("dispatch_status") == "ERROR").select("group_no")
    totals = members.join(wanted, "group_no", "left_semi").groupBy("group_no").agg(F.count("*").alias("_n"))
    answer = accepted.select("group_no", F.col("accepted").alias("_yes"))
    retried = F.col("dispatch_status") == "ERROR"
    won = retried & F.coalesce("_yes", F.lit(False))
    return (
        groups.join(totals, "group_no", "left")
        .join(answer, "group_no", "left")
        .withColumns(
            {
                "records_included": F.when(won, F.coalesce("_n", F.lit(0))).otherwise(
                    F.col("records_included")
                ),
                "failed": retried & ~F.coalesce("_yes", F.lit(False)),
                "dispatch_status": F.when(won, "SENT").otherwise(F.col("dispatch_status")),
            }
        )
        .drop("_n", "_yes")
    )


def run_status(groups: DataFrame) -> DataFrame:
    """FAILED if any group was refused again."""
    return groups.agg(
        F.when(F.count_if("failed") > 0, "FAILED").otherwise("COMPLETED").alias("status"),
        F.count_if("failed").alias("refused"),
    )
