"""Fault-tolerant harvest: classify, retry, skip to dead letters, stop at the limit, resume."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.checks import check_date
from millrace.operators.aggregates import all_counters
from millrace.operators.faults import (
    CHUNK_SIZE,
    EXHAUSTED,
    KNOWN_CLASSES,
    OK,
    RETRY_LIMIT,
    SKIP,
    SKIP_LIMIT,
    RunCut,
    classify,
    describe_failure,
    failing_rows,
    first_failure,
    resume,
    retry_outcome,
)
from millrace.operators.sinks import append_to, dead_letter, insert_if_absent, read_table
from millrace.plans.params import identity_of, require, text
from millrace.schemas import CHECKPOINT, DEAD_LETTER, MARK, STEP_EXECUTION
from millrace.session import dropped, stored
from millrace.sources.tables import scan_ordered

JOB_NAME = "harvest"
STEP_NAME = "harvestStep"
COLUMNS = ["payload", "poison_flag", "transient_fail_until_attempt", "abort_flag"]


@dataclass(frozen=True)
class HarvestRun:
    status: str
    cut: RunCut
    processed: DataFrame
    dead_letters: DataFrame
    counters: DataFrame
    steps: DataFrame


def outcomes(source: DataFrame, retry_limit: int = RETRY_LIMIT) -> DataFrame:
    """Source rows with what becomes of each of them; one narrow pass."""
    rows = scan_ordered(source, "id", COLUMNS, ordered=False)
    return describe_failure(retry_outcome(classify(rows), retry_limit), retry_limit)


def run_harvest(
    source: DataFrame,
    root: str,
    params: dict[str, str],
    run_id: int,
    recorded_at: Column | None = None,
    chunk: int = CHUNK_SIZE,
    skip_limit: int = SKIP_LIMIT,
    retry_limit: int = RETRY_LIMIT,
) -> HarvestRun:
    """Harvest ``source`` into the tables below ``root``.

    Dead letters are stored first and on their own, then the marks of processed rows, then the
    checkpoint and the step's counters. All writes leave out what an interrupted attempt has stored already.

    The source is read twice: for its failing rows, by their flags, and for key and outcome of the rows before the run's
    end, which are counted while they are written. All else comes from these two narrow tables: where the last chunk
    begins, the marks, the counters and last key of what is committed, and how many chunks were rolled back.
    """
    spark = source.sparkSession
    require(spark, check_date(text(params.get("DATE"))))
    identity = identity_of(spark, JOB_NAME, params)
    marks, letters, points, steps = (f"{root}/{n}" for n in ("processed", "dead_letter", "checkpoint", "step_execution"))

    rows = outcomes(resume(source, read_table(spark, points, CHECKPOINT), identity), retry_limit)
    failing, failing_path = stored(failing_rows(rows, retry_limit), "failing")
    end = first_failure(failing, skip_limit)
    reason, last_reached = end or (None, None)

    skips = failing if end is None else failing.filter(F.col("id") < last_reached)
    skips = skips.filter(F.col("outcome").isin(SKIP, EXHAUSTED))
    at = F.current_timestamp() if recorded_at is None else recorded_at
    records = dead_letter(skips, run_id, at, KNOWN_CLASSES)
    mine = read_table(spark, letters, DEAD_LETTER).filter(F.col("job_execution_id") == run_id)
    append_to(records.join(mine.select("source_id"), "source_id", "left_anti"), letters)

    reached = rows if end is None else rows.filter(F.col("id") < last_reached)
    met = Observation()
    narrow, narrow_path = stored(
        reached.observe(met, F.count("*").alias("rows")).select("id", "outcome", "phase"), "reached"
    )
    boundary = None if end is None else _boundary(narrow, met.get["rows"] % chunk, last_reached)
    status = "COMPLETED" if end is None else "FAILED"
    cut = RunCut(status, reason, last_reached, boundary)

    committed = cut.committed(narrow)
    found = all_counters(committed, chunk, F.min("id").alias("first"), F.max("id").alias("last")).first().asDict()
    done = committed.filter(F.col("outcome") == OK).select("id", F.lit(run_id).cast("bigint").alias("run_id"))
    here = F.col("id").between(found["first"], found["last"]) if found["read_count"] else F.lit(False)
    append_to(insert_if_absent(done, read_table(spark, marks, MARK).filter(here), "id", unique_keys=True), marks)

    # Rows reached and not committed, the failing one among them, fill the chunks that were rolled back.
    rolled_back = math.ceil((met.get["rows"] - found["read_count"] + (end is not None)) / chunk)
    if found["last"] is not None:
        point = [(identity, run_id, found["last"], status)]
        append_to(spark.createDataFrame(point, CHECKPOINT).coalesce(1), points)
    names = T.StructType.fromDDL(STEP_EXECUTION).names
    values = {**found, "run_id": run_id, "step_name": STEP_NAME, "status": status, "reason": reason, "rollback_count": rolled_back}
    counters = spark.createDataFrame([tuple(values[name] for name in names)], STEP_EXECUTION).coalesce(1)
    append_to(counters, steps)
    for path in (failing_path, narrow_path):
        dropped(spark, path)
    return HarvestRun(
        status,
        cut,
        read_table(spark, marks, MARK),
        read_table(spark, letters, DEAD_LETTER),
        counters,
        read_table(spark, steps, STEP_EXECUTION),
    )


def _boundary(narrow: DataFrame, rolled_back: int, cut: int) -> int:
    """First key of the chunk that is rolled back: so many rows before the failing one."""
    if not rolled_back:
        return cut
    return narrow.select("id").orderBy(F.desc("id")).limit(rolled_back).agg(F.min("id")).first()[0]
