"""The run ledger as a stored table: a run is claimed, recorded when it starts and when it ends.

A run's place in its identity's history is its turn. Only one launch can take a turn, because taking it creates a file
that must not exist yet, which the file system decides. So of two launches that saw the same history one starts and the
other is refused, whichever driver they come from. The next turn is open once the one before it has ended.

Events are appended only: one row when a run starts, one when it ends. A run whose driver was lost stays STARTED and
its identity refuses launches until ``abandon`` ends it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.claims import claim, claimed, next_number
from millrace.operators.ledger import launch_decision
from millrace.operators.sinks import append_to, read_table

EVENTS = (
    "execution_id BIGINT, identity STRING, turn INT, job_name STRING, params MAP<STRING,STRING>,"
    " status STRING, at TIMESTAMP_NTZ"
)

STARTED, COMPLETED, FAILED = "STARTED", "COMPLETED", "FAILED"
ALREADY_RUNNING = "ALREADY_RUNNING"
#: Decisions after which a run may start.
STARTS = ("NEW", "RESTART")


# ---- the ledger ---------------------------------------------------------------------------


def _events(root: str) -> str:
    return f"{root}/run_ledger/events"


def executions(spark: SparkSession, root: str) -> DataFrame:
    """One row per run: identity, turn, job, parameters, status, start and end. An open run has no end."""
    ended = F.col("status") != STARTED
    return (
        read_table(spark, _events(root), EVENTS)
        .groupBy("execution_id")
        .agg(
            F.max("identity").alias("identity"),
            F.max("turn").alias("turn"),
            F.max("job_name").alias("job_name"),
            F.first("params", ignorenulls=True).alias("params"),
            F.coalesce(F.max(F.when(ended, F.col("status"))), F.lit(STARTED)).alias("status"),
            F.min(F.when(~ended, F.col("at"))).alias("start_time"),
            F.max(F.when(ended, F.col("at"))).alias("end_time"),
        )
    )


@dataclass(frozen=True)
class Execution:
    """A run that may go on, or the reason why it may not; then it has no number."""

    decision: str
    job_name: str
    identity: str
    execution_id: int | None = None
    turn: int | None = None

    @property
    def starts(self) -> bool:
        return self.execution_id is not None


def begin(spark: SparkSession, root: str, job_name: str, params: dict[str, str], jobs: DataFrame, at: Column | None = None) -> Execution:
    """Decide about a launch, and if it may start, claim its turn and record it.

    ``jobs`` holds the known names. The decision is the one of ``launch_decision`` on the stored ledger; a launch that
    loses the turn to another one is ALREADY_RUNNING.
    """
    request = spark.createDataFrame([(0, job_name, params)], "request_id BIGINT, job_name STRING, params MAP<STRING,STRING>")
    history = executions(spark, root)
    decided = launch_decision(request, jobs, history).first()
    refused = Execution(decided["decision"], job_name, decided["identity"])
    if refused.decision not in STARTS:
        return refused
    mine = history.filter(F.col("identity") == refused.identity)
    turn = mine.agg(F.coalesce(F.max("turn") + 1, F.lit(0))).first()[0]
    return _take(spark, root, refused, turn, params, at) or Execution(ALREADY_RUNNING, job_name, refused.identity)


def _take(spark: SparkSession, root: str, wanted: Execution, turn: int, params: dict[str, str], at: Column | None) -> Execution | None:
    """The run of a turn, recorded as started; None if another launch has it."""
    if not claim(spark, f"{root}/run_ledger/turns/{wanted.identity}/{turn}"):
        return None
    last = read_table(spark, _events(root), EVENTS).agg(F.coalesce(F.max("execution_id"), F.lit(0))).first()[0]
    number = next_number(spark, f"{root}/run_ledger/numbers", last + 1)
    taken = Execution(wanted.decision, wanted.job_name, wanted.identity, number, turn)
    record(spark, root, taken, STARTED, params, at)
    return taken


def record(spark: SparkSession, root: str, run: Execution, status: str, params: dict[str, str] | None = None, at: Column | None = None) -> None:
    """Append one event of a run."""
    row = spark.createDataFrame(
        [(run.execution_id, run.identity, run.turn, run.job_name, params, status)], EVENTS.rsplit(",", 1)[0]
    )
    now = F.current_timestamp() if at is None else at
    # In the run's own folder: runs at once would share the committer's temporary one.
    append_to(row.withColumn("at", now.cast("timestamp_ntz")).coalesce(1), f"{_events(root)}/run={run.execution_id}")


def abandon(spark: SparkSession, root: str, identity: str, job_name: str = "", at: Column | None = None) -> int:
    """End the open run of an identity as FAILED, after its driver was lost; returns how many were ended.

    That includes a turn which was claimed and never recorded: it is recorded as failed now.
    """
    mine = executions(spark, root).filter(F.col("identity") == identity)
    open_ = mine.filter(F.col("status") == STARTED).select("execution_id", "turn", "job_name").collect()
    for row in open_:
        run = Execution("", row["job_name"], identity, row["execution_id"], row["turn"])
        record(spark, root, run, FAILED, at=at)
    if open_:
        return len(open_)
    known, turn = mine.agg(F.max("job_name"), F.coalesce(F.max("turn") + 1, F.lit(0))).first()
    if not claimed(spark, f"{root}/run_ledger/turns/{identity}/{turn}"):
        return 0
    last = read_table(spark, _events(root), EVENTS).agg(F.coalesce(F.max("execution_id"), F.lit(0))).first()[0]
    number = next_number(spark, f"{root}/run_ledger/numbers", last + 1)
    lost = Execution("", known or job_name, identity, number, turn)
    record(spark, root, lost, STARTED, {}, at)
    record(spark, root, lost, FAILED, at=at)
    return 1


@dataclass(frozen=True)
class Launch:
    """What became of a launch: the decision, the final status and the work's result, both None if it was refused."""

    run: Execution
    status: str | None = None
    result: Any = None


def launch(
    spark: SparkSession,
    root: str,
    job_name: str,
    params: dict[str, str],
    jobs: DataFrame,
    work: Callable[[Execution], Any],
    at: Column | None = None,
) -> Launch:
    """Begin a run, do its work and record how it ended.

    The result's ``status`` counts where it has one, else the work is COMPLETED. Work that raises has FAILED, and the
    error goes on to the caller once that is recorded.
    """
    run = begin(spark, root, job_name, params, jobs, at)
    if not run.starts:
        return Launch(run)
    try:
        result = work(run)
    except BaseException:
        record(spark, root, run, FAILED, at=at)
        raise
    named = None if isinstance(result, DataFrame) else getattr(result, "status", None)
    status = FAILED if named == FAILED else COMPLETED
    record(spark, root, run, status, at=at)
    return Launch(run, status, result)
