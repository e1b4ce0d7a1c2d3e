"""Run identities, launch decisions and audit rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.checks import as_date
from millrace.functions.text import is_blank, iso_local_time
from millrace.operators.joins import with_definition
from millrace.operators.ordering import ROWS_PER_BUCKET, running_total

# Fixed value: the parameter that describes a run without identifying it.
NOT_IDENTIFYING = ["DESCRIPTION"]


def run_identity(
    job_name: Column, params: Column, not_identifying: list[str] = NOT_IDENTIFYING
) -> Column:
    """A key of job name and identifying parameters, whatever their order in the map.

    Every part carries its length, so that different names and values never give the same text; a NULL value is no
    empty one.
    """

    def part(col: Column) -> Column:
        return F.coalesce(F.concat(F.char_length(col).cast("string"), F.lit(":"), col), F.lit("-"))

    kept = F.map_filter(params, lambda k, v: ~k.isin(not_identifying))
    pairs = F.transform(
        F.sort_array(F.map_entries(kept)), lambda e: F.concat(part(e.getField("key")), part(e.getField("value")))
    )
    return F.md5(F.concat(part(job_name), F.concat_ws("", pairs)))


def overlay_params(defaults: Column, caller: Column) -> Column:
    """Both maps as one; the caller's value wins."""
    rest = F.map_filter(defaults, lambda k, v: ~F.map_contains_key(caller, k))
    return F.map_concat(rest, caller)


def launch_params(params: Column) -> Column:
    """Parameters of a launch: ``ATTEMPT_NUMBER`` defaults to 1."""
    return overlay_params(F.create_map(F.lit("ATTEMPT_NUMBER"), F.lit("1")), params)


def launch_decision(requests: DataFrame, jobs: DataFrame, executions: DataFrame) -> DataFrame:
    """``decision`` for each request of ``(request_id, job_name, params)``.

    In this order: unknown job, missing date, no date, an execution still running, completed
    already, restart after a failure, first run. Of running and completed executions of the same
    identity the latest one counts; of equal requests only the first may start. ``executions`` has ``(identity, execution_id, status)``.
    """

    def newest(status: str) -> Column:
        latest = F.max(F.when(F.col("status") == status, F.col("execution_id")))
        return F.coalesce(latest, F.lit(-1).cast("bigint"))

    date = F.col("params").getItem("DATE")
    known = jobs.select("job_name").distinct().withColumn("_known", F.lit(True))
    named = requests.withColumn("identity", run_identity(F.col("job_name"), launch_params(F.col("params"))))
    # Requests of one identity have the same job and date, so the first of them stands for all: one aggregate gives it
    # together with the history.
    none = F.lit(None).cast("bigint")
    every = executions.select("identity", "execution_id", "status", none.alias("request_id")).unionByName(
        named.select("identity", none.alias("execution_id"), F.lit(None).cast("string").alias("status"), "request_id")
    )
    history = every.groupBy("identity").agg(
        newest("STARTED").alias("_running"),
        newest("COMPLETED").alias("_complete"),
        F.max("execution_id").alias("last_execution_id"),
        F.min("request_id").alias("_first"),
    )
    decision = (
        F.when(F.col("_known").isNull(), "NOT_FOUND")
        .when(is_blank(date), "MISSING_DATE")
        .when(as_date(date).isNull(), "INVALID_DATE")
        .when(F.col("_running") > F.col("_complete"), "ALREADY_RUNNING")
        .when(F.col("_complete") > F.col("_running"), "ALREADY_COMPLETE")
        .when(F.col("request_id") > F.col("_first"), "ALREADY_RUNNING")
        .when(F.col("last_execution_id").isNotNull(), "RESTART")
        .otherwise("NEW")
    )
    return (
        named.join(known, "job_name", "left")
        .join(history, "identity")
        .select("request_id", "job_name", "identity", decision.alias("decision"), "last_execution_id")
    )


def duration_ms(start: Column, end: Column) -> Column:
    """Full milliseconds from start to end; an open run has lasted 0."""
    return F.coalesce(
        F.timestamp_diff("MILLISECOND", start, end), F.lit(0).cast("bigint")
    )


def run_audit(executions: DataFrame, definitions: DataFrame) -> DataFrame:
    """One audit row per execution of a defined job, with its metadata as JSON text."""
    ms = duration_ms(F.col("start_time"), F.col("end_time"))
    outcome = F.when(F.col("status") == "COMPLETED", "SUCCESS").otherwise("FAILURE")
    meta = F.to_json(
        F.struct(
            iso_local_time(F.col("start_time")).alias("startedAt"),
            iso_local_time(F.col("end_time")).alias("finishedAt"),
            ms.alias("durationMs"),
            outcome.alias("outcome"),
        )
    )
    return with_definition(executions, definitions).select(
        F.col("definition_id").alias("job_definition_id"),
        F.col("execution_id").alias("job_execution_id"),
        F.col("version").alias("job_version"),
        ms.alias("duration_ms"),
        outcome.alias("outcome"),
        meta.alias("execution_metadata"),
    )


def restart_proof(executions: DataFrame) -> DataFrame:
    """Per identity: executions, failures, completions, first and last status.

    ``recovered`` is true for a run that failed first and completed last. All parts merge on the
    map side, so an identity with a very long history is no heavier than another.
    """
    return (
        executions.groupBy("identity")
        .agg(
            F.count("*").alias("executions"),
            F.count_if(F.col("status") == "FAILED").alias("failed"),
            F.count_if(F.col("status") == "COMPLETED").alias("completed"),
            F.min(F.struct("execution_id", "status")).getField("status").alias("first_status"),
            F.max(F.struct("execution_id", "status")).getField("status").alias("last_status"),
        )
        .withColumn(
            "recovered",
            (F.col("first_status") == "FAILED") & (F.col("last_status") == "COMPLETED"),
        )
    )


def restart_history(executions: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Every execution with its 0-based turn within its identity."""
    return running_total(
        executions.select("identity", "execution_id", "status"),
        ["execution_id"],
        ["identity"],
        name="turn",
        rows_per_bucket=rows_per_bucket,
    )


def latest_execution(executions: DataFrame) -> DataFrame:
    """The newest execution of each identity."""
    newest = F.max(F.struct("execution_id", "status")).alias("e")
    return executions.groupBy("identity").agg(newest).select("identity", "e.*")
