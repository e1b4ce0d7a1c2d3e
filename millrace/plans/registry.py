"""The jobs by name with their default parameters, and their launch through the run ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from millrace.operators.runs import Execution, Launch, launch
from millrace.plans import billing, bundles, harvest, payments, person_etl, recovery, tickets
from millrace.session import stable

JOBS: dict[str, Callable] = {
    "person_etl": person_etl.run_person_etl,
    "dispatch_recovery": recovery.run_recovery,
    "ticket_signing": tickets.run_tickets,
    "event_bundles": bundles.run_bundles,
    "harvest": harvest.run_harvest,
    "billing": billing.run_billing,
    "payment_summary": payments.payment_summary,
}

# Parameters of a launch that names none. There is no default secret.
DEFAULTS: dict[str, dict[str, str]] = {
    "harvest": {"DATE": "2026-01-01", "ATTEMPT_NUMBER": "1"},
    "billing": {"DATE": "2026-01-01", "ATTEMPT_NUMBER": "1"},
    "payment_summary": {"DATE": "2024-01-01"},
}

#: Each job as a run of the ledger: it gets session, folder, parameters and run number, and its inputs by name.
WORK: dict[str, Callable] = {
    "person_etl": lambda spark, root, params, run_id, csv_path, lookup, accepted: person_etl.run_person_etl(
        spark, csv_path, lookup, accepted, root, params["DATE"], run_id
    ),
    "dispatch_recovery": lambda spark, root, params, run_id, groups, members, accepted: recovery.run_recovery(
        groups, members, accepted, root
    ),
    "ticket_signing": lambda spark, root, params, run_id, sold, secret: tickets.run_tickets(
        sold, root, secret, run_id, params.get("EVENT_ID")
    ),
    "event_bundles": lambda spark, root, params, run_id, files, sold, found=None: bundles.run_bundles(
        files, sold, root, params.get("EVENT_ID"), found
    ),
    "harvest": lambda spark, root, params, run_id, source, **settings: harvest.run_harvest(
        source, root, params, run_id, **settings
    ),
    "billing": lambda spark, root, params, run_id, usage, **settings: billing.run_billing(
        usage, root, params, run_id, **settings
    ),
    # The summary is one row; computing it is the run.
    "payment_summary": lambda spark, root, params, run_id, path: stable(payments.payment_summary(spark, path)),
}


def launch_params(job: str, caller: dict[str, str]) -> dict[str, str]:
    """Defaults of a job with the caller's parameters on top."""
    if job not in JOBS:
        raise KeyError(f"Job <{job}> not found")
    return {**DEFAULTS.get(job, {}), **caller}


def known_jobs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(name,) for name in JOBS], "job_name STRING")


def launch_job(
    spark: SparkSession, root: str, job: str, caller: dict[str, str], at: Column | None = None, **inputs
) -> Launch:
    """Launch a job through the run ledger below ``root``.

    The ledger decides by job and identifying parameters; a launch it refuses leaves no trace but its decision. The
    run's number is the ``job_execution_id`` of all rows that the job stores.
    """
    params = {**DEFAULTS.get(job, {}), **caller}

    def work(run: Execution):
        return WORK[job](spark, root, params, run.execution_id, **inputs)

    return launch(spark, root, job, params, known_jobs(spark), work, at)
