"""Partitioned billing: rate usage per id range, charge each source once, restart open ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.checks import check_fixed
from millrace.functions.money import rate_exact, rate_or_null
from millrace.operators.faults import committed_rows, range_outcomes, restart_partitions, unfinished_ranges
from millrace.operators.ordering import Bounds, assign_id_range, id_bounds, id_ranges
from millrace.operators.sinks import append_to, insert_if_absent_into, read_table
from millrace.plans.params import identity_of, require
from millrace.schemas import BILLING_CHARGE, RANGE_LEDGER
from millrace.session import stable

JOB_NAME = "billing"

# Grid and chunk of the billing job.
GRID_SIZE = 4
CHUNK_SIZE = 100


@dataclass(frozen=True)
class BillingRun:
    status: str
    charges: DataFrame
    ranges: DataFrame


def run_billing(
    usage: DataFrame,
    root: str,
    params: dict[str, str],
    run_id: int,
    grid: int = GRID_SIZE,
    chunk: int = CHUNK_SIZE,
) -> BillingRun:
    """Charge the usage rows into ``root``.

    A range that fails keeps its whole chunks and is left open; the next run with the same
    identifying parameters takes up the open ranges by the bounds saved at the first run. Charges
    are stored before the ranges are reported, and stored only if absent, so a run that broke in
    between is simply repeated. A finished run is refused: its parameters name what was billed, and rows that came
    later need a run of their own.
    """
    spark = usage.sparkSession
    given = [(name, params.get(name)) for name in ("GRID_SIZE", "CHUNK_SIZE")]
    require(
        spark,
        *[
            check_fixed(F.lit(value).cast("bigint"), expected, name)
            for (name, value), expected in zip(given, (grid, chunk), strict=True)
        ],
    )
    identity = identity_of(spark, JOB_NAME, params)
    charge_path, ledger_path = f"{root}/billing_charge", f"{root}/range_ledger"
    ledger = read_table(spark, ledger_path, RANGE_LEDGER).filter(F.col("identity") == identity)

    first_run = ledger.isEmpty()
    if first_run:
        limits = stable(id_bounds(usage, "id"))
        low, high = limits.first()
        saved = id_ranges(limits, grid)
        rows = assign_id_range(usage, "id", grid, Bounds.fixed(low, high))
    else:
        if unfinished_ranges(ledger).isEmpty():
            return BillingRun(
                "ALREADY_COMPLETE",
                read_table(spark, charge_path, BILLING_CHARGE),
                read_table(spark, ledger_path, RANGE_LEDGER),
            )
        saved = ledger.select("range_no", "min_id", "max_id").distinct()
        rows = restart_partitions(usage, ledger)

    bad = rate_or_null(F.col("units"), F.col("rate")).isNull()
    outcomes = stable(range_outcomes(rows, bad, chunk))
    charges = committed_rows(rows, outcomes).select(
        F.col("id").alias("source_id"),
        "subscriber_id",
        "units",
        "rate",
        rate_exact(F.col("units"), F.col("rate")).alias("cost"),
        F.lit(run_id).cast("bigint").alias("job_execution_id"),
    )
    insert_if_absent_into(
        charges, charge_path, "source_id", BILLING_CHARGE, clustered=not first_run
    )

    how = "left" if first_run else "inner"
    states = saved.join(outcomes.select("range_no", "status"), "range_no", how).select(
        F.lit(identity).alias("identity"),
        F.lit(run_id).cast("bigint").alias("run_id"),
        F.col("range_no").cast("int").alias("range_no"),
        "min_id",
        "max_id",
        F.coalesce("status", F.lit("COMPLETED")).alias("status"),
    )
    append_to(states.coalesce(1), ledger_path)
    clean = outcomes.filter("status = 'FAILED'").isEmpty()
    return BillingRun(
        "COMPLETED" if clean else "FAILED",
        read_table(spark, charge_path, BILLING_CHARGE),
        read_table(spark, ledger_path, RANGE_LEDGER),
    )
