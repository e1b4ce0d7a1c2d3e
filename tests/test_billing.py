import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.money import rate_exact, rate_or_null
from millrace.operators import sinks
from millrace.operators.aggregates import partition_totals, reconcile
from millrace.operators.ordering import id_bounds
from millrace.plans.billing import run_billing
from millrace.schemas import BILLING_CHARGE
from millrace.session import scratch

PARAMS = {"DATE": "2026-01-01", "ATTEMPT_NUMBER": "1"}
SCHEMA = "id BIGINT, subscriber_id BIGINT, units BIGINT, rate BIGINT"
MAX = 2**63 - 1


def test_seed():
    rows = [(i, 100, 10, 5) for i in range(1, 6)] + [(i, 101, 20, 3) for i in range(6, 11)]
    return rows + [(i, 102, 5, 8) for i in range(11, 16)] + [(i, 103, 15, 4) for i in range(16, 25)]


test_seed.__test__ = False


def usage(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def totals(charges):
    row = charges.agg(F.count("*"), F.sum("cost"), F.count_distinct("source_id")).first()
    return tuple(row)


@pytest.mark.parametrize("units,rate,cost", [(5, 3, 15), (1, 1, 1), (0, 100, 0), (20, 4, 80)])
def test_product(spark, units, rate, cost):
    row = spark.range(1).select(rate_exact(F.lit(units), F.lit(rate))).first()
    assert row[0] == cost


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_overflow_fails_or_is_null(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = usage(spark, [(1, 1, MAX, 2)])
        assert df.select(rate_or_null(F.col("units"), F.col("rate"))).first()[0] is None
        with pytest.raises(PySparkException, match="long overflow"):
            df.select(rate_exact(F.col("units"), F.col("rate"))).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_test_seed(spark):
    root = scratch(spark, "billing")
    rows = usage(spark, test_seed())
    run = run_billing(rows, root, PARAMS, 1)
    assert run.status == "COMPLETED" and totals(run.charges) == (24, 1290, 24)
    costs = {r["source_id"]: r["cost"] for r in run.charges.collect()}
    assert [costs[i] for i in (3, 8, 12, 20)] == [50, 60, 40, 60]
    per_range = partition_totals(run.charges, id_bounds(rows, "id"), 4).orderBy("range_no").collect()
    assert [r["charge_rows"] for r in per_range] == [5, 5, 5, 9]
    assert [r["total_cost"] for r in per_range] == [250, 300, 200, 540]
    # A new identity over the same input charges nothing again.
    again = run_billing(rows, root, {**PARAMS, "ATTEMPT_NUMBER": "2"}, 2)
    assert totals(again.charges) == (24, 1290, 24)
    proof = reconcile(again.charges, rows).first()
    assert (proof["charge_rows"], proof["charged_sources"], proof["double_billed"]) == (24, 24, 0)
    assert proof["charge_sum"] == proof["usage_sum"] == 1290


def test_development_seed(spark):
    rates = [(100, 10, 5), (101, 20, 3), (102, 5, 8), (103, 15, 4)]
    rows = [(i, *rates[(i - 1) // 6]) for i in range(1, 25)]
    assert totals(run_billing(usage(spark, rows), scratch(spark, "b"), PARAMS, 1).charges)[:2] == (24, 1260)


def test_thousand_more_rows(spark):
    rows = test_seed() + [(i, 200, 10, 2) for i in range(25, 1025)]
    assert totals(run_billing(usage(spark, rows), scratch(spark, "b"), PARAMS, 1).charges)[:2] == (1024, 21290)


def test_overflow_fails_one_range_and_restart_bills_once(spark):
    root = scratch(spark, "billing")
    bad = [(i, s, (MAX // 2 + 1) if i == 13 else u, 3 if i == 13 else r) for i, s, u, r in test_seed()]
    first = run_billing(usage(spark, bad), root, PARAMS, 1)
    assert first.status == "FAILED" and totals(first.charges)[0] == 19
    second = run_billing(usage(spark, test_seed()), root, PARAMS, 2)
    assert second.status == "COMPLETED" and totals(second.charges) == (24, 1290, 24)
    ledger = second.ranges.collect()
    assert [r["range_no"] for r in ledger if r["run_id"] == 2] == [2]
    assert {r["range_no"] for r in ledger if r["run_id"] == 1} == {0, 1, 2, 3}
    later = [*test_seed(), (1000, 1, 5, 5)]
    third = run_billing(usage(spark, later), root, PARAMS, 3)
    assert third.status == "ALREADY_COMPLETE" and totals(third.charges) == (24, 1290, 24)
    assert third.ranges.count() == len(ledger)


def test_empty_source(spark):
    run = run_billing(usage(spark, []), scratch(spark, "b"), PARAMS, 1)
    assert run.status == "COMPLETED" and run.charges.count() == 0
    assert [(r["min_id"], r["max_id"]) for r in run.ranges.collect()] == [(1, 0)]


def test_a_source_row_given_twice_is_billed_once(spark):
    run = run_billing(usage(spark, test_seed() * 2), scratch(spark, "b"), PARAMS, 1)
    assert totals(run.charges) == (24, 1290, 24)


def test_fixed_settings_cannot_be_overridden(spark):
    rows = usage(spark, test_seed())
    for params in ({"GRID_SIZE": "8"}, {"CHUNK_SIZE": "7"}):
        with pytest.raises(ValueError, match="fixed at"):
            run_billing(rows, scratch(spark, "b"), params, 1)
    run_billing(rows, scratch(spark, "b"), {"GRID_SIZE": "4", "CHUNK_SIZE": "100"}, 1)


def charge(spark, rows):
    return spark.createDataFrame(rows, "source_id BIGINT, cost BIGINT, seq BIGINT")


def test_insert_if_absent(spark):
    old = charge(spark, [(1, 15, 0)])
    for unique in (False, True):
        again = sinks.insert_if_absent(
            charge(spark, [(1, 99, 1), (2, 20, 2)]), old, "source_id", unique_keys=unique
        )
        assert [tuple(r) for r in again.collect()] == [(2, 20, 2)]
    twice = sinks.insert_if_absent(charge(spark, [(3, 7, 5), (3, 8, 4), (3, 9, 6)]), old, "source_id", ["seq"])
    assert [tuple(r) for r in twice.collect()] == [(3, 8, 4)]
    assert sinks.insert_if_absent(charge(spark, []), old, "source_id").count() == 0


def test_stored_insert_prunes_by_key_range(spark):
    path = scratch(spark, "charges")
    rows = usage(spark, test_seed()).select(
        F.col("id").alias("source_id"),
        "subscriber_id",
        "units",
        "rate",
        F.col("units").alias("cost"),
        F.lit(1).cast("bigint").alias("job_execution_id"),
    )
    for part in (rows.filter("source_id <= 10"), rows.filter("source_id > 5"), rows):
        sinks.insert_if_absent_into(part, path, "source_id", BILLING_CHARGE, clustered=True)
    assert sinks.read_table(spark, path, BILLING_CHARGE).count() == 24
