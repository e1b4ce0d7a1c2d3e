"""The stored run ledger: one of several launches starts, runs that fail or are lost can be launched again."""

import threading

import pytest
from pyspark.sql import functions as F

from millrace.operators import ledger, runs
from millrace.plans import registry
from millrace.session import scratch

PARAMS = {"DATE": "2026-01-01", "ATTEMPT_NUMBER": "1"}


def known(spark):
    return spark.createDataFrame([("work",), ("other",)], "job_name STRING")


def begin(spark, root, params=PARAMS, job="work"):
    return runs.begin(spark, root, job, params, known(spark))


def test_claim_has_one_winner(spark):
    path = scratch(spark, "claim")
    won = []

    def take():
        won.append(runs.claim(spark, path))

    threads = [threading.Thread(target=take) for _ in range(16)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 15 + [True]
    assert runs.next_number(spark, scratch(spark, "numbers"), 5) == 5


def test_of_concurrent_launches_one_starts(spark):
    """All of them see the same empty history."""
    root = scratch(spark, "runs")
    gate, found = threading.Barrier(4), []

    def go():
        gate.wait()
        found.append(begin(spark, root))

    threads = [threading.Thread(target=go) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(run.decision for run in found) == ["ALREADY_RUNNING"] * 3 + ["NEW"]
    assert [r.status for r in runs.executions(spark, root).collect()] == ["STARTED"]
    # Another identity goes on its own, with a number of its own.
    other = begin(spark, root, {**PARAMS, "ATTEMPT_NUMBER": "2"})
    assert other.starts and other.turn == 0
    assert len({r.execution_id for r in runs.executions(spark, root).collect()}) == 2


def test_restart_and_completion(spark):
    root = scratch(spark, "runs")

    def broken(run):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        runs.launch(spark, root, "work", PARAMS, known(spark), broken)
    again = runs.launch(spark, root, "work", {**PARAMS, "DESCRIPTION": "other words"}, known(spark), lambda run: 7)
    assert (again.run.decision, again.run.turn, again.status, again.result) == ("RESTART", 1, "COMPLETED", 7)
    refused = runs.launch(spark, root, "work", PARAMS, known(spark), broken)
    assert (refused.run.decision, refused.status) == ("ALREADY_COMPLETE", None)
    history = runs.executions(spark, root)
    assert [(r.turn, r.status) for r in history.orderBy("turn").collect()] == [(0, "FAILED"), (1, "COMPLETED")]
    proof = ledger.restart_proof(history).collect()
    assert len(proof) == 1 and proof[0].recovered and proof[0].executions == 2
    assert [r.turn for r in ledger.restart_history(history).orderBy("turn").collect()] == [0, 1]


@pytest.mark.parametrize(
    "job, params, decision",
    [("none", PARAMS, "NOT_FOUND"), ("work", {}, "MISSING_DATE"), ("work", {"DATE": "2024-13-01"}, "INVALID_DATE")],
)
def test_refusals_leave_no_trace(spark, job, params, decision):
    root = scratch(spark, "runs")
    assert begin(spark, root, params, job).decision == decision
    assert runs.executions(spark, root).count() == 0


def test_lost_drivers(spark):
    """One run never ended; another was claimed and never recorded."""
    root = scratch(spark, "runs")
    first = begin(spark, root)
    assert begin(spark, root).decision == "ALREADY_RUNNING"
    assert runs.abandon(spark, root, first.identity) == 1
    second = begin(spark, root)
    assert (second.decision, second.turn) == ("RESTART", 1)
    runs.record(spark, root, second, "FAILED")
    assert runs.claim(spark, f"{root}/run_ledger/turns/{first.identity}/2")
    assert begin(spark, root).decision == "ALREADY_RUNNING"
    assert runs.abandon(spark, root, first.identity) == 1
    assert begin(spark, root).turn == 3
    assert runs.abandon(spark, root, "unknown") == 0


def test_every_job_appends_its_execution(spark, tmp_path):
    assert set(registry.WORK) == set(registry.JOBS)
    root, at = scratch(spark, "jobs"), F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    (tmp_path / "people.csv").write_text("Ann,Lee,a@x,smith\nBo,Ray,b@x,baker\n")
    (tmp_path / "pay.csv").write_text("a,b,c\n1,2,3.5\n4,5,6\n")
    lookup = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id BIGINT, value DOUBLE").withColumn("value", F.col("value").cast("decimal(19,2)"))
    accepted = spark.createDataFrame([(0, True)], "group_no BIGINT, accepted BOOLEAN")
    groups = spark.createDataFrame([(0, "ERROR", 0)], "group_no BIGINT, dispatch_status STRING, records_included BIGINT")
    members = spark.createDataFrame([(1, 0)], "id BIGINT, group_no BIGINT")
    source = spark.createDataFrame(
        [(i, "{}", i == 3, 0, False, False) for i in range(1, 9)],
        "id BIGINT, payload STRING, poison_flag BOOLEAN, transient_fail_until_attempt INT, abort_flag BOOLEAN, processed BOOLEAN",
    )
    usage = spark.createDataFrame([(i, 1, 2, 3) for i in range(1, 9)], "id BIGINT, subscriber_id BIGINT, units BIGINT, rate BIGINT")
    sold = spark.createDataFrame(
        [(1, 10, "T-1", "Ann", "Show", "Hall", "A1", None, False)],
        "id BIGINT, event_id BIGINT, ticket_code STRING, holder_name STRING, event_name STRING, event_location STRING,"
        " seat STRING, event_datetime TIMESTAMP, processed BOOLEAN",
    )
    files = spark.createDataFrame(
        [(1, "LOCAL", "/t/1.pdf", "ab", 5)],
        "ticket_id BIGINT, storage_type STRING, storage_path STRING, checksum_sha256 STRING, file_size_bytes BIGINT",
    )
    inputs = {
        "person_etl": {"csv_path": str(tmp_path / "people.csv"), "lookup": lookup, "accepted": accepted},
        "dispatch_recovery": {"groups": groups, "members": members, "accepted": accepted},
        "ticket_signing": {"sold": sold, "secret": "s" * 40},
        "event_bundles": {"files": files, "sold": sold},
        "harvest": {"source": source},
        "billing": {"usage": usage},
        "payment_summary": {"path": str(tmp_path / "pay.csv")},
    }
    for turn in (0, 1):
        for name, given in inputs.items():
            got = registry.launch_job(spark, root, name, {"DATE": "2026-01-01"}, at, **given)
            assert got.run.decision == ("ALREADY_COMPLETE" if turn else "NEW"), name
            assert got.status == (None if turn else "COMPLETED"), name
    rows = runs.executions(spark, root).collect()
    assert sorted(r.job_name for r in rows) == sorted(inputs) and {r.status for r in rows} == {"COMPLETED"}
    charge = spark.read.parquet(f"{root}/billing_charge").select("job_execution_id").distinct().collect()
    assert [c[0] for c in charge] == [r.execution_id for r in rows if r.job_name == "billing"]
