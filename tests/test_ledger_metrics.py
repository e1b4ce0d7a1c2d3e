from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates, ledger, metrics
from millrace.session import scratch
from millrace.streaming import incremental


def test_identity_ignores_order_and_description(spark):
    job = F.lit("j")

    def identity(*pairs):
        flat = [F.lit(p) for p in pairs]
        return spark.range(1).select(ledger.run_identity(job, F.create_map(*flat))).first()[0]

    a = identity("DATE", "2026-01-01", "ATTEMPT_NUMBER", "1")
    assert a == identity("ATTEMPT_NUMBER", "1", "DESCRIPTION", "x", "DATE", "2026-01-01")
    assert a != identity("DATE", "2026-01-01", "ATTEMPT_NUMBER", "2")


def test_caller_wins(spark):
    a = F.create_map(F.lit("DATE"), F.lit("x"), F.lit("N"), F.lit("1"))
    b = F.create_map(F.lit("DATE"), F.lit("y"))
    assert spark.range(1).select(ledger.overlay_params(a, b)).first()[0] == {"DATE": "y", "N": "1"}


def test_launch_decisions(spark):
    day = {"DATE": "2026-01-01"}
    wanted = [
        (1, "gone", day, "NOT_FOUND"),
        (2, "job", {}, "MISSING_DATE"),
        (3, "job", {"DATE": " "}, "MISSING_DATE"),
        (4, "job", {"DATE": "2026-13-01"}, "INVALID_DATE"),
        (5, "job", {**day, "ATTEMPT_NUMBER": "1"}, "ALREADY_COMPLETE"),
        (6, "job", day, "ALREADY_COMPLETE"),
        (7, "job", {**day, "ATTEMPT_NUMBER": "2"}, "RESTART"),
        (8, "job", {**day, "ATTEMPT_NUMBER": "3"}, "ALREADY_RUNNING"),
        (9, "job", {**day, "ATTEMPT_NUMBER": "4"}, "NEW"),
    ]
    runs = [(1, "1", "FAILED"), (2, "1", "COMPLETED"), (3, "2", "FAILED"), (4, "3", "FAILED"), (5, "3", "STARTED")]
    executions = spark.createDataFrame(runs, "execution_id BIGINT, n STRING, status STRING").withColumn(
        "identity",
        ledger.run_identity(
            F.lit("job"),
            F.create_map(F.lit("DATE"), F.lit("2026-01-01"), F.lit("ATTEMPT_NUMBER"), F.col("n")),
        ),
    )
    asked = spark.createDataFrame(
        [w[:3] for w in wanted], "request_id BIGINT, job_name STRING, params MAP<STRING,STRING>"
    )
    jobs = spark.createDataFrame([("job",)], "job_name STRING")
    out = ledger.launch_decision(asked, jobs, executions).collect()
    assert {r["request_id"]: r["decision"] for r in out} == {w[0]: w[3] for w in wanted}


def test_restart_proof_and_history(spark):
    rows = [("a", 1, "FAILED"), ("a", 2, "COMPLETED"), ("b", 3, "COMPLETED")]
    df = spark.createDataFrame(rows, "identity STRING, execution_id BIGINT, status STRING")
    proof = {r["identity"]: r for r in ledger.restart_proof(df).collect()}
    assert proof["a"]["recovered"] and not proof["b"]["recovered"]
    turns = ledger.restart_history(df).orderBy("execution_id").collect()
    assert [r["turn"] for r in turns] == [0, 1, 0]
    newest = {r["identity"]: r["status"] for r in ledger.latest_execution(df).collect()}
    assert newest == {"a": "COMPLETED", "b": "COMPLETED"}


def test_counters_by_tag(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "job_name STRING")
    out = {r["job_name"]: r["executions"] for r in aggregates.tagged_counter(df).collect()}
    assert out == {"a": 2, "b": 1}


def test_open_runs_in_pages(spark):
    runs = [(i, "hot", "STARTED", f"p{i}") for i in range(250)] + [(900, "b", "COMPLETED", "x")]
    df = spark.createDataFrame(runs, "execution_id BIGINT, job_name STRING, status STRING, params_text STRING")
    jobs = spark.createDataFrame([("hot",), ("b",)], "job_name STRING")
    out = aggregates.running_by_job(df, jobs, page_size=100, rows_per_bucket=20).collect()
    assert sorted((r["job_name"], r["page"], len(r["running"])) for r in out) == [
        ("b", 0, 0),
        ("hot", 0, 100),
        ("hot", 1, 100),
        ("hot", 2, 50),
    ]
    merged = {k: v for r in out for k, v in r["running"].items()}
    assert merged == {str(i): f"p{i}" for i in range(250)}


def events(spark, n=600, hot=True):
    start = datetime(2024, 1, 1)
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        tag = "hot" if hot and i % 3 == 0 else f"t{i % 5}"
        value = 1.25 if i % 4 == 0 else float(round(rng.exponential(20), 2))
        rows.append((start + timedelta(seconds=int(rng.integers(0, 1800))), tag, value, f"{200 + 100 * (i % 4)}"))
    df = spark.createDataFrame(rows, "ts TIMESTAMP, tag STRING, duration DOUBLE, status_code STRING")
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz")), rows


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_quantile_against_numpy(spark, q):
    df, rows = events(spark)
    groups = defaultdict(list)
    for ts, tag, value, _ in rows:
        groups[(tag, ts.minute // 5)].append(value)
    out = metrics.p95(df, q=q, rows_per_bucket=15).collect()
    got = {(r["tag"], r["window_start"].minute // 5): r["quantile"] for r in out}
    assert got.keys() == groups.keys()
    for key, values in groups.items():
        assert got[key] == pytest.approx(np.quantile(values, q))


def test_approximate_quantile_is_close(spark):
    df, rows = events(spark)
    got = metrics.p95(df, minutes=60, approximate=True).filter("tag = 'hot'").first()["quantile"]
    values = [v for _, tag, v, _ in rows if tag == "hot"]
    assert got == pytest.approx(np.quantile(values, 0.95), rel=0.1)


def test_sliding_rate_against_brute_force(spark):
    df, rows = events(spark)
    want = defaultdict(int)
    for ts, tag, _, _ in rows:
        for k in range(5):
            want[(tag, ts.replace(second=0) - timedelta(minutes=k))] += 1
    out = metrics.rate_per_minute(df).collect()
    assert {(r["tag"], r["window_start"]): r["events"] for r in out} == dict(want)
    assert all(r["per_minute"] == r["events"] / 5 for r in out)
    with pytest.raises(ValueError):
        metrics.rate_per_minute(df, minutes=5, slide=2)


def test_error_rates_and_ratios(spark):
    df, rows = events(spark)
    total = metrics.error_rate(df, metrics.SERVER_ERROR, minutes=60, slide=60, tag=None).first()["events"]
    assert total == sum(code.startswith("5") for *_, code in rows)
    mean = metrics.mean_ratio(df, minutes=60).filter("tag = 'hot'").first()["mean"]
    assert mean == pytest.approx(np.mean([v for _, tag, v, _ in rows if tag == "hot"]))
    share = metrics.percent_of(F.col("id"), F.lit(4) - F.lit(4) * (F.col("id") % 2))
    assert [r[0] for r in spark.range(2).select(share).collect()] == [0.0, None]


# ---- streaming ----------------------------------------------------------------------------


def test_incremental_run(spark):
    root = scratch(spark, "inc")
    schema = "source_id BIGINT, cost BIGINT"

    def arrive(low, high):
        spark.range(low, high).select(F.col("id").alias("source_id"), (F.col("id") * 2).alias("cost")).write.mode(
            "append"
        ).parquet(f"{root}/in")

    def run(checkpoint="state"):
        source = incremental.read_increments(spark, f"{root}/in", schema, files_per_batch=2)
        incremental.run_incremental(
            source, lambda batch: batch, f"{root}/out", "source_id", schema, f"{root}/{checkpoint}", ["cost"]
        )
        return spark.read.schema(schema).parquet(f"{root}/out").count()

    arrive(0, 100)
    assert run() == 100
    arrive(50, 150)
    assert run() == 150
    assert run() == 150
    assert run("lost and started over") == 150


def test_stream_rate_closes_windows_behind_the_watermark(spark):
    root = scratch(spark, "rate")
    rows = [(f"2024-01-01 00:{m:02d}:30", "a") for m in range(30)]
    df = spark.createDataFrame(rows, "ts STRING, tag STRING").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(f"{root}/in")
    source = incremental.read_increments(spark, f"{root}/in", df.schema)
    incremental.run_to_files(incremental.stream_rate(source), f"{root}/out", f"{root}/state")
    out = spark.read.parquet(f"{root}/out").collect()
    ends = [r["window_start"] + timedelta(minutes=5) for r in out]
    assert max(ends) <= datetime(2024, 1, 1, 0, 19, 30)
    assert {r["events"] for r in out if r["window_start"] >= datetime(2024, 1, 1)} == {5}


def test_identities_do_not_collide(spark):
    maps = [{"A": "1&B=2"}, {"A": "1", "B": "2"}, {"A": None}, {"A": ""}, {}, {"A": "1", "B": "2", "DESCRIPTION": "x"}]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(maps)], "i INT, m MAP<STRING, STRING>")
    found = [r[0] for r in df.orderBy("i").select(ledger.run_identity(F.lit("job"), F.col("m"))).collect()]
    assert len(set(found)) == 5 and found[1] == found[5]


def test_equal_requests_start_once(spark):
    ask = [(i, "job", {"DATE": d}) for i, d in enumerate(["2024-01-01", "2024-01-01", "2024-01-02", "2024-01-01"])]
    requests = spark.createDataFrame(ask, "request_id BIGINT, job_name STRING, params MAP<STRING, STRING>")
    jobs = spark.createDataFrame([("job",)], "job_name STRING")
    runs = spark.createDataFrame([], "identity STRING, execution_id BIGINT, status STRING")
    out = {r["request_id"]: r["decision"] for r in ledger.launch_decision(requests, jobs, runs).collect()}
    assert out == {0: "NEW", 1: "ALREADY_RUNNING", 2: "NEW", 3: "ALREADY_RUNNING"}
