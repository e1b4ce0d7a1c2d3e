"""Runs over random rows against a plain chunk loop, and restarts against one clean run."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import faults
from millrace.plans import billing, harvest
from millrace.plans.harvest import run_harvest
from millrace.session import scratch

PARAMS = {"DATE": "2026-01-01"}
MAX = 2**63 - 1


def random_rows(seed):
    rng = random.Random(seed)
    ids = sorted(rng.sample(range(1000), rng.randrange(20, 60)))
    return [
        (
            i,
            f"p{i}",
            rng.random() < 0.1,
            rng.choice([0, 0, 0, 0, 0, 1, 2, 3, 7]),
            rng.random() < 0.02,
        )
        for i in ids
    ]


def source(spark, rows):
    return spark.createDataFrame(
        rows,
        "id BIGINT, payload STRING, poison_flag BOOLEAN, transient_fail_until_attempt INT, abort_flag BOOLEAN",
    )


def outcome(row, retry_limit):
    _, _, poison, threshold, abort = row
    if abort:
        return faults.ABORT
    if poison:
        return faults.SKIP
    return faults.EXHAUSTED if threshold >= retry_limit else faults.OK


def chunk_loop(rows, chunk, limit, retry_limit=3):
    """Status, processed ids, and skipped ids up to the failure, row by row."""
    done, skipped, open_, seen = [], [], [], 0
    for row in rows:
        kind = outcome(row, retry_limit)
        if kind == faults.ABORT or (kind != faults.OK and len(skipped) == limit):
            return "FAILED", done, skipped
        if kind == faults.OK:
            open_.append(row[0])
        else:
            skipped.append(row[0])
        seen += 1
        if seen % chunk == 0:
            done, open_ = done + open_, []
    return "COMPLETED", done + open_, skipped


@pytest.mark.parametrize("seed", range(8))
def test_a_run_equals_the_chunk_loop(spark, seed):
    rng = random.Random(100 + seed)
    rows, chunk, limit = random_rows(seed), rng.choice([1, 3, 5, 8]), rng.choice([0, 2, 5, 50])
    run = run_harvest(source(spark, rows), scratch(spark, "h"), PARAMS, 1, chunk=chunk, skip_limit=limit)
    status, done, skipped = chunk_loop(rows, chunk, limit)
    assert run.status == status
    assert sorted(r["id"] for r in run.processed.collect()) == done
    assert sorted(r["source_id"] for r in run.dead_letters.collect()) == skipped


@pytest.mark.parametrize("seed", range(3))
def test_restarts_end_like_one_clean_run(spark, seed):
    rows, root = random_rows(seed), scratch(spark, "h")
    sound = [(i, p, False, t if t < 3 else 0, False) for i, p, _, t, _ in rows]
    broken = rows
    for run_id in range(1, 4):
        run = run_harvest(source(spark, broken), root, PARAMS, run_id, skip_limit=1)
        if run.status == "COMPLETED":
            break
        cut = run.cut.cut
        broken = [s if s[0] <= cut else r for s, r in zip(sound, broken, strict=True)]
    run = run_harvest(source(spark, sound), root, PARAMS, 9)
    assert run.status == "COMPLETED"
    done = [r["id"] for r in run.processed.collect()]
    assert len(done) == len(set(done))
    letters = {r["source_id"] for r in run.dead_letters.collect()}
    assert set(done) | letters == {row[0] for row in rows}


@pytest.mark.parametrize("seed", range(4))
def test_partitioned_billing_equals_a_loop_per_range(spark, seed):
    rng = random.Random(seed)
    ids = sorted(rng.sample(range(1, 400), 60))
    bad = set(rng.sample(ids, rng.choice([0, 1, 3])))
    schema = "id BIGINT, subscriber_id BIGINT, units BIGINT, rate BIGINT"
    good_rows = [(i, i % 5, i + 1, 3) for i in ids]
    bad_rows = [(i, s, MAX if i in bad else u, r) for i, s, u, r in good_rows]
    grid, chunk, root = 3, rng.choice([1, 4, 7]), scratch(spark, "b")
    low, high = ids[0], ids[-1]
    width = (high - low) // grid
    want = []
    for number in range(grid):
        mine = [i for i in ids if min(grid - 1, (i - low) // width) == number]
        first = next((k for k, i in enumerate(mine) if i in bad), None)
        want += mine if first is None else mine[: first // chunk * chunk]
    run = billing.run_billing(spark.createDataFrame(bad_rows, schema), root, PARAMS, 1, grid, chunk)
    assert sorted(r["source_id"] for r in run.charges.collect()) == sorted(want)
    assert run.status == ("FAILED" if bad else "COMPLETED")
    run = billing.run_billing(spark.createDataFrame(good_rows, schema), root, PARAMS, 2, grid, chunk)
    assert run.status == ("COMPLETED" if bad else "ALREADY_COMPLETE")
    totals = run.charges.agg(F.count("*"), F.count_distinct("source_id"), F.sum("cost")).first()
    assert tuple(totals) == (60, 60, sum((i + 1) * 3 for i in ids))


def test_outcomes_do_not_depend_on_the_order_of_rows(spark):
    rows = random_rows(5)
    shuffled = random.Random(1).sample(rows, len(rows))
    a, b = (harvest.outcomes(source(spark, r)) for r in (rows, shuffled))
    assert faults.run_cut(a) == faults.run_cut(b)
