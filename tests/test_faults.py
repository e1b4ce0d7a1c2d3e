import pytest
from pyspark.sql import functions as F

from millrace.operators import faults
from millrace.plans import harvest
from millrace.session import scratch

SCHEMA = (
    "id BIGINT, payload STRING, poison_flag BOOLEAN, transient_fail_until_attempt INT, abort_flag BOOLEAN"
)
PARAMS = {"DATE": "2026-01-01", "ATTEMPT_NUMBER": "1"}


def row(id_, poison=False, transient=0, abort=False):
    return (id_, f"payload-{id_}", poison, transient, abort)


def source(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def harvest_once(spark, rows, root=None, params=PARAMS, run_id=1, **settings):
    root = root or scratch(spark, "harvest")
    run = harvest.run_harvest(source(spark, rows), root, params, run_id, **settings)
    done = sorted(r["id"] for r in run.processed.collect())
    letters = sorted(
        (r["source_id"], r["failure_type"], r["failure_phase"], r["attempt_count"])
        for r in run.dead_letters.collect()
    )
    return run, done, letters


def test_all_rows_good(spark):
    run, done, letters = harvest_once(spark, [row(i) for i in range(1, 6)])
    assert (run.status, done, letters) == ("COMPLETED", [1, 2, 3, 4, 5], [])


def test_one_poison_row(spark):
    run, done, letters = harvest_once(spark, [row(i) for i in range(10, 14)] + [row(14, poison=True)])
    assert run.status == "COMPLETED"
    assert done == [10, 11, 12, 13]
    assert letters == [(14, "SKIP", "PROCESS", 1)]


def test_three_poison_rows(spark):
    rows = [row(i) for i in (20, 21, 22)] + [row(i, poison=True) for i in (23, 24, 25)]
    run, done, letters = harvest_once(spark, rows)
    assert run.status == "COMPLETED" and done == [20, 21, 22]
    assert [letter[1] for letter in letters] == ["SKIP"] * 3


def test_six_poison_rows_pass_the_limit(spark):
    run, done, letters = harvest_once(spark, [row(i, poison=True) for i in range(30, 36)])
    assert (run.status, run.cut.reason, run.cut.cut, done) == ("FAILED", "SKIP_LIMIT", 35, [])
    assert [letter[0] for letter in letters] == [30, 31, 32, 33, 34]


def test_five_poison_and_one_exhausted(spark):
    rows = [row(i, poison=True) for i in range(70, 75)] + [row(75, transient=10)]
    assert harvest_once(spark, rows)[0].status == "FAILED"


def test_transient_rows(spark):
    run, done, letters = harvest_once(spark, [row(41, transient=1), row(50, transient=1), row(51, transient=2)])
    assert (run.status, done, letters) == ("COMPLETED", [41, 50, 51], [])
    run, done, letters = harvest_once(spark, [row(60), row(61, transient=10), row(62)])
    assert (run.status, done) == ("COMPLETED", [60, 62])
    assert letters == [(61, "RETRY_EXHAUSTED", "PROCESS", 4)]


def test_abort_and_restart(spark):
    root = scratch(spark, "harvest")
    rows = [row(i, abort=i == 6) for i in range(1, 11)]
    run, done, letters = harvest_once(spark, rows, root)
    assert (run.status, run.cut.reason, done) == ("FAILED", "ABORT", [1, 2, 3, 4, 5])
    run, done, letters = harvest_once(spark, [row(i) for i in range(1, 11)], root, run_id=2)
    assert (run.status, done, letters) == ("COMPLETED", list(range(1, 11)), [])
    assert run.counters.first()["read_count"] == 5
    # Another identity reads from the front, and the guard adds nothing.
    other = {**PARAMS, "ATTEMPT_NUMBER": "2"}
    run, done, _ = harvest_once(spark, [row(i) for i in range(1, 11)], root, other, run_id=3)
    assert run.counters.first()["read_count"] == 10
    assert done == list(range(1, 11))
    assert {r["run_id"] for r in run.processed.collect()} == {1, 2}


def test_a_description_does_not_change_the_identity(spark):
    root = scratch(spark, "harvest")
    harvest_once(spark, [row(1), row(2)], root)
    run, done, _ = harvest_once(
        spark, [row(1), row(2), row(3)], root, {**PARAMS, "DESCRIPTION": "again"}, run_id=2
    )
    assert run.counters.first()["read_count"] == 1 and done == [1, 2, 3]


def test_development_seed(spark):
    rows = [row(i) for i in range(1, 11)] + [row(11, poison=True), row(12, poison=True)]
    rows += [row(13, transient=1), row(14, transient=2), row(15, transient=3), row(16, abort=True)]
    run, done, letters = harvest_once(spark, rows)
    assert run.status == "FAILED"
    assert done == list(range(1, 11)) + [13, 14]
    assert [(x[0], x[1]) for x in letters] == [(11, "SKIP"), (12, "SKIP"), (15, "RETRY_EXHAUSTED")]


def test_a_repeated_broken_run_stores_nothing_twice(spark):
    root = scratch(spark, "harvest")
    rows = [row(1), row(2, poison=True), row(3)]
    harvest_once(spark, rows, root)
    _, done, letters = harvest_once(spark, rows, root, {**PARAMS, "ATTEMPT_NUMBER": "9"}, run_id=1)
    assert done == [1, 3] and len(letters) == 1


def test_date_is_required(spark):
    for params in ({}, {"DATE": " "}, {"DATE": "2026-01"}, {"DATE": "2026-01-01T10:00"}):
        with pytest.raises(ValueError, match="DATE"):
            harvest_once(spark, [row(1)], params=params)


def test_precedence_and_retry_columns(spark):
    rows = [row(1, poison=True, abort=True), row(2, poison=True, transient=5), row(3, transient=2), row(4)]
    out = faults.retry_outcome(faults.classify(source(spark, rows))).orderBy("id").collect()
    assert [r["fault"] for r in out] == ["ABORT", "POISON", "TRANSIENT", "NONE"]
    assert [r["calls"] for r in out] == [1, 1, 3, 1]
    exhausted = faults.retry_outcome(faults.classify(source(spark, [row(5, transient=3)]))).first()
    assert (exhausted["outcome"], exhausted["calls"], exhausted["attempt_count"]) == ("RETRY_EXHAUSTED", 3, 4)


def test_skip_limits_by_position(spark):
    rows = harvest.outcomes(source(spark, [row(i, poison=i % 2 == 0, abort=i == 91) for i in range(100)]))
    found = [faults.run_cut(rows, limit) for limit in (3, 44, 45, 60)]
    assert [(r.reason, r.cut) for r in found] == [("SKIP_LIMIT", 6), ("SKIP_LIMIT", 88), ("SKIP_LIMIT", 90), ("ABORT", 91)]
    cuts = [faults.skip_limit_cut(rows, limit).first()["cut"] for limit in (3, 48, 49, 60)]
    assert cuts == [6, 96, 98, None]


def test_commit_boundary_against_brute_force(spark):
    keys = [3 * i + i % 2 for i in range(57)]
    df = spark.createDataFrame([(k,) for k in keys], "id BIGINT")
    for chunk in (1, 2, 5, 7, 100):
        for at in (0, 4, 5, 30, 56):
            want = keys[at // chunk * chunk]
            assert faults.commit_boundary(df, keys[at], chunk) == want


def test_range_outcomes_against_brute_force(spark):
    rows = [(i, i % 3, i in (31, 50, 77)) for i in range(100)]
    df = spark.createDataFrame(rows, "id BIGINT, range_no INT, bad BOOLEAN")
    for chunk in (1, 4, 10):
        got = {r["range_no"]: r for r in faults.range_outcomes(df, F.col("bad"), chunk).collect()}
        for number in range(3):
            members = [r for r in rows if r[1] == number]
            firsts = [i for i, r in enumerate(members) if r[2]]
            if firsts:
                assert got[number]["boundary"] == members[firsts[0] // chunk * chunk][0]
                assert got[number]["status"] == "FAILED"
            else:
                assert got[number]["boundary"] is None
