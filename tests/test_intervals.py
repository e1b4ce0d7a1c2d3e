"""Rows of intervals against plain loops, dead letters of all phases, uploads by name, sketches, versions."""

import random
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import checks
from millrace.operators import bucketed, faults, metrics, sinks
from millrace.operators.intervals import Interval, covering, rows_of
from millrace.plans import person_etl
from millrace.schemas import DEAD_LETTER
from millrace.session import dropped, scratch, stored
from millrace.sources import files
from millrace.streaming import incremental


def test_covering_keeps_the_largest_gaps():
    spans = [Interval(10, 19), Interval(20, 29), Interval(50, 59), Interval(61, 70), Interval(5, 4)]
    assert covering(spans) == [(10, 29), (50, 59), (61, 70)]
    assert covering(spans, most=2) == [(10, 29), (50, 70)]
    assert covering(spans, most=1) == [(10, 70)] and covering([]) == []


@pytest.mark.parametrize("count, low, high", [(3, 0, 100), (200, -500, 5000), (40, 1 << 40, 1 << 41), (30, 0, 40)])
def test_rows_of_intervals(spark, count, low, high):
    rng = random.Random(count)
    cuts = sorted(rng.sample(range(low, high), min(2 * count, high - low) // 2 * 2))
    intervals = [Interval(a, b, (n, f"r{n}")) for n, (a, b) in enumerate(zip(cuts[::2], cuts[1::2]))]
    keys = sorted({*cuts, *(rng.randrange(low - 10, high + 10) for _ in range(500))})
    df = spark.createDataFrame([(k,) for k in keys], "id BIGINT")
    fields = [T.StructField("no", T.IntegerType()), T.StructField("name", T.StringType())]
    got = sorted(tuple(r) for r in rows_of(df, intervals, fields).collect())
    assert got == [(k, *i.values) for k in keys for i in intervals if i.low <= k <= i.high]
    assert rows_of(df, [], fields).count() == 0


@pytest.mark.parametrize("bits", [2, 4, 16])
def test_range_outcomes_by_slices(spark, bits):
    rng = random.Random(bits)
    ids = sorted(rng.sample(range(-300, 900), 400))
    rows = [(i, n % 5 if i % 3 else n // 80, rng.random() < 0.01) for n, i in enumerate(ids)]
    df = spark.createDataFrame(rows, "id BIGINT, range_no INT, bad BOOLEAN")
    for chunk in (1, 3, 25, 1000):
        got = {r.range_no: r for r in faults.range_outcomes(df, F.col("bad"), chunk, slice_bits=bits).collect()}
        for number in {r[1] for r in rows}:
            members = [r for r in rows if r[1] == number]
            at = next((n for n, r in enumerate(members) if r[2]), None)
            want = None if at is None else members[at // chunk * chunk][0]
            assert (got[number].boundary, got[number].read_rows) == (want, len(members)), (number, chunk)


def test_read_and_write_dead_letters(spark, tmp_path):
    (tmp_path / "people.csv").write_text(
        'Ann,Lee,a@x,smith\nbroken\nBo,,b@x,baker\n"Cy, Jr",Poe,c@x,clerk\na,b,c,d,e\n\nbroken\nDi,Fox,d@x,' + "x" * 16 + "\n"
    )
    path = str(tmp_path / "people.csv")
    rows, broken = files.scan_permissive(spark, path, person_etl.CSV_COLUMNS)
    assert [r.first_name for r in rows.collect()] == ["Ann", "Bo", "Cy, Jr", "Di"]
    assert sorted((r.line, r.n_fields) for r in broken.collect()) == [("a,b,c,d,e", 5), ("broken", 1), ("broken", 1)]
    lookup = spark.createDataFrame([(i, 1.0) for i in range(1, 5)], "id BIGINT, value DOUBLE").withColumn("value", F.col("value").cast("decimal(19,2)"))
    accepted = spark.createDataFrame([(0, True)], "group_no BIGINT, accepted BOOLEAN")
    root = scratch(spark, "etl")
    for _ in range(2):  # a repeated run stores nothing twice
        person_etl.run_person_etl(spark, path, lookup, accepted, root, "2026-01-01", 1, skip_limit=3)
    letters = sinks.read_table(spark, f"{root}/dead_letter", DEAD_LETTER).collect()
    read = [r for r in letters if r.failure_phase == "READ"]
    assert sorted(r.raw_payload for r in read) == ["a,b,c,d,e", "broken", "broken"]
    assert all(r.source_id is None and r.failure_type == "SKIP" and r.attempt_count == 1 for r in read)
    assert {r.exception_msg for r in read} == {"Line has 1 fields, 4 expected", "Line has 5 fields, 4 expected"}
    write = {r.source_id: r.exception_msg for r in letters if r.failure_phase == "WRITE"}
    assert write == {2: "Row breaks not_null(last_name)", 4: "Row breaks max_length(profession)"}
    people = sinks.read_table(spark, f"{root}/persons_v2", person_etl.PERSONS_V2)
    assert sorted(r.source_id for r in people.collect()) == [1, 3]
    # One line too many: its letters are stored, its rows are not.
    root = scratch(spark, "etl")
    with pytest.raises(person_etl.SkipLimitExceeded):
        person_etl.run_person_etl(spark, path, lookup, accepted, root, "2026-01-01", 1, skip_limit=2)
    assert sinks.read_table(spark, f"{root}/dead_letter", DEAD_LETTER).count() == 3
    assert sinks.read_table(spark, f"{root}/persons", person_etl.PERSONS).count() == 0


def test_row_rules_have_names():
    with pytest.raises(ValueError):
        checks.first_violation([checks.Unique("id")])


def test_constraints_against_loops(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(12)]), rng.choice([None, "a", "bb", "ccc"]), rng.choice([1.0, 2.5, None])) for _ in range(300)]
    df = spark.createDataFrame(rows, "a INT, b STRING, c DOUBLE")
    parent = spark.createDataFrame([(float(i),) for i in range(0, 12, 2)] * 2 + [(None,)], "k DOUBLE")
    rules = [
        checks.ForeignKey("a", parent, "k"),
        checks.Unique("b"),
        checks.NotNull("c"),
        checks.Unique("a"),
        checks.MaxLength("b", 2),
        checks.ForeignKey("a", parent.filter("k > 4"), "k"),
        checks.AtLeast("a", 3),
    ]
    got = [(r.rule, r.violations) for r in checks.check_constraints(df, rules).collect()]
    keys = [r[0] for r in rows if r[0] is not None]
    assert got == [
        ("foreign_key(a)", sum(k % 2 for k in keys)),
        ("unique(b)", 3),
        ("not_null(c)", sum(r[2] is None for r in rows)),
        ("unique(a)", 12),
        ("max_length(b)", sum(r[1] == "ccc" for r in rows)),
        ("foreign_key(a)", sum(k % 2 or k <= 4 for k in keys)),
        ("at_least(a)", sum(k < 3 for k in keys)),
    ]
    empty = checks.check_constraints(df.limit(0), rules).collect()
    assert [r.violations for r in empty] == [0] * 7
    only_rows = checks.check_constraints(df, [checks.NotNull("c")]).collect()
    assert [r.violations for r in only_rows] == [sum(r[2] is None for r in rows)]


def test_two_writers_of_versions_lose_nothing(spark):
    path, columns = scratch(spark, "versions"), "id BIGINT, value STRING"

    def write(n):
        sinks.replace_in(spark.range(10 * n, 10 * n + 10).select("id", F.lit(str(n)).alias("value")), path, "id", columns)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = {r.id: r.value for r in sinks.read_versions(spark, path, "id", columns).collect()}
    assert got == {i: str(i // 10) for i in range(40)}
    assert sinks.versions_of(spark, path, "id", columns) == [1, 2, 3, 4]
    sinks.replace_in(spark.range(0).select("id", F.lit("x").alias("value")), path, "id", columns)
    assert sinks.versions_of(spark, path, "id", columns) == [1, 2, 3, 4]
    sinks.compact_versions(spark, path, "id", columns, path + "-2")
    assert sinks.read_versions(spark, path + "-2", "id", columns).count() == 40


def test_streamed_windows_equal_the_batch_after_a_restart(spark, tmp_path):
    """Two files in two runs; the last windows are there, and the first run's last windows grow in the second."""
    start = datetime(2026, 1, 1)
    rows = [(start + timedelta(seconds=11 * i), f"t{i % 3}") for i in range(300)]
    source, root = str(tmp_path / "in"), scratch(spark, "stream")
    key, columns = ["tag", "window_start"], "tag STRING, window_start TIMESTAMP, events BIGINT, per_minute DOUBLE"
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part, "ts TIMESTAMP, tag STRING").coalesce(1).write.mode("append").parquet(source)
        stream = incremental.read_increments(spark, source, "ts TIMESTAMP, tag STRING")
        incremental.run_to_versions(incremental.stream_rate(stream), f"{root}/out", key, columns, f"{root}/state")
        want = metrics.rate_per_minute(spark.read.parquet(source))
        got = sinks.read_versions(spark, f"{root}/out", key, columns)
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_sketched_quantiles(spark):
    start = datetime(2026, 1, 1)
    rng = random.Random(8)
    rows = [(start + timedelta(seconds=rng.randrange(900)), rng.choice("ab"), rng.choice([None, rng.expovariate(1)])) for _ in range(20000)]
    events = spark.createDataFrame(rows, "ts TIMESTAMP, tag STRING, duration DOUBLE")
    found = metrics.sliding_quantile(events)
    errors = metrics.rank_error(events, found).collect()
    assert len(errors) == found.count() == 2 * 19 and max(r.rank_error for r in errors) < 0.03
    few = events.limit(150)
    exact = metrics.rank_error(few, metrics.sliding_quantile(few)).collect()
    assert max(r.rank_error for r in exact) == 0


def test_bucketed_table_in_a_new_session(spark):
    path, columns = scratch(spark, "bucketed"), "id BIGINT, value STRING"
    first = bucketed.bucketed(spark, path, "id", columns, buckets=5)
    rows = spark.range(100).select("id", F.lit("a").alias("value"))
    first.insert_if_absent(rows.unionByName(rows))
    again = bucketed.bucketed(spark, path, "id", columns, buckets=9)
    assert again.buckets == 5
    more = spark.range(50, 150).select("id", F.lit("b").alias("value"))
    again.insert_if_absent(more, unique_keys=True)
    assert {r.id: r.value for r in again.read().collect()} == {i: "a" if i < 100 else "b" for i in range(150)}
    assert spark.read.parquet(path).count() == 150
    with pytest.raises(ValueError):
        bucketed.bucketed(spark, path, "value", columns)


def test_scratch_can_be_dropped(spark, tmp_path):
    df, path = stored(spark.range(5), "some")
    assert df.count() == 5
    dropped(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    with pytest.raises(ValueError):
        dropped(spark, str(tmp_path / "mine" / "x"))
