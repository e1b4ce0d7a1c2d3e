"""The shape of physical plans: what reaches the scan, and what never meets in one task."""

import os
import re

import pytest
from pyspark.sql import functions as F

from millrace import bindings as b
from millrace import catalog
from millrace.operators import aggregates, faults, ledger, metrics, ordering, sinks
from millrace.plans import harvest
from millrace.session import scratch

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")

# Queries whose plan is built by running jobs and stored tables; their parts are checked by themselves.
STORED = [name for name in catalog.QUERIES if name.startswith("job_") or name in ("run_incremental", "stream_rate")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> str:
    """The plan in the form that prints all pushed filters in full."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in STORED])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(catalog.QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text, text


def one_task_windows(text: str) -> list[str]:
    """Windows that sit right on an exchange of everything into one task."""
    return re.findall(r"Window .*\n.*Sort .*\n.*Exchange SinglePartition.*\n", text)


@pytest.mark.parametrize("name", [n for n in catalog.QUERIES if n not in STORED])
def test_no_query_orders_everything_in_one_task(spark, monkeypatch, name):
    """With buckets of a few rows, as a large table has them, every window over everything holds bucket sums only."""
    real = ordering.running_total

    def cut_small(*args, **settings):
        return real(*args, **{**settings, "rows_per_bucket": 50})

    for module in (ordering, aggregates, ledger, metrics):
        monkeypatch.setattr(module, "running_total", cut_small)
    text = plan(catalog.QUERIES[name](spark, SF_DIR))
    assert all("_bucket" in x for x in one_task_windows(text)), text


def test_windows_over_everything_see_bucket_rows_only(spark):
    """A table above the limit is never ordered by one task; below it one task orders it."""
    rows = b.usage_record(spark, SF_DIR)
    text = plan(ordering.running_total(rows, ["id"], rows_per_bucket=100))
    found = one_task_windows(text)
    assert found and all("_bucket" in x for x in found), text
    assert len(re.findall(r"Exchange hashpartitioning\(_bucket", text)) == 1 and "Join" not in text


def test_small_groups_have_no_buckets(spark):
    rows = b.usage_record(spark, SF_DIR)
    text = plan(ordering.running_total(rows, ["id"], ["subscriber_id"]))
    assert "_bucket" not in text and not one_task_windows(text) and text.count("Exchange") == 1


def test_filters_reach_the_scan(spark):
    usage = b.usage_record(spark, SF_DIR)
    from millrace.sources import tables

    text = plan(tables.scan_one_range(usage, "id", 5, 10))
    assert "GreaterThanOrEqual(o_orderkey,5)" in text and "LessThanOrEqual(o_orderkey,10)" in text
    rows = harvest.outcomes(b.harvest_source(spark, SF_DIR))
    text = plan(faults.RunCut("FAILED", "ABORT", 77, 75).committed(rows))
    assert "LessThan(event_id,75)" in text


def test_resume_reads_behind_the_checkpoint(spark):
    points = spark.createDataFrame([("me", 700)], "identity STRING, last_id BIGINT")
    text = scans(faults.resume(b.harvest_source(spark, SF_DIR), points, "me"))
    assert "GreaterThanOrEqual(event_id,ScalarSubquery" in text, text


def test_failing_rows_are_looked_for_by_their_flags(spark):
    path = scratch(spark, "harvest_source")
    b.harvest_source(spark, SF_DIR).write.parquet(path)
    failing = faults.failing_rows(harvest.outcomes(spark.read.parquet(path)))
    text = scans(failing)
    pushed = "PushedFilters: [Or(Or(EqualTo(abort_flag,true),EqualTo(poison_flag,true)),GreaterThanOrEqual("
    assert pushed in text, text
    rows = harvest.outcomes(spark.read.parquet(path))
    assert failing.count() == rows.filter(F.col("outcome") != faults.OK).count() > 0


def test_near_prunes_the_target(spark):
    target = b.billed_before(spark, SF_DIR)
    new = target.filter("source_id > 1000")
    text = scans(sinks.near(target, new, "source_id"))
    low, high = new.agg(F.min("source_id"), F.max("source_id")).first()
    assert f"GreaterThanOrEqual(o_orderkey,{low}), LessThanOrEqual(o_orderkey,{high})" in text, text


def test_bounds_read_one_column(spark):
    text = plan(ordering.id_bounds(b.table(spark, SF_DIR, "orders"), "o_orderkey"))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def reads(spark, run) -> list[str]:
    """The plans of all queries that ``run`` executes."""
    context = spark.sparkContext._jsc.sc()
    store = spark._jsparkSession.sharedState().statusStore()
    context.listenerBus().waitUntilEmpty(30_000)
    seen = store.executionsCount()
    run()
    context.listenerBus().waitUntilEmpty(30_000)
    rows = store.executionsList(seen, 1_000_000)
    return [rows.apply(k).physicalPlanDescription() for k in range(rows.size())]


def test_range_outcomes_rank_slices_only(spark, tmp_path):
    """Two reads of the table, the second one of the slices around the first bad rows."""
    path = str(tmp_path / "usage")
    ordering.assign_id_range(b.usage_with_bad_row(spark, SF_DIR), "id", 4).write.parquet(path)
    rows = spark.read.parquet(path)
    bad = F.col("units") > 1 << 60
    plans = reads(spark, lambda: faults.range_outcomes(rows, bad, 100, slice_bits=6).collect())
    mine = [text for text in plans if "/usage]" in text]
    assert len(mine) == 2
    assert "GreaterThanOrEqual(id," in mine[1] and "LessThanOrEqual(id,1012)" in mine[1]
    low = int(re.search(r"GreaterThanOrEqual\(id,(\d+)\)", mine[1]).group(1))
    held = rows.filter(F.col("id").between(low, 1012)).count()
    assert 99 <= held < 99 + 2 * 64 and "WindowGroupLimit" not in mine[1]


def test_harvest_reads_its_source_twice(spark, tmp_path):
    path = str(tmp_path / "source")
    b.harvest_source(spark, SF_DIR).write.parquet(path)
    source = spark.read.parquet(path)
    root = scratch(spark, "harvest")
    plans = reads(spark, lambda: harvest.run_harvest(source, root, {"DATE": "2026-01-01"}, 1))
    mine = [text for text in plans if "/source]" in text]
    assert len(mine) == 2


def test_constraints_take_one_scan_and_one_exchange(spark):
    lines, parts = b.table(spark, SF_DIR, "lineitem"), b.table(spark, SF_DIR, "part")
    from millrace.functions import checks

    rules = [
        checks.NotNull("l_shipdate"),
        checks.Unique("l_orderkey"),
        checks.ForeignKey("l_partkey", parts, "p_partkey"),
        checks.ForeignKey("l_partkey", parts.filter("p_partkey > 5"), "p_partkey"),
    ]
    text = plan(checks.check_constraints(lines, rules))
    assert text.count("lineitem.parquet") == 1 and text.count("part.parquet") == 2
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_lines_are_not_shuffled(spark, tmp_path):
    from millrace.sources import files

    for i in range(3):
        (tmp_path / f"{i}.csv").write_text("a\nb\n\nc\n")
    text = plan(files.scan_lines(spark, str(tmp_path)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_stored_buckets_do_not_move(spark):
    from millrace.operators import bucketed

    table = bucketed.bucketed(spark, scratch(spark, "bucketed"), "id", "id BIGINT, run_id BIGINT")
    marks = spark.range(1000).select("id", F.lit(1).cast("bigint").alias("run_id"))
    table.insert_if_absent(marks)
    text = plan(table.absent(marks, unique_keys=True))
    assert text.count("Exchange") == 1 and re.search(rf"Exchange hashpartitioning\(id#\d+L, {table.buckets}\)", text), text
    assert "Bucketed: true" in text
    files_ = [f for f in os.listdir(table.path.removeprefix("file:")) if f.startswith("part-")]
    assert len(files_) <= table.buckets


def test_finished_ranges_are_pruned_and_many_ranges_stay_small(spark, tmp_path):
    path = str(tmp_path / "usage")
    spark.range(100_000).write.parquet(path)
    ledger = [("me", 1, n, 10 * n, 10 * n + 9, "COMPLETED" if n < 5000 else "FAILED") for n in range(10_000)]
    names = "identity STRING, run_id BIGINT, range_no INT, min_id BIGINT, max_id BIGINT, status STRING"
    todo = faults.restart_partitions(spark.read.parquet(path), spark.createDataFrame(ledger, names))
    text = scans(todo)
    assert "GreaterThanOrEqual(id,50000)" in text and len(text) < 20_000
    assert todo.filter("range_no <> id DIV 10").count() == 0 and todo.count() == 50_000


def test_versions_are_read_by_their_keys(spark):
    path, columns = scratch(spark, "versions"), "id BIGINT, value STRING"
    for n in range(4):
        rows = spark.range(100 * n, 100 * n + 150).select("id", F.lit(str(n)).alias("value"))
        sinks.replace_in(rows, path, "id", columns)
    assert sinks.versions_of(spark, path, "id", columns, {"id": (120, 130)}) == [1, 2]
    got = sinks.read_versions(spark, path, "id", columns, {"id": (120, 130)})
    assert {(r.id, r.value) for r in got.collect()} == {(i, "1") for i in range(120, 131)}
    assert "version IN (1,2)" in re.sub(r"#\d+L?", "", scans(got)).replace("version#", "version")
    assert sinks.read_versions(spark, path, "id", columns).count() == 450


def test_repeated_keys_shrink_before_the_shuffle(spark):
    lines = b.table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    text = plan(sinks.first_per_key(lines, "l_orderkey", ["l_linenumber"]))
    assert len(re.findall("Exchange", text)) == 1 and "partial_min" in text
