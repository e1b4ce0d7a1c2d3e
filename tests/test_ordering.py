import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators.ordering import (
    Bounds,
    assign_chunk,
    assign_id_range,
    id_bounds,
    id_ranges,
    number_rows,
    running_total,
)


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id BIGINT")


def ranges(spark, values, n):
    rows = id_ranges(id_bounds(ids(spark, values), "id"), n).orderBy("range_no").collect()
    return [(r["name"], r["min_id"], r["max_id"]) for r in rows]


def test_even_and_uneven_spans(spark):
    assert [r[1:] for r in ranges(spark, range(1, 101), 4)] == [(1, 24), (25, 48), (49, 72), (73, 100)]
    assert [r[1:] for r in ranges(spark, range(1, 102), 4)] == [(1, 25), (26, 50), (51, 75), (76, 101)]


def test_empty_table_has_one_empty_range(spark):
    assert ranges(spark, [], 4) == [("partition0", 1, 0)]
    assert assign_id_range(ids(spark, []), "id", 4).count() == 0


def test_single_id_falls_into_the_last_range(spark):
    found = ranges(spark, [42], 4)
    assert [r[1:] for r in found] == [(42, 41), (42, 41), (42, 41), (42, 42)]
    assert assign_id_range(ids(spark, [42]), "id", 4).first()["range_no"] == 3


def test_gaps_are_covered_without_overlap(spark):
    found = [r[1:] for r in ranges(spark, [1, 2, 3, 500, 1002], 4)]
    assert found[0][0] == 1 and found[-1][1] == 1002
    assert all(a[1] + 1 == b[0] for a, b in zip(found, found[1:]))
    assert len(ranges(spark, [10, 30], 10)) == 10


@pytest.mark.parametrize("values,n", [(range(1, 101), 4), ([10, 11, 30], 10), ([-7, 0, 5, 900], 3), ([5], 2)])
def test_assigned_number_matches_the_range(spark, values, n):
    df = ids(spark, values)
    limits = id_ranges(id_bounds(df, "id"), n)
    wrong = (
        assign_id_range(df, "id", n)
        .join(limits, "range_no", "left")
        .filter(~F.col("id").between(F.col("min_id"), F.col("max_id")) | F.col("min_id").isNull())
    )
    assert wrong.count() == 0


def test_fixed_bounds_keep_later_rows_in_the_last_range(spark):
    df = assign_id_range(ids(spark, [1, 24, 99]), "id", 4, Bounds.fixed(1, 24))
    assert [r["range_no"] for r in df.orderBy("id").collect()] == [0, 3, 3]


def brute(rows, with_weight):
    """Exclusive running sums per group, in (key, tie) order."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    out = {}
    for group, members in groups.items():
        total = 0
        for row in sorted(members, key=lambda r: (r[1], r[2])):
            out[row] = total
            total += row[3] if with_weight else 1
    return out


@pytest.mark.parametrize("shape", ["even", "hot_group", "uneven_keys", "hot_value", "null_group"])
@pytest.mark.parametrize("with_weight", [False, True])
def test_running_total_against_brute_force(spark, shape, with_weight):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        group = rng.randrange(20) if shape != "hot_group" or i % 3 else 0
        key = rng.randrange(10**6)
        if shape == "uneven_keys":
            key = 10**12 if i == 0 else rng.randrange(1000)
        if shape == "hot_value" and i % 3 == 0:
            key = 77
        if shape == "null_group" and i % 3 == 0:
            group = None
        rows.append((group, key, i, rng.randrange(100)))
    df = spark.createDataFrame(rows, "g BIGINT, k BIGINT, tie BIGINT, w BIGINT")
    out = running_total(
        df, ["k", "tie"], ["g"], "w" if with_weight else None, name="at", total="all", rows_per_bucket=100
    )
    want = brute(rows, with_weight)
    got = {(r["g"], r["k"], r["tie"], r["w"]): r["at"] for r in out.collect()}
    assert got == want
    sums = defaultdict(int)
    for row in rows:
        sums[row[0]] += row[3] if with_weight else 1
    assert {r["g"]: r["all"] for r in out.select("g", "all").distinct().collect()} == dict(sums)


def test_positions_over_the_whole_table(spark):
    values = random.Random(3).sample(range(10**9), 5000)
    out = running_total(ids(spark, values), ["id"], rows_per_bucket=200)
    assert [r["position"] for r in out.orderBy("id").collect()] == list(range(5000))
    assert running_total(ids(spark, []), ["id"]).count() == 0


@pytest.mark.parametrize("rows_per_bucket", [10, 10**6])
def test_unusual_values_keep_their_order(spark, rows_per_bucket):
    inf, nan = float("inf"), float("nan")
    values = [(v, i) for i, v in enumerate([None, -inf, -1e308, -2.5, 0.0, 3.0, 1e308, inf, nan] * 3)]
    df = spark.createDataFrame(values, "v DOUBLE, tie BIGINT")
    out = running_total(df, ["v", "tie"], rows_per_bucket=rows_per_bucket).orderBy("position")
    want = [r["tie"] for r in df.orderBy("v", "tie").collect()]
    assert [r["tie"] for r in out.collect()] == want


def test_chunks(spark):
    out = assign_chunk(ids(spark, range(0, 30, 3)), "id", 4).orderBy("id").collect()
    assert [r["chunk_no"] for r in out] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]


def test_rows_are_numbered_without_gaps(spark):
    df = spark.range(0, 1000, 1, 7).withColumnRenamed("id", "v")
    out = number_rows(df, start=5).orderBy("id").collect()
    assert [r["id"] for r in out] == list(range(5, 1005))
    assert [r["v"] for r in out] == list(range(1000))


def test_only_large_groups_are_cut(spark, monkeypatch):
    """15,000 rows in small groups and a group with a third of all rows."""
    from millrace.operators import ordering

    rows = spark.range(20_000).select(
        F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("id") % 1500).alias("g"), F.col("id").alias("k")
    )
    seen = []
    monkeypatch.setattr(ordering, "_bucket_sums", lambda split, *a, f=ordering._bucket_sums: seen.append(split) or f(split, *a))
    out = running_total(rows, ["k"], ["g"], total="n", rows_per_bucket=1000)
    assert [s.filter("g IS NOT NULL").count() for s in seen] == [0]
    assert seen[0].select("_bucket").distinct().count() >= 5
    got = out.groupBy("g").agg(F.count("*").alias("n"), F.max("position").alias("p"), F.countDistinct("position").alias("d"))
    assert got.filter("p <> n - 1 OR d <> n").count() == 0 and out.count() == 20_000
