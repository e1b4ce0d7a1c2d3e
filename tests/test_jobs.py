import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions.text import payload_item
from millrace.operators import faults, joins, sinks
from millrace.operators.aggregates import bundle_entries, bundle_manifest
from millrace.plans import bundles, person_etl, recovery, tickets
from millrace.schemas import DISPATCHED_GROUP, GROUP_MEMBER, MARK, PERSONS_V2
from millrace.session import scratch
from millrace.sources import files

SECRET = "0123456789abcdef0123456789abcdef"
TICKETS = (
    "id BIGINT, event_id BIGINT, ticket_code STRING, holder_name STRING, event_name STRING,"
    " event_location STRING, seat STRING, event_datetime TIMESTAMP_NTZ, processed BOOLEAN"
)
FILES = (
    "ticket_id BIGINT, storage_type STRING, storage_path STRING, checksum_sha256 STRING, file_size_bytes BIGINT"
)


def ticket_rows(spark, pairs):
    rows = [(i, e, f"C-{i}", "Ann", "Fest", None, None, False) for i, e in pairs]
    df = spark.createDataFrame(rows, TICKETS.replace(" event_datetime TIMESTAMP_NTZ,", ""))
    at = F.lit("2024-09-15 09:00:00").cast("timestamp_ntz")
    return df.withColumn("event_datetime", at)


def file_rows(spark, ids, path="/data/{}.pdf"):
    rows = [(i, "LOCAL", path.format(i), hashlib.sha256(str(i).encode()).hexdigest(), 10 + i) for i in ids]
    return spark.createDataFrame(rows, FILES)


# ---- tickets ------------------------------------------------------------------------------


def test_all_tickets_of_an_event(spark):
    root = scratch(spark, "tickets")
    sold = ticket_rows(spark, [(1, 10), (2, 10), (3, 10)])
    registry, marks = tickets.run_tickets(sold, root, SECRET, 1)
    assert sorted(r["storage_path"][-5:] for r in registry.collect()) == ["1.pdf", "2.pdf", "3.pdf"]
    assert sorted(r["id"] for r in marks.collect()) == [1, 2, 3]
    registry, marks = tickets.run_tickets(sold, root, SECRET, 2)
    assert registry.count() == 3 and marks.count() == 3
    for row in spark.read.parquet(f"{root}/generated_files").collect():
        content = row["document"].encode()
        assert row["checksum_sha256"] == hashlib.sha256(content).hexdigest()
        assert row["file_size_bytes"] == len(content)
        lines = row["document"].split("\n")
        assert lines[2:5] == ["—", "—", "2024-09-15 09:00"]
        assert lines[6].startswith(f"{row['ticket_id']}|C-{row['ticket_id']}.")


def test_event_filter_and_empty_event(spark):
    root = scratch(spark, "tickets")
    sold = ticket_rows(spark, [(1, 20), (2, 21)])
    registry, marks = tickets.run_tickets(sold, root, SECRET, 1, event_id="20")
    assert [r["ticket_id"] for r in registry.collect()] == [1] and marks.count() == 1
    registry, _ = tickets.run_tickets(sold, scratch(spark, "none"), SECRET, 1, event_id="999")
    assert registry.count() == 0


def test_a_run_broken_before_its_marks_is_completed(spark):
    root = scratch(spark, "tickets")
    sold = ticket_rows(spark, [(1, 10), (2, 10)])
    documents = tickets.ticket_documents(sold, SECRET)
    registry = tickets.stored_registry(spark, root)
    registry.append(registry.placed(tickets.registry_rows(documents, "/x")))
    registry, marks = tickets.run_tickets(sold, root, SECRET, 1)
    assert registry.count() == 2 and sorted(r["id"] for r in marks.collect()) == [1, 2]


def test_parameters_of_the_ticket_job(spark):
    sold = ticket_rows(spark, [(1, 10)])
    for secret, event in ((None, None), ("short", None), (SECRET, "x1")):
        with pytest.raises(ValueError):
            tickets.run_tickets(sold, scratch(spark, "t"), secret, 1, event)


def test_write_expecting(spark):
    target = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id BIGINT")
    registry = spark.createDataFrame([(3,)], "ticket_id BIGINT")

    def write(*ids):
        df = spark.createDataFrame([(i,) for i in ids], "ticket_id BIGINT")
        return sinks.write_expecting(df, target, registry, "ticket_id", "id").count()

    assert write(1) == 1
    for ids in ((2,), (3,), (4,), (1, 1)):
        with pytest.raises(PySparkException, match="1 expected"):
            write(*ids)


# ---- bundles ------------------------------------------------------------------------------


def test_bundle_of_one_event(spark):
    root = scratch(spark, "bundles")
    sold = ticket_rows(spark, [(1, 10), (2, 10), (3, 10), (4, 21), (5, 21)])
    registered = file_rows(spark, range(1, 6))
    out = bundles.run_bundles(registered, sold, root, "10").collect()
    assert len(out) == 1
    row = out[0]
    assert (row["event_id"], row["ticket_count"], row["status"]) == (10, 3, "COMPLETED")
    assert row["storage_path"] == "bundles/event-10.zip" and len(row["checksum_sha256"]) == 64
    assert row["file_size_bytes"] == 36
    again = bundles.run_bundles(registered, sold, root, "10").collect()
    assert again == out
    assert bundles.run_bundles(registered, sold, root, "999").count() == 1
    both = bundles.run_bundles(registered, sold, root, "21")
    assert sorted(r["event_id"] for r in both.collect()) == [10, 21]


def test_a_new_bundle_replaces_the_old_one(spark):
    root = scratch(spark, "bundles")
    sold = ticket_rows(spark, [(1, 10), (2, 10)])
    first = bundles.run_bundles(file_rows(spark, [1]), sold, root, "10").first()
    second = bundles.run_bundles(file_rows(spark, [1, 2]), sold, root, "10").collect()
    assert len(second) == 1 and second[0]["ticket_count"] == 2
    assert second[0]["checksum_sha256"] != first["checksum_sha256"]


@pytest.mark.parametrize("local", [True, False])
def test_a_file_per_ticket(spark, monkeypatch, local):
    """One file per key, whole and replaced when written again; on local storage without a folder per key."""
    folder = scratch(spark, "ticket_files")
    if not local:
        monkeypatch.setattr(sinks, "local_path", lambda *_: None)
    rows = [(i, f"T-{i}|ü") for i in range(600)] + [(7, "again"), (8, None), (-1, None)]
    sinks.write_files(spark.createDataFrame(rows, "id BIGINT, value STRING").repartition(5), folder, "id")
    sinks.write_files(spark.createDataFrame([(5, "new")], "id BIGINT, value STRING"), folder, "id")
    read = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"id=(-?\d+)", 1).cast("int")
    got = {n: sorted(text.splitlines()) for n, text in read.select(number, "value").collect()}
    want = {i: sorted((text or "") for k, text in rows if k == i) for i in range(-1, 600)}
    assert got == want | {5: ["new"]}
    assert files.scan_files(spark, folder, "*.txt").count() == 601
    if local:
        folders = files.scan_files(spark, folder).select(F.regexp_extract("path", "(.*)/", 1)).distinct()
        assert folders.count() <= sinks.FILE_FOLDERS


def test_tickets_are_written_as_files_without_a_folder_each(spark, monkeypatch):
    from millrace import bindings, catalog

    made = []
    keep = lambda session, name: made.append(scratch(session, name)) or made[-1]
    monkeypatch.setattr(catalog, "scratch", keep)
    sf_dir = "/root/testdata/sf0.001"
    out = catalog.QUERIES["job_event_bundles_files"](spark, sf_dir).collect()
    folder = next(path for path in made if path.endswith("ticket_files"))
    found = files.scan_files(spark, folder, "*.txt").select("path").collect()
    assert len(found) == bindings.generated_files(spark, sf_dir).count() == sum(row["ticket_count"] for row in out)
    assert len({row["path"].rsplit("/", 1)[0] for row in found}) <= sinks.FILE_FOLDERS < len(found)


def test_a_missing_file_stores_nothing(spark):
    root = scratch(spark, "bundles")
    sold = ticket_rows(spark, [(1, 10), (2, 10), (3, 11)])
    registered = file_rows(spark, [1, 2, 3])
    found = spark.createDataFrame([("/data/1.pdf",), ("/data/3.pdf",)], "path STRING")
    with pytest.raises(PySparkException, match="missing file"):
        bundles.run_bundles(registered, sold, root, "10", found)
    out = bundles.run_bundles(registered, sold, root, "11", found)
    assert [r["event_id"] for r in out.collect()] == [11]
    with pytest.raises(ValueError, match="EVENT_ID"):
        bundles.run_bundles(registered, sold, root, "0")


def test_digest_ignores_order_and_sees_content(spark):
    sold = ticket_rows(spark, [(i, 1) for i in range(50)])

    def digest(df):
        return bundle_manifest(bundle_entries(df, sold)).first()["checksum_sha256"]

    registered = file_rows(spark, range(50))
    whole = digest(registered)
    assert digest(registered.orderBy(F.desc("ticket_id")).repartition(5)) == whole
    assert digest(registered.filter("ticket_id <> 7")) != whole
    other = F.when(F.col("ticket_id") == 7, F.lit("0" * 64)).otherwise(F.col("checksum_sha256"))
    assert digest(registered.withColumn("checksum_sha256", other)) != whole


def test_equal_file_names(spark):
    sold = ticket_rows(spark, [(100, 1), (200, 1)])
    entries = bundle_entries(file_rows(spark, [100, 200], "/data/same.pdf"), sold)
    assert sorted(r["entry"] for r in entries.collect()) == ["100-same.pdf", "200-same.pdf"]


# ---- dispatch and recovery ----------------------------------------------------------------


def members(spark, rows):
    df = spark.createDataFrame(rows, "id BIGINT, group_no BIGINT")
    name = F.concat(F.lit("p"), F.col("id").cast("string"))
    return df.withColumns({c: name for c in ("uuid_v4", "first_name", "last_name", "email", "profession")})


def groups(spark, rows):
    return spark.createDataFrame(rows, "group_no BIGINT, dispatch_status STRING, records_included BIGINT")


def answers(spark, rows):
    return spark.createDataFrame(rows, "group_no BIGINT, accepted BOOLEAN")


def test_recovery_of_an_accepted_group(spark):
    run = recovery.run_recovery(
        groups(spark, [(1, "ERROR", 0)]),
        members(spark, [(10, 1), (11, 1)]),
        answers(spark, [(1, True)]),
        scratch(spark, "r"),
    )
    row = run.groups.first()
    assert (run.status, row["dispatch_status"], row["records_included"]) == ("COMPLETED", "SENT", 2)


def test_refused_group_fails_the_run(spark):
    root = scratch(spark, "r")
    run = recovery.run_recovery(
        groups(spark, [(1, "ERROR", 0)]), members(spark, [(10, 1)]), answers(spark, [(1, False)]), root
    )
    assert run.status == "FAILED" and run.groups.first()["dispatch_status"] == "ERROR"
    assert sinks.read_versions(spark, f"{root}/recovered_group", "group_no", recovery.GROUP_SCHEMA).count() == 0


def test_sent_group_is_left_alone(spark):
    after = faults.recover(
        groups(spark, [(1, "SENT", 7)]), members(spark, [(10, 1)]), answers(spark, [(1, False)])
    ).first()
    assert (after["dispatch_status"], after["records_included"], after["failed"]) == ("SENT", 7, False)


def test_group_without_members_has_an_empty_list(spark):
    pages = joins.group_members(
        groups(spark, [(1, "ERROR", 0), (2, "ERROR", 0)]), members(spark, [(10, 1)]), payload_item(), 32
    )
    found = {r["group_no"]: r for r in pages.collect()}
    assert found[2]["items"] == [] and found[2]["members_total"] == 0
    assert len(found[1]["items"]) == 1


def test_hot_group_is_cut_into_pages(spark):
    rows = [(i, 1 if i % 3 else 2) for i in range(1000)]
    pages = joins.group_members(
        groups(spark, [(1, "ERROR", 0), (2, "ERROR", 0)]), members(spark, rows), payload_item(), 32, rows_per_bucket=50
    ).collect()
    assert max(len(p["items"]) for p in pages) == 32
    for group in (1, 2):
        mine = sorted((p for p in pages if p["group_no"] == group), key=lambda p: p["page"])
        names = [item["email"] for p in mine for item in p["items"]]
        assert names == [f"p{i}" for i, g in rows if g == group]


def test_dispatch(spark):
    df = members(spark, [(i, None) for i in range(70)]).drop("group_no")
    sent, tags, payloads = faults.dispatch(df, answers(spark, [(0, True), (1, False), (2, True)]))
    assert [tuple(r) for r in sent.orderBy("group_no").collect()] == [(0, "SENT", 32), (1, "ERROR", 0), (2, "SENT", 6)]
    assert sorted(r["id"] for r in tags.collect()) == [*range(32), *range(64, 70)]
    assert sorted(r["items_size"] for r in payloads.collect()) == [6, 32, 32]


def csv_file(spark, people):
    path = scratch(spark, "people.csv")
    spark.createDataFrame([(",".join(p),) for p in people], "value STRING").coalesce(1).write.text(path)
    return path


PEOPLE = [
    ("Ada", "Lovelace", "ada@example.com", "Engineer"),
    ("Alan", "Turing", "alan@example.com", "Mathematician"),
    ("Grace", "Hopper", "grace@example.com", "Engineer"),
]


def test_person_etl(spark):
    root = scratch(spark, "etl")
    lookup = spark.createDataFrame([(i, 50000) for i in range(1, 20)], "id BIGINT, value INT")
    accepted = answers(spark, [(i, True) for i in range(10)])
    for run_id in (1, 1):
        sent = person_etl.run_person_etl(
            spark, csv_file(spark, PEOPLE), lookup, accepted, root, "2026-01-01", run_id
        )
    people = sinks.read_table(spark, f"{root}/persons_v2", PERSONS_V2).orderBy("source_id").collect()
    assert [(r["source_id"], r["first_name"], str(r["salary"])) for r in people] == [
        (1, "ADA", "50000.00"),
        (2, "ALAN", "50000.00"),
        (3, "GRACE", "50000.00"),
    ]
    assert sinks.read_table(spark, f"{root}/persons_processed", MARK).count() == 3
    stored = sinks.read_table(spark, f"{root}/dispatched_group", DISPATCHED_GROUP)
    assert [(r["group_no"], r["dispatch_status"], r["records_included"]) for r in stored.collect()] == [(0, "SENT", 3)]
    assert sent.groups.count() == 0
    person_etl.run_person_etl(spark, csv_file(spark, PEOPLE[:1]), lookup, accepted, root, "2026-01-02", 2)
    tags = sinks.read_table(spark, f"{root}/group_member", GROUP_MEMBER)
    assert sorted((r["id"], r["group_no"]) for r in tags.collect()) == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_groups_lost_in_a_broken_dispatch_are_completed(spark):
    root = scratch(spark, "etl")
    sinks.append_to(spark.createDataFrame([(1, 0), (2, 0)], GROUP_MEMBER), f"{root}/group_member")
    people = members(spark, [(1, None), (2, None), (3, None)]).drop("group_no").withColumnRenamed("id", "source_id")
    person_etl.dispatch_persons(people, answers(spark, [(0, True), (1, True)]), root)
    stored = sinks.read_table(spark, f"{root}/dispatched_group", DISPATCHED_GROUP).orderBy("group_no").collect()
    assert [(r["group_no"], r["dispatch_status"], r["records_included"]) for r in stored] == [(0, "SENT", 2), (1, "SENT", 1)]


def test_missing_lookup_value_fails(spark):
    df = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    lookup = spark.createDataFrame([(1, 5)], "id BIGINT, value INT")
    with pytest.raises(PySparkException, match="no value for id=2"):
        joins.enrich(df, lookup).collect()
    assert joins.enrich(df, lookup, required=False).count() == 2


def test_job_names_and_defaults():
    from millrace.plans import registry

    assert registry.launch_params("billing", {"DATE": "2026-02-02"}) == {
        "DATE": "2026-02-02",
        "ATTEMPT_NUMBER": "1",
    }
    with pytest.raises(KeyError, match="not found"):
        registry.launch_params("gone", {})


# ---- sinks --------------------------------------------------------------------------------


def test_seed_only_into_an_empty_table(spark):
    seed = spark.range(3)
    assert sinks.seed_if_empty(seed, spark.range(0)).count() == 3
    assert sinks.seed_if_empty(seed, spark.range(1)).count() == 0


def test_marks_report_what_changed(spark):
    target = spark.createDataFrame([(1, False), (2, True), (3, False)], "id BIGINT, processed BOOLEAN")
    named = spark.createDataFrame([(1,), (1,), (2,), (9,)], "id BIGINT")
    out = {r["id"]: (r["processed"], r["changed"]) for r in sinks.mark_processed(target, named).collect()}
    assert out == {1: (True, True), 2: (True, False), 3: (False, False)}
    loose = sinks.mark_processed(target, named, guard=False)
    assert loose.filter("changed").count() == 2


def test_reset_is_refused_in_production(spark):
    tables = {"a": spark.range(3)}
    assert sinks.reset_tables(tables)["a"].count() == 0
    with pytest.raises(PermissionError):
        sinks.reset_tables(tables, production=True)


def test_replaced_rows_are_versions(spark):
    path, schema = scratch(spark, "t"), "k BIGINT, v STRING"
    assert sinks.read_versions(spark, path, "k", schema).count() == 0
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    sinks.replace_in(df, path, "k", schema)
    files = {r[0] for r in spark.read.parquet(f"{path}/rows").select("_metadata.file_path").distinct().collect()}
    new = spark.createDataFrame([(5, "new"), (5, "newer"), (500, "new")], schema)
    sinks.replace_in(new, path, "k", schema)
    out = {r["k"]: r["v"] for r in sinks.read_versions(spark, path, "k", schema).collect()}
    assert len(out) == 101 and {k: v for k, v in out.items() if v != "old"} == {5: "newer", 500: "new"}
    kept = {r[0] for r in spark.read.parquet(f"{path}/rows").select("_metadata.file_path").distinct().collect()}
    assert files <= kept
    compact = scratch(spark, "compact")
    sinks.compact_versions(spark, path, "k", schema, compact)
    assert {r["k"]: r["v"] for r in sinks.read_versions(spark, compact, "k", schema).collect()} == out


def test_a_broken_replacement_leaves_the_old_rows(spark, monkeypatch):
    path, schema = scratch(spark, "t"), "k BIGINT, v STRING"
    sinks.replace_in(spark.createDataFrame([(1, "old")], schema), path, "k", schema)

    def lost(*_):
        raise OSError("driver lost")

    new = spark.createDataFrame([(1, "new")], schema)
    monkeypatch.setattr(sinks, "append_to", lost)  # after the rows, before their number is published
    with pytest.raises(OSError):
        sinks.replace_in(new, path, "k", schema)
    monkeypatch.undo()
    assert [r["v"] for r in sinks.read_versions(spark, path, "k", schema).collect()] == ["old"]
    sinks.replace_in(spark.createDataFrame([(1, "again")], schema), path, "k", schema)
    assert [r["v"] for r in sinks.read_versions(spark, path, "k", schema).collect()] == ["again"]


def test_repeated_key_is_replaced_once(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k BIGINT, v STRING")
    new = spark.createDataFrame([(1, "a"), (1, "b")], "k BIGINT, v STRING")
    assert sorted(map(tuple, sinks.replace_by_key(new, target, "k").collect())) == [(1, "b"), (2, "old")]



def test_a_repeated_load_keeps_its_ids(spark, tmp_path):
    from millrace.plans import person_etl

    def load(name, people, run):
        (tmp_path / name).write_text("".join(f"{p},l,{p}@x,job\n" for p in people))
        return person_etl.load_persons(spark, str(tmp_path / name), str(tmp_path / "root"), run)

    load("one", ["a", "b"], 1)
    load("two", ["c", "d"], 2)
    again = load("one", ["a", "b"], 1)
    assert sorted((r["id"], r["first_name"]) for r in again.collect()) == [(1, "A"), (2, "B"), (3, "C"), (4, "D")]
    with pytest.raises(ValueError, match="more rows than before"):
        load("one", ["a", "b", "e"], 1)
    assert load("two", ["c", "d", "e"], 2).count() == 5


def test_a_repeated_lookup_key_is_refused(spark):
    people = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    lookup = spark.createDataFrame([(1, 5.0), (2, 6.0), (2, 7.0)], "id BIGINT, value DOUBLE")
    with pytest.raises(PySparkException, match="more than one value for id=2"):
        joins.enrich(people, lookup).collect()
