"""Every operator as a query over the test tables; ``oracles`` holds the SQL of the same names."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import bindings as b
from millrace.functions import checks, money, text, tokens
from millrace.operators import aggregates, bucketed, faults, joins, ledger, metrics, ordering, runs, sinks
from millrace.plans import billing, bundles, harvest, payments, person_etl, recovery, registry, tickets
from millrace.session import scratch
from millrace.sources import files, tables
from millrace.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Settings shared with the SQL side.
SECRET = "a-test-secret-of-more-than-32-bytes"
GRID = 4
RUN_DATE = "2024-06-01"
RUN_ID = 42
STAMP = "2024-06-01 12:00:00"
PARAMS = {"DATE": RUN_DATE, "ATTEMPT_NUMBER": "1"}
SHORT_PAYLOAD = 12


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def stamp(col: str) -> Column:
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def big(col: str) -> Column:
    return F.col(col).cast("bigint").alias(col)


# ---- sources ------------------------------------------------------------------------------


def persons_csv(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "persons.csv")
    rows = b.persons(spark, sf_dir).select("first_name", "last_name", "email", "profession")
    rows.write.csv(path, header=False)
    return path


def person_line_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "person_lines")
    b.person_lines(spark, sf_dir).write.text(path)
    return path


def payment_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch(spark, "payments")
    lines = b.payment_lines(spark, sf_dir).withColumnRenamed("value", b.PAYMENT_HEADER)
    lines.write.option("header", True).option("quote", "").option("sep", "\x01").csv(path)
    return path


@query
def scan_delimited(spark, sf_dir):
    return files.scan_delimited(spark, persons_csv(spark, sf_dir), person_etl.CSV_COLUMNS)


@query
def scan_permissive(spark, sf_dir):
    rows, _ = files.scan_permissive(spark, person_line_files(spark, sf_dir), person_etl.CSV_COLUMNS)
    return rows


@query
def dead_letter_read(spark, sf_dir):
    """Every line that cannot be read as a dead letter without an id."""
    _, broken = files.scan_permissive(spark, person_line_files(spark, sf_dir), person_etl.CSV_COLUMNS)
    at = F.lit(STAMP).cast("timestamp_ntz")
    out = sinks.dead_letter(faults.read_skips(broken, len(person_etl.CSV_COLUMNS)), RUN_ID, at, faults.KNOWN_CLASSES)
    return out.withColumn("recorded_at", stamp("recorded_at"))


@query
def dead_letter_write(spark, sf_dir):
    """Rows that a target with a short payload column refuses."""
    rules = [checks.NotNull("payload"), checks.MaxLength("payload", SHORT_PAYLOAD), checks.AtLeast("id", 100)]
    _, refused = sinks.split_by_rules(b.harvest_source(spark, sf_dir).select("id", "payload"), rules)
    at = F.lit(STAMP).cast("timestamp_ntz")
    out = sinks.dead_letter(faults.write_skips(refused, F.col("payload")), RUN_ID, at, faults.KNOWN_CLASSES)
    return out.withColumn("recorded_at", stamp("recorded_at"))


@query
def scan_lenient_lines(spark, sf_dir):
    path = payment_files(spark, sf_dir)
    rows = files.scan_lenient_lines(files.scan_lines(spark, path))
    return rows.select("line_value", "n_fields", F.col("amount").cast("double").alias("amount"))


@query
def scan_ordered(spark, sf_dir):
    return tables.scan_ordered(b.harvest_source(spark, sf_dir), "id", harvest.COLUMNS)


@query
def scan_id_ranges(spark, sf_dir):
    return tables.scan_id_ranges(b.usage_record(spark, sf_dir), "id", GRID)


@query
def scan_one_range(spark, sf_dir):
    """All closed ranges of the table, each read by its own bounds."""
    usage = b.usage_record(spark, sf_dir)
    parts = [
        tables.scan_one_range(usage, "id", row["min_id"], row["max_id"]).withColumn("name", F.lit(row["name"]))
        for row in ordering.id_ranges(ordering.id_bounds(usage, "id"), GRID).collect()
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def scan_keyset(spark, sf_dir):
    return tables.scan_keyset(b.persons(spark, sf_dir), "id", after=0)


@query
def scan_keyset_page(spark, sf_dir):
    return tables.scan_keyset(b.persons(spark, sf_dir), "id", after=20, limit=50)


def open_people(spark, sf_dir):
    """Open persons as snapshot rows."""
    rows = b.persons(spark, sf_dir).filter(~F.col("processed"))
    people = text.snapshot(joins.enrich(rows, b.enrichment(spark, sf_dir)), RUN_DATE)
    return people.withColumnRenamed("source_id", "id")


def all_members(spark, sf_dir):
    """The same, all tagged with the group of their position."""
    people = open_people(spark, sf_dir)
    return ordering.assign_chunk(people, "id", faults.DISPATCH_SIZE, name="group_no")


def sent_members(spark, sf_dir):
    """The same rows, members of refused groups untagged."""
    rows = all_members(spark, sf_dir)
    return rows.withColumn("group_no", F.when(F.col("group_no") % 4 != 0, F.col("group_no")))


def stored_groups(spark, sf_dir):
    return (
        all_members(spark, sf_dir)
        .groupBy("group_no")
        .agg(F.count("*").alias("n"))
        .select(
            "group_no",
            F.when(F.col("group_no") % 4 == 0, "ERROR").otherwise("SENT").alias("dispatch_status"),
            F.when(F.col("group_no") % 4 == 0, 0).otherwise(F.col("n")).alias("records_included"),
        )
    )


@query
def scan_undispatched(spark, sf_dir):
    return tables.scan_undispatched(sent_members(spark, sf_dir)).select("id", "email")


@query
def scan_by_status(spark, sf_dir):
    return tables.scan_by_status(stored_groups(spark, sf_dir), "ERROR")


def block_of(key: str) -> Column:
    return F.call_function("div", F.col(key), F.lit(100)).alias("block")


def supplier_files(spark, sf_dir):
    """One text file per hundred suppliers, lines in key order."""
    path = scratch(spark, "documents")
    rows = b.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", block_of("s_suppkey"))
    whole = rows.repartition("block").sortWithinPartitions("block", "s_suppkey")
    whole.select(F.col("s_name").alias("value"), "block").write.partitionBy("block").text(path)
    return path


def found_blocks(spark, sf_dir):
    found = files.scan_files(spark, supplier_files(spark, sf_dir), "*.txt")
    block = F.regexp_extract("path", r"block=(\d+)", 1).cast("bigint")
    return found.withColumn("path", block)


@query
def scan_files(spark, sf_dir):
    return found_blocks(spark, sf_dir).withColumnRenamed("path", "block")


@query
def missing_files(spark, sf_dir):
    expected = b.table(spark, sf_dir, "customer").select(block_of("c_custkey").alias("path"))
    return files.missing_files(expected, found_blocks(spark, sf_dir))


# ---- sinks --------------------------------------------------------------------------------


@query
def append(spark, sf_dir):
    path = scratch(spark, "persons")
    rows = text.upper_names(b.persons(spark, sf_dir)).drop("processed")
    empty = sinks.read_table(spark, path, "id BIGINT, first_name STRING, last_name STRING,"
                             " profession STRING, email STRING, processed BOOLEAN")
    sinks.append_to(sinks.append(rows, empty, {"processed": F.lit(False)}), path)
    return spark.read.parquet(path)


def charges(spark, sf_dir):
    usage = b.usage_record(spark, sf_dir)
    return usage.select(
        F.col("id").alias("source_id"),
        "subscriber_id",
        "units",
        "rate",
        money.rate_exact(F.col("units"), F.col("rate")).alias("cost"),
    )


@query
def insert_if_absent(spark, sf_dir):
    before = b.billed_before(spark, sf_dir)
    return before.unionByName(
        sinks.insert_if_absent(charges(spark, sf_dir), before, "source_id")
    )


@query
def insert_repeated_keys(spark, sf_dir):
    """Line items of an order collapse to the first one; orders of status F exist already."""
    lines = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("source_id"),
        F.col("l_linenumber"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cost"),
        "l_partkey",
    )
    before = b.billed_before(spark, sf_dir)
    return sinks.insert_if_absent(lines, before, "source_id", order=["l_linenumber"])


@query
def insert_stored_twice(spark, sf_dir):
    """Two runs into one stored table: the second adds nothing."""
    path = scratch(spark, "billing_charge")
    schema = "source_id BIGINT, subscriber_id BIGINT, units BIGINT, rate BIGINT, cost BIGINT"
    for _ in range(2):
        sinks.insert_if_absent_into(charges(spark, sf_dir), path, "source_id", schema)
    return sinks.read_table(spark, path, schema)


@query
def insert_bucketed(spark, sf_dir):
    """Usage rated into a bucketed table that holds earlier charges, twice: only absent keys are added."""
    path, columns = scratch(spark, "bucketed"), "source_id BIGINT, cost BIGINT"
    charged = bucketed.bucketed(spark, path, "source_id", columns)
    charged.insert_if_absent(b.billed_before(spark, sf_dir).select("source_id", "cost"), unique_keys=True)
    usage = b.usage_record(spark, sf_dir)
    rated = usage.select(F.col("id").alias("source_id"), money.rate_exact(F.col("units"), F.col("rate")).alias("cost"))
    for _ in range(2):
        charged.insert_if_absent(rated.unionByName(rated))
    return charged.read()


@query
def replace_by_key(spark, sf_dir):
    before = b.billed_before(spark, sf_dir)
    fresh = charges(spark, sf_dir).filter("rate >= 5")
    return sinks.replace_by_key(fresh, before, "source_id")


@query
def replace_stored(spark, sf_dir):
    """The same replacement in a stored table of versions, every new row given twice."""
    path = scratch(spark, "billing_charge")
    schema = "source_id BIGINT, subscriber_id BIGINT, units BIGINT, rate BIGINT, cost BIGINT"
    sinks.replace_in(b.billed_before(spark, sf_dir), path, "source_id", schema)
    fresh = charges(spark, sf_dir).filter("rate >= 5")
    sinks.replace_in(fresh.union(fresh), path, "source_id", schema)
    return sinks.read_versions(spark, path, "source_id", schema)


def flagged_tickets(spark, sf_dir):
    return b.event_tickets(spark, sf_dir).select("id", "event_id", "processed")


@query
def mark_processed(spark, sf_dir):
    done = b.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("id")
    )
    return sinks.mark_processed(flagged_tickets(spark, sf_dir), done)


@query
def mark_processed_unguarded(spark, sf_dir):
    done = b.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("id")
    )
    return sinks.mark_processed(flagged_tickets(spark, sf_dir), done, guard=False)


@query
def tag_members(spark, sf_dir):
    people = b.persons(spark, sf_dir).select(
        "id",
        F.lit(None).cast("bigint").alias("group_no"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )
    tags = sent_members(spark, sf_dir).filter("group_no IS NOT NULL").select("id", "group_no")
    after = sinks.tag_members(people, tags, F.lit(STAMP).cast("timestamp_ntz"))
    return after.select("id", "group_no", stamp("updated_at").alias("updated_at"))


@query
def reset_tables(spark, sf_dir):
    named = {
        "persons": b.persons(spark, sf_dir),
        "usage_record": b.usage_record(spark, sf_dir),
        "harvest_source": b.harvest_source(spark, sf_dir),
    }
    empty = sinks.reset_tables(named)
    rows = [
        df.agg(F.count("*").alias("rows_before"))
        .select(
            F.lit(name).alias("table_name"),
            "rows_before",
            empty[name].agg(F.count("*")).scalar().alias("rows_after"),
        )
        for name, df in named.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query
def seed_if_empty(spark, sf_dir):
    seed = b.usage_record(spark, sf_dir)
    target = b.billed_before(spark, sf_dir)
    into_empty = sinks.seed_if_empty(seed, target.filter("cost < 0"))
    into_full = sinks.seed_if_empty(seed, target)
    return into_empty.withColumn("target", F.lit("empty")).unionByName(
        into_full.withColumn("target", F.lit("filled"))
    )


@query
def dead_letter(spark, sf_dir):
    rows = harvest.outcomes(b.harvest_source(spark, sf_dir))
    skips = rows.filter(F.col("outcome").isin(faults.SKIP, faults.EXHAUSTED))
    at = F.lit(STAMP).cast("timestamp_ntz")
    out = sinks.dead_letter(skips, RUN_ID, at, faults.KNOWN_CLASSES)
    return out.withColumn("recorded_at", stamp("recorded_at"))


@query
def write_expecting(spark, sf_dir):
    todo = b.event_tickets(spark, sf_dir).filter(~F.col("processed"))
    rows = todo.select(F.col("id").alias("ticket_id"), "ticket_code")
    target = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    registry = b.generated_files(spark, sf_dir)
    return sinks.write_expecting(rows, target, registry, "ticket_id", "id")


# ---- projections --------------------------------------------------------------------------


@query
def upper_names(spark, sf_dir):
    return text.upper_names(b.persons(spark, sf_dir)).select("id", "first_name", "last_name")


@query
def full_name(spark, sf_dir):
    return text.full_name(b.persons(spark, sf_dir)).select("id", "first_name", "last_name", "full_name")


@query
def snapshot(spark, sf_dir):
    rows = joins.enrich(b.persons(spark, sf_dir), b.enrichment(spark, sf_dir))
    out = text.snapshot(rows, RUN_DATE)
    return out.withColumns(
        {"snapshot_date": F.col("snapshot_date").cast("string"), "salary": F.col("salary").cast("double")}
    )


@query
def payload_item(spark, sf_dir):
    rows = text.payload_items(all_members(spark, sf_dir))
    return rows.select("id", "item.*")


@query
def rate_exact(spark, sf_dir):
    return charges(spark, sf_dir).select("source_id", "cost")


@query
def rate_or_null(spark, sf_dir):
    rows = b.usage_with_bad_row(spark, sf_dir)
    return rows.select("id", money.rate_or_null(F.col("units"), F.col("rate")).alias("cost"))


@query
def ticket_fields(spark, sf_dir):
    rows = text.ticket_fields(b.event_tickets(spark, sf_dir))
    return rows.select("id", "seat", "event_location", "event_time")


def signed(spark, sf_dir):
    orders = b.table(spark, sf_dir, "orders")
    code = F.concat(F.lit("T-"), F.col("o_orderkey").cast("string"))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        tokens.sign_token(F.col("o_orderkey"), code, SECRET).alias("token"),
    )


@query
def sign_token(spark, sf_dir):
    return signed(spark, sf_dir)


@query
def verify_token(spark, sf_dir):
    """Tokens of every tenth ticket are tampered with: another id in front of the signature."""
    rows = signed(spark, sf_dir).withColumn(
        "token", F.when(F.col("id") % 10 == 3, F.concat(F.lit("1"), "token")).otherwise(F.col("token"))
    )
    return rows.select("id", tokens.verify_token(F.col("token"), SECRET).alias("valid"))


@query
def checksum(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").select(
        "doc_id",
        tokens.checksum(F.encode("text", "UTF-8")).alias("checksum_sha256"),
        F.octet_length("text").cast("bigint").alias("size_bytes"),
    )


@query
def verify_checksum(spark, sf_dir):
    """Stored checksums of documents in one language were taken from other bytes."""
    content = F.encode("text", "UTF-8")
    stored = F.when(F.col("lang") == "en", tokens.checksum(F.encode(F.upper("source"), "UTF-8"))).otherwise(
        tokens.checksum(content)
    )
    rows = b.table(spark, sf_dir, "documents")
    return rows.select("doc_id", tokens.verify_checksum(stored, content).alias("load_error"))


@query
def truncate_message(spark, sf_dir):
    cut = text.truncate_message(F.col("text"))
    return b.table(spark, sf_dir, "documents").select(
        "doc_id", F.length(cut).alias("kept_chars"), F.md5(F.encode(cut, "UTF-8")).alias("kept_md5")
    )


@query
def root_cause(spark, sf_dir):
    id_ = F.col("event_id")
    outer = F.when(id_ % 3 == 0, "RuntimeException").otherwise(faults.POISON_CLASS)
    inner = F.when(id_ % 2 == 0, F.lit(faults.TRANSIENT_CLASS))
    rows = b.table(spark, sf_dir, "events").select(
        "event_id",
        text.root_cause(outer, F.col("event_type"), inner, F.col("props"), faults.KNOWN_CLASSES).alias("c"),
    )
    return rows.select("event_id", "c.*")


@query
def to_payload_json(spark, sf_dir):
    item = F.struct("first_name", "last_name", "email", "profession")
    rows = b.persons(spark, sf_dir)
    body = F.when(~F.col("processed"), item)
    return rows.select("id", text.to_payload_json(body).alias("payload"))


@query
def parse_value_json(spark, sf_dir):
    answer = F.concat(F.lit('{"value":'), F.col("c_acctbal").cast("decimal(19,2)").cast("string"), F.lit("}"))
    return b.table(spark, sf_dir, "customer").select(
        "c_custkey", text.parse_value_json(answer).cast("double").alias("value")
    )


@query
def storage_key(spark, sf_dir):
    return b.generated_files(spark, sf_dir).select(
        "ticket_id",
        text.ticket_file_name(F.col("ticket_id")).alias("file_name"),
        text.bundle_key(F.col("ticket_id") % 50).alias("bundle"),
        text.entry_name(F.col("ticket_id"), F.col("storage_path")).alias("entry"),
    )


@query
def audit_normalise(spark, sf_dir):
    id_ = F.col("event_id")
    rows = b.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(id_ % 5 != 0, F.col("event_type")).alias("job_name"),
        F.when(id_ % 4 == 0, "  ").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(id_ % 3 == 0, "").otherwise(F.col("props")).alias("details"),
        F.when(id_ % 2 == 0, "FAILURE").alias("outcome"),
    )
    return text.audit_normalise(rows)


# ---- filters and validation ---------------------------------------------------------------


@query
def unprocessed(spark, sf_dir):
    return checks.unprocessed(flagged_tickets(spark, sf_dir))


@query
def unprocessed_of_event(spark, sf_dir):
    return checks.unprocessed(flagged_tickets(spark, sf_dir), " 7 ")


@query
def in_ids(spark, sf_dir):
    ids = b.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    return checks.in_ids(b.usage_record(spark, sf_dir), ids)


def step_executions(spark, sf_dir):
    id_ = F.col("execution_id")
    return b.executions(spark, sf_dir).select(
        "execution_id",
        F.when(id_ % 2 == 0, F.concat(F.lit("usageWorkerStep:partition"), (id_ % 4).cast("string")))
        .otherwise("usageManagerStep")
        .alias("step_name"),
        "status",
    )


@query
def worker_steps(spark, sf_dir):
    return checks.worker_steps(step_executions(spark, sf_dir), "usageWorkerStep:")


def date_texts(spark, sf_dir):
    id_ = F.col("event_id")
    day = F.date_format("ts", "yyyy-MM-dd")
    return b.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(id_ % 7 == 0, F.lit(None))
        .when(id_ % 7 == 1, "  ")
        .when(id_ % 7 == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(id_ % 7 == 3, F.concat(F.lit(" "), day, F.lit(" ")))
        .when(id_ % 7 == 4, F.date_format("ts", "yyyy-MM"))
        .when(id_ % 7 == 5, "2024-02-30")
        .otherwise(day)
        .alias("given"),
    )


@query
def check_date(spark, sf_dir):
    return date_texts(spark, sf_dir).select("event_id", checks.check_date(F.col("given")).alias("reason"))


@query
def check_positive_long(spark, sf_dir):
    id_ = F.col("o_orderkey")
    given = (
        F.when(id_ % 6 == 0, F.lit(None))
        .when(id_ % 6 == 1, F.concat(F.lit(" "), id_.cast("string"), F.lit(" ")))
        .when(id_ % 6 == 2, F.concat(F.lit("-"), id_.cast("string")))
        .when(id_ % 6 == 3, F.col("o_orderpriority"))
        .when(id_ % 6 == 4, "9223372036854775808")
        .otherwise(id_.cast("string"))
    )
    return b.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        checks.check_positive_long(given).alias("reason"),
        checks.check_optional_long(given).alias("optional_reason"),
    )


@query
def check_min_bytes(spark, sf_dir):
    """Whole values of 23 to 35 bytes, some of them blank."""
    key = F.col("p_partkey").cast("string")
    secret = F.concat_ws(" ", "p_name", "p_brand", "p_type", key)
    given = F.when(F.col("p_partkey") % 11 == 0, F.lit("  ")).otherwise(secret)
    return b.table(spark, sf_dir, "part").select("p_partkey", checks.check_min_bytes(given).alias("reason"))


@query
def check_fixed(spark, sf_dir):
    given = F.when(F.col("p_size") % 5 != 0, F.col("p_size"))
    return b.table(spark, sf_dir, "part").select(
        "p_partkey", checks.check_fixed(given, GRID, "GRID_SIZE").alias("reason")
    )


@query
def check_upload(spark, sf_dir):
    reason = checks.check_upload(
        F.col("file_name"), F.col("content"), F.col("job_name"), F.col("version"), F.col("class_name")
    )
    return b.uploads(spark, sf_dir).select("upload_id", reason.alias("reason"))


@query
def check_uploads(spark, sf_dir):
    """Uploads against stored names; hosts stand for job names, so most names come more than once."""
    stored = b.uploads(spark, sf_dir).filter(F.col("upload_id") % 10 == 3).select("job_name")
    return checks.check_uploads(b.uploads(spark, sf_dir), stored).select("upload_id", "reason")


@query
def check_constraints(spark, sf_dir):
    finished = b.table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'")
    return checks.check_constraints(
        b.table(spark, sf_dir, "lineitem"),
        [
            checks.NotNull("l_shipdate"),
            checks.MaxLength("l_returnflag", 1),
            checks.AtLeast("l_quantity", 2),
            checks.AtLeast("l_linenumber", 1),
            checks.Unique("l_orderkey"),
            checks.ForeignKey("l_partkey", b.table(spark, sf_dir, "part"), "p_partkey"),
            checks.ForeignKey("l_orderkey", finished, "o_orderkey"),
        ],
    )


def storage_keys(spark, sf_dir):
    id_ = F.col("page_id")
    path = F.regexp_extract("url", r"//[^/]+/([^?#]*)", 1)
    return b.table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(id_ % 5 == 0, F.concat(F.lit("../"), path))
        .when(id_ % 5 == 1, F.concat(F.lit("/"), path))
        .when(id_ % 5 == 2, F.concat(path, F.lit("/../../../x")))
        .when(id_ % 5 == 3, F.concat(path, F.lit("/./../y")))
        .otherwise(path)
        .alias("key"),
    )


@query
def check_path_safe(spark, sf_dir):
    return storage_keys(spark, sf_dir).select("page_id", checks.check_path_safe(F.col("key")).alias("reason"))


# ---- joins --------------------------------------------------------------------------------


@query
def event_files(spark, sf_dir):
    return joins.event_files(b.generated_files(spark, sf_dir), flagged_tickets(spark, sf_dir))


@query
def group_members(spark, sf_dir):
    """Groups with their payload pages of at most 10 members; groups without members included."""
    groups = b.acceptance(spark, sf_dir).select("group_no")
    rows = joins.group_members(groups, all_members(spark, sf_dir), text.payload_item(), 10)
    return rows.select(
        "group_no",
        "page",
        "members_total",
        F.to_json("items", {"ignoreNullFields": "false"}).alias("items"),
    )


@query
def anti_existing(spark, sf_dir):
    return joins.anti_existing(charges(spark, sf_dir), b.billed_before(spark, sf_dir), "source_id")


@query
def not_exists_any(spark, sf_dir):
    usage = b.usage_record(spark, sf_dir)
    nobody = b.persons(spark, sf_dir).filter("profession IS NULL")
    return joins.not_exists_any(usage, nobody)


@query
def enrich(spark, sf_dir):
    rows = joins.enrich(b.persons(spark, sf_dir), b.enrichment(spark, sf_dir))
    return rows.select("id", "email", F.col("value").cast("double").alias("value"))


def run_definitions(spark, sf_dir):
    """Definitions of the event types that stand in for jobs; ``view`` has none."""
    return (
        b.table(spark, sf_dir, "events")
        .filter("event_type <> 'view'")
        .groupBy(F.col("event_type").alias("job_name"))
        .agg(F.min("event_id").alias("definition_id"))
        .withColumn("version", F.lit("1.0.0"))
    )


@query
def with_definition(spark, sf_dir):
    rows = joins.with_definition(
        b.executions(spark, sf_dir), run_definitions(spark, sf_dir), keep_unknown=True
    )
    return rows.select("execution_id", "job_name", "definition_id", "version")


# ---- aggregates ---------------------------------------------------------------------------


@query
def count_and_total(spark, sf_dir):
    lines = files.scan_lenient_lines(b.payment_lines(spark, sf_dir))
    out = aggregates.count_and_total(lines)
    return out.withColumn("payment_total", F.col("payment_total").cast("double"))


@query
def reconcile(spark, sf_dir):
    out = aggregates.reconcile(charges(spark, sf_dir), b.usage_record(spark, sf_dir))
    return out.withColumns(
        {"charge_sum": F.col("charge_sum").cast("bigint"), "usage_sum": F.col("usage_sum").cast("bigint")}
    )


@query
def bundle_entries(spark, sf_dir):
    return aggregates.bundle_entries(b.generated_files(spark, sf_dir), flagged_tickets(spark, sf_dir))


@query
def ordered_entries(spark, sf_dir):
    entries = aggregates.bundle_entries(b.generated_files(spark, sf_dir), flagged_tickets(spark, sf_dir))
    return aggregates.ordered_entries(entries).select("event_id", "entry_no", "entry")


@query
def bundle_manifest(spark, sf_dir):
    entries = aggregates.bundle_entries(b.generated_files(spark, sf_dir), flagged_tickets(spark, sf_dir))
    return aggregates.bundle_manifest(entries)


@query
def group_stats(spark, sf_dir):
    return aggregates.group_stats(sent_members(spark, sf_dir))


@query
def status_health(spark, sf_dir):
    out = aggregates.status_health(b.definitions(spark, sf_dir), b.registry(spark, sf_dir))
    return out.select(big("loaded"), big("failed"), "status")


@query
def id_bounds(spark, sf_dir):
    return ordering.id_bounds(b.usage_record(spark, sf_dir), "id")


@query
def step_counters(spark, sf_dir):
    """Counters of a partitioned harvest: one step per id range."""
    rows = harvest.outcomes(b.harvest_source(spark, sf_dir))
    ranged = ordering.assign_id_range(rows, "id", GRID)
    step = F.concat(F.lit("harvestStep:partition"), F.col("range_no").cast("string"))
    return aggregates.step_counters(ranged.withColumn("step_name", step), faults.CHUNK_SIZE)


@query
def running_by_job(spark, sf_dir):
    """Maps of at most 50 open executions, as JSON text."""
    runs = b.executions(spark, sf_dir).withColumn("params_text", F.to_json("params"))
    jobs = b.table(spark, sf_dir, "nation").select(F.lower("n_name").alias("job_name"))
    named = b.executions(spark, sf_dir).select("job_name").distinct()
    out = aggregates.running_by_job(runs, named.unionByName(jobs), page_size=50)
    return out.select(
        "job_name", "page", F.size("running").alias("open_runs"), F.to_json("running").alias("running")
    )


@query
def tagged_counter(spark, sf_dir):
    return aggregates.tagged_counter(b.executions(spark, sf_dir))


@query
def partition_totals(spark, sf_dir):
    usage = b.usage_record(spark, sf_dir)
    out = aggregates.partition_totals(charges(spark, sf_dir), ordering.id_bounds(usage, "id"), GRID)
    return out.withColumn("total_cost", F.col("total_cost").cast("bigint"))


# ---- ordering -----------------------------------------------------------------------------


@query
def ordered_output(spark, sf_dir):
    return b.event_tickets(spark, sf_dir).select("id", "ticket_code").orderBy("id")


@query
def page_of(spark, sf_dir):
    return ordering.page_of(b.usage_record(spark, sf_dir), "id", 512)


@query
def assign_chunk(spark, sf_dir):
    rows = b.persons(spark, sf_dir).filter(~F.col("processed")).select("id")
    return ordering.assign_chunk(rows, "id", 32)


@query
def assign_chunk_per_range(spark, sf_dir):
    ranged = ordering.assign_id_range(b.usage_record(spark, sf_dir), "id", GRID)
    rows = ranged.select("id", "range_no")
    return ordering.assign_chunk(rows, "id", 100, groups=["range_no"])


@query
def assign_id_range(spark, sf_dir):
    return ordering.assign_id_range(b.usage_record(spark, sf_dir), "id", 7).select("id", "range_no")


@query
def id_ranges(spark, sf_dir):
    return ordering.id_ranges(ordering.id_bounds(b.usage_record(spark, sf_dir), "id"), 7)


@query
def running_total(spark, sf_dir):
    """Cost billed before each charge of the same subscriber, in charge order."""
    rows = charges(spark, sf_dir).select("source_id", "subscriber_id", "cost")
    return ordering.running_total(
        rows, ["source_id"], ["subscriber_id"], "cost", name="billed_before", total="billed_total"
    )


@query
def union_with_precedence(spark, sf_dir):
    return aggregates.union_with_precedence(
        b.registry(spark, sf_dir),
        b.definitions(spark, sf_dir).drop("definition_id"),
    )


# ---- fault tolerance ----------------------------------------------------------------------


@query
def classify(spark, sf_dir):
    return faults.classify(b.harvest_source(spark, sf_dir)).select("id", "fault")


@query
def retry_outcome(spark, sf_dir):
    rows = faults.retry_outcome(faults.classify(b.harvest_source(spark, sf_dir)))
    return rows.select("id", "outcome", "calls", "attempt_count")


@query
def skip_limit_cut(spark, sf_dir):
    return faults.skip_limit_cut(harvest.outcomes(b.harvest_source(spark, sf_dir)))


@query
def commit_prefix(spark, sf_dir):
    """Rows committed before the run ends at the abort row."""
    rows = harvest.outcomes(b.harvest_source(spark, sf_dir))
    return faults.run_cut(rows).committed(rows).filter("outcome = 'OK'").select("id", "payload")


@query
def commit_prefix_skip_limit(spark, sf_dir):
    """The same with a limit of four skips, which ends the run earlier."""
    rows = harvest.outcomes(b.harvest_source(spark, sf_dir))
    return faults.run_cut(rows, limit=4).committed(rows).filter("outcome = 'OK'").select("id", "payload")


@query
def resume(spark, sf_dir):
    """Rows left after a run that failed at the abort row."""
    source = b.harvest_source(spark, sf_dir)
    rows = harvest.outcomes(source)
    points = faults.run_cut(rows).committed(rows).agg(F.max("id").alias("last_id"))
    stored = points.withColumn("identity", F.lit("this run"))
    return faults.resume(source, stored, "this run").select("id", "payload")


@query
def isolate_partitions(spark, sf_dir):
    charged, _ = faults.isolate_partitions(b.usage_with_bad_row(spark, sf_dir), GRID, 100)
    return charged


@query
def range_outcomes(spark, sf_dir):
    _, outcomes = faults.isolate_partitions(b.usage_with_bad_row(spark, sf_dir), GRID, 100)
    return outcomes


@query
def restart_partitions(spark, sf_dir):
    """Rows of the ranges that a failed run left open."""
    usage = b.usage_record(spark, sf_dir)
    _, outcomes = faults.isolate_partitions(b.usage_with_bad_row(spark, sf_dir), GRID, 100)
    ranges = ordering.id_ranges(ordering.id_bounds(usage, "id"), GRID)
    saved = ranges.join(outcomes.select("range_no", "status"), "range_no").withColumn("run_id", F.lit(1))
    return faults.restart_partitions(usage, saved)


def dispatched(spark, sf_dir):
    return faults.dispatch(open_people(spark, sf_dir), b.acceptance(spark, sf_dir))


@query
def dispatch_groups(spark, sf_dir):
    return dispatched(spark, sf_dir)[0]


@query
def dispatch_tags(spark, sf_dir):
    return dispatched(spark, sf_dir)[1]


@query
def dispatch_payloads(spark, sf_dir):
    rows = dispatched(spark, sf_dir)[2]
    body = text.to_payload_json(F.struct("items_size", "items"))
    return rows.select("group_no", body.alias("payload"))


def second_answer(spark, sf_dir):
    return b.acceptance(spark, sf_dir).withColumn("accepted", F.col("group_no") % 8 != 0)


@query
def recover(spark, sf_dir):
    return faults.recover(
        stored_groups(spark, sf_dir), all_members(spark, sf_dir), second_answer(spark, sf_dir)
    )


# ---- run ledger ---------------------------------------------------------------------------


def identified(spark, sf_dir):
    runs = b.executions(spark, sf_dir)
    return runs.withColumn("identity", ledger.run_identity(F.col("job_name"), F.col("params")))


@query
def run_identity(spark, sf_dir):
    return identified(spark, sf_dir).select("execution_id", "identity")


@query
def overlay_params(spark, sf_dir):
    defaults = F.create_map(F.lit("DATE"), F.lit("2026-01-01"), F.lit("GRID_SIZE"), F.lit("4"))
    merged = ledger.overlay_params(defaults, F.col("params"))
    pairs = F.transform(
        F.sort_array(F.map_entries(merged)),
        lambda e: F.concat(e.getField("key"), F.lit("="), e.getField("value")),
    )
    return b.executions(spark, sf_dir).select("execution_id", F.concat_ws(",", pairs).alias("params"))


def requests(spark, sf_dir):
    id_ = F.col("event_id")
    day = (
        F.when(id_ % 6 == 1, "")
        .when(id_ % 6 == 2, "2024-13-01")
        .when(id_ % 6 == 5, F.date_format(F.date_add(F.to_date("ts"), 40), "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    attempt = F.create_map(F.lit("ATTEMPT_NUMBER"), (F.col("user_id") % 5 + 1).cast("string"))
    dated = F.create_map(F.lit("DATE"), day)
    note = F.create_map(F.lit("DESCRIPTION"), F.col("props"))
    params = F.when(id_ % 6 == 0, F.map_concat(attempt, note)).otherwise(
        F.when(id_ % 2 == 0, F.map_concat(attempt, dated, note)).otherwise(F.map_concat(dated, note))
    )
    return b.table(spark, sf_dir, "events").select(
        id_.alias("request_id"), F.col("event_type").alias("job_name"), params.alias("params")
    )


@query
def launch_decision(spark, sf_dir):
    return ledger.launch_decision(requests(spark, sf_dir), run_definitions(spark, sf_dir), _history(spark, sf_dir))


def _history(spark, sf_dir):
    """Executions of odd attempts all failed, so that some identities may restart."""
    runs = identified(spark, sf_dir)
    odd = F.col("params").getItem("ATTEMPT_NUMBER") == "1"
    status = F.when(odd & (F.col("job_name") == "error"), "FAILED").otherwise(F.col("status"))
    return runs.select("identity", "execution_id", status.alias("status"))


@query
def run_audit(spark, sf_dir):
    return ledger.run_audit(b.executions(spark, sf_dir), run_definitions(spark, sf_dir))


@query
def restart_proof(spark, sf_dir):
    return ledger.restart_proof(identified(spark, sf_dir))


@query
def restart_history(spark, sf_dir):
    return ledger.restart_history(identified(spark, sf_dir))


@query
def run_ledger(spark, sf_dir):
    """The stored ledger after launches of two jobs, some of them refused: every run with its audit row, its identity's
    history, the charges it stored and the decision that another equal launch would meet."""
    root, at = scratch(spark, "ledger"), F.lit(STAMP).cast("timestamp_ntz")
    path = payment_files(spark, sf_dir)
    for usage in (b.usage_with_bad_row(spark, sf_dir), *[b.usage_record(spark, sf_dir)] * 2):
        registry.launch_job(spark, root, "billing", PARAMS, at, usage=usage)
    for params in (PARAMS, PARAMS, {}, {"DATE": "2024-13-01"}):
        registry.launch_job(spark, root, "payment_summary", params, at, path=path)
    registry.launch_job(spark, root, "no_such_job", PARAMS, at)
    history, jobs = runs.executions(spark, root), registry.known_jobs(spark)
    defined = jobs.select(F.xxhash64("job_name").alias("definition_id"), "job_name", F.lit("1.0.0").alias("version"))
    audit = ledger.run_audit(history, defined).select(F.col("job_execution_id").alias("execution_id"), "duration_ms", "outcome")
    again = history.groupBy("identity").agg(F.max(F.struct("execution_id", "job_name")).alias("e"), F.first("params").alias("params"))
    requests_ = again.select(F.col("e.execution_id").alias("request_id"), "e.job_name", "params")
    decided = ledger.launch_decision(requests_, jobs, history).select("identity", F.col("decision").alias("next_decision"))
    charges = sinks.read_table(spark, f"{root}/billing_charge", billing.BILLING_CHARGE)
    stored = charges.groupBy(F.col("job_execution_id").alias("execution_id")).agg(F.count("*").alias("charges"))
    return (
        history.join(ledger.restart_proof(history), "identity")
        .join(decided, "identity")
        .join(audit, "execution_id")
        .join(stored, "execution_id", "left")
        .select(
            "execution_id", "job_name", F.col("params").getItem("DATE").alias("run_date"), "turn", "status", "outcome",
            "duration_ms", "executions", "failed", "completed", "recovered", "next_decision", "charges",
        )
    )


# ---- metrics ------------------------------------------------------------------------------


def readable(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", stamp("window_start"))


@query
def rate_per_minute(spark, sf_dir):
    return readable(metrics.rate_per_minute(b.metric_events(spark, sf_dir)))


@query
def rate_per_minute_total(spark, sf_dir):
    return readable(metrics.rate_per_minute(b.metric_events(spark, sf_dir), tag=None))


@query
def p95(spark, sf_dir):
    rows = readable(metrics.p95(b.metric_events(spark, sf_dir)))
    return rows.withColumn("quantile", F.round("quantile", 6))


@query
def p95_sliding(spark, sf_dir):
    """Sketched quantiles of all sliding windows, held against the true ranks of all values."""
    events = b.metric_events(spark, sf_dir)
    found = metrics.sliding_quantile(events)
    errors = metrics.rank_error(events, found).withColumn("close", F.col("rank_error") <= 0.03)
    return readable(found.join(errors, ["tag", "window_start"]).select("tag", "window_start", "n", "close"))


@query
def p95_daily(spark, sf_dir):
    rows = readable(metrics.p95(b.metric_events(spark, sf_dir), minutes=1440))
    return rows.withColumn("quantile", F.round("quantile", 6))


@query
def mean_ratio(spark, sf_dir):
    rows = readable(metrics.mean_ratio(b.metric_events(spark, sf_dir)))
    return rows.withColumn("mean", F.round("mean", 6))


@query
def percent_of(spark, sf_dir):
    per_group = b.persons(spark, sf_dir).groupBy("profession").agg(
        F.count_if("processed").alias("used"), F.count("*").alias("available")
    )
    share = metrics.percent_of(F.col("used"), F.col("available"))
    return per_group.withColumn("percent", F.round(share, 6))


@query
def server_error_rate(spark, sf_dir):
    return readable(metrics.error_rate(b.metric_events(spark, sf_dir), metrics.SERVER_ERROR))


@query
def client_error_rate(spark, sf_dir):
    return readable(metrics.error_rate(b.metric_events(spark, sf_dir), metrics.CLIENT_ERROR))


# ---- jobs ---------------------------------------------------------------------------------


def person_job(spark: SparkSession, sf_dir: str, csv_path: str, skip_limit: int | None = None) -> str:
    """The whole job; returns its folder. Ids are numbered by the load, so looked-up values are found by email."""
    root = scratch(spark, "person_etl")
    by_email = b.persons(spark, sf_dir).select("email", F.col("id").alias("custkey"))
    people = person_etl.load_persons(spark, csv_path, root, RUN_ID, skip_limit)
    lookup = (
        people.join(by_email, "email")
        .join(b.enrichment(spark, sf_dir).withColumnRenamed("id", "custkey"), "custkey")
        .select("id", "value")
    )
    stored = person_etl.snapshot_persons(people, lookup, root, RUN_DATE, RUN_ID, person_etl.PERSON_RULES)
    person_etl.dispatch_persons(stored, b.acceptance(spark, sf_dir), root)
    return root


@query
def job_person_etl(spark, sf_dir):
    """File to persons to snapshot rows to groups: every snapshot row with its group, if that was accepted."""
    root = person_job(spark, sf_dir, persons_csv(spark, sf_dir))
    stored = sinks.read_table(spark, f"{root}/persons_v2", person_etl.PERSONS_V2)
    tags = sinks.read_table(spark, f"{root}/group_member", person_etl.GROUP_MEMBER)
    return stored.join(tags.withColumnRenamed("id", "source_id"), "source_id", "left").select(
        "email",
        "first_name",
        "last_name",
        "profession",
        F.col("snapshot_date").cast("string").alias("snapshot_date"),
        F.col("salary").cast("double").alias("salary"),
        F.col("group_no").isNotNull().alias("sent"),
        "group_no",
    )


@query
def job_person_etl_groups(spark, sf_dir):
    """The groups and tags the same job leaves behind."""
    root = person_job(spark, sf_dir, persons_csv(spark, sf_dir))
    groups = sinks.read_table(spark, f"{root}/dispatched_group", person_etl.DISPATCHED_GROUP)
    tags = sinks.read_table(spark, f"{root}/group_member", person_etl.GROUP_MEMBER)
    tagged = aggregates.group_stats(tags).withColumnRenamed("records_included", "tagged")
    return groups.join(tagged, "group_no", "left").select(
        "group_no",
        "dispatch_status",
        "records_included",
        F.coalesce("tagged", F.lit(0).cast("bigint")).alias("tagged"),
    )


@query
def job_person_etl_letters(spark, sf_dir):
    """Dead letters of the same job on a file with broken lines: lines it could not read, rows the snapshot refuses."""
    root = person_job(spark, sf_dir, person_line_files(spark, sf_dir), skip_limit=1 << 40)
    letters = sinks.read_table(spark, f"{root}/dead_letter", person_etl.DEAD_LETTER)
    return letters.drop("recorded_at")


@query
def job_dispatch_recovery(spark, sf_dir):
    root = scratch(spark, "recovery")
    run = recovery.run_recovery(
        stored_groups(spark, sf_dir), all_members(spark, sf_dir), second_answer(spark, sf_dir), root
    )
    stored = sinks.read_versions(spark, f"{root}/recovered_group", "group_no", recovery.GROUP_SCHEMA)
    return stored.withColumn("run_status", F.lit(run.status))


@query
def job_recovery_payloads(spark, sf_dir):
    return recovery.recovery_payloads(stored_groups(spark, sf_dir), all_members(spark, sf_dir), size=20)


@query
def job_ticket_signing(spark, sf_dir):
    root = scratch(spark, "tickets")
    registry, marks = tickets.run_tickets(b.event_tickets(spark, sf_dir), root, SECRET, RUN_ID)
    return registry.join(marks.withColumnRenamed("id", "ticket_id"), "ticket_id").select(
        "ticket_id", "event_id", "checksum_sha256", "file_size_bytes", "run_id"
    )


@query
def job_event_bundles(spark, sf_dir):
    """All events bundled, then one event bundled again: still one row per event."""
    root = scratch(spark, "bundles")
    registered, sold = b.generated_files(spark, sf_dir), flagged_tickets(spark, sf_dir)
    found = registered.select(F.col("storage_path").alias("path"))
    bundles.run_bundles(registered, sold, root, found=found)
    return bundles.run_bundles(registered, sold, root, event_id="7", found=found)


def ticket_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """The document of every registered ticket, to be written as a file of its own, and the folder for them."""
    sold = b.event_tickets(spark, sf_dir).filter("processed")
    text_ = b.document_text(F.col("ticket_code"), F.col("holder_name"))
    return sold.select(F.col("id").alias("ticket_id"), text_.alias("value")), scratch(spark, "ticket_files")


@query
def job_event_bundles_files(spark, sf_dir):
    """All events bundled from files that were really written, one per ticket. While one of them is missing the run is
    refused and stores nothing; once it is there all events have their bundle."""
    root = scratch(spark, "bundles")
    registered, sold = b.generated_files(spark, sf_dir), flagged_tickets(spark, sf_dir)
    documents, folder = ticket_files(spark, sf_dir)
    late = documents.agg(F.max("ticket_id")).first()[0]

    def bundled() -> DataFrame:
        number = F.regexp_extract("path", r"ticket_id=(\d+)", 1)
        found = files.scan_files(spark, folder, "*.txt").select(F.concat(F.lit("/data/tickets/"), number, F.lit(".pdf")).alias("path"))
        return bundles.run_bundles(registered, sold, root, found=found)

    sinks.write_files(documents.filter(F.col("ticket_id") != late), folder, "ticket_id")
    try:
        bundled()
        refused = "none"
    except Exception as problem:  # noqa: BLE001
        refused = re.search(r"missing file: \S*?\.pdf", str(problem))[0]
    nothing = sinks.versions_of(spark, f"{root}/generated_bundles", "event_id", bundles.GENERATED_BUNDLES) == []
    sinks.write_files(documents.filter(F.col("ticket_id") == late), folder, "ticket_id")
    return bundled().withColumns({"refused": F.lit(refused), "stored_before": F.lit(not nothing)})


def harvest_runs(spark: SparkSession, sf_dir: str) -> harvest.HarvestRun:
    """Three runs of one identity: the first aborts, the second has abort and poison rows repaired and meets the skip
    limit, the third has all rows repaired."""
    root = scratch(spark, "harvest")
    source = b.harvest_source(spark, sf_dir)
    at = F.lit(STAMP).cast("timestamp_ntz")
    harvest.run_harvest(source, root, PARAMS, 1, at)
    calm = source.withColumns({"abort_flag": F.lit(False), "poison_flag": F.lit(False)})
    harvest.run_harvest(calm, root, PARAMS, 2, at)
    sound = calm.withColumn("transient_fail_until_attempt", F.lit(0))
    return harvest.run_harvest(sound, root, PARAMS, 3, at)


@query
def job_harvest(spark, sf_dir):
    """State of every row after the three runs."""
    last = harvest_runs(spark, sf_dir)
    marks = last.processed.withColumnRenamed("run_id", "processed_by")
    letters = last.dead_letters.groupBy(F.col("source_id").alias("id")).agg(
        F.count("*").alias("letters"), F.max("job_execution_id").alias("last_letter_run")
    )
    return b.harvest_source(spark, sf_dir).select("id").join(marks, "id", "left").join(letters, "id", "left")


@query
def job_harvest_steps(spark, sf_dir):
    """Status and counters of the three runs, as they are stored."""
    return harvest_runs(spark, sf_dir).steps


@query
def job_billing(spark, sf_dir):
    """A run with an overflowing row, then a restart on repaired data: every source billed once."""
    root = scratch(spark, "billing")
    billing.run_billing(b.usage_with_bad_row(spark, sf_dir), root, PARAMS, 1)
    run = billing.run_billing(b.usage_record(spark, sf_dir), root, PARAMS, 2)
    return run.charges


@query
def job_billing_ranges(spark, sf_dir):
    """The range ledger of the same two runs."""
    root = scratch(spark, "billing")
    billing.run_billing(b.usage_with_bad_row(spark, sf_dir), root, PARAMS, 1)
    run = billing.run_billing(b.usage_record(spark, sf_dir), root, PARAMS, 2)
    return run.ranges.drop("identity")


@query
def job_payment_summary(spark, sf_dir):
    out = payments.payment_summary(spark, payment_files(spark, sf_dir))
    return out.withColumn("payment_total", F.col("payment_total").cast("double"))


# ---- streaming ----------------------------------------------------------------------------


@query
def run_incremental(spark, sf_dir):
    """Orders streamed into charges; the second run has lost its checkpoint and adds nothing."""
    root = scratch(spark, "incremental")
    schema = b.table(spark, sf_dir, "orders").schema
    target, columns = f"{root}/billing_charge", "source_id BIGINT, cost BIGINT"

    def rate(batch: DataFrame) -> DataFrame:
        units = F.floor("o_totalprice").cast("bigint")
        per_unit = (1 + F.col("o_orderkey") % 9).cast("bigint")
        return batch.select(F.col("o_orderkey").alias("source_id"), money.rate_exact(units, per_unit).alias("cost"))

    for attempt in ("first", "second"):
        source = incremental.read_increments(spark, f"{sf_dir}/orders.parquet*", schema)
        incremental.run_incremental(source, rate, target, "source_id", columns, f"{root}/{attempt}")
    return sinks.read_table(spark, target, columns)


@query
def stream_rate(spark, sf_dir):
    """All windows of the event stream, those that no watermark has closed yet among them; the second run continues
    from the state of the first and finds nothing new."""
    root = scratch(spark, "stream_rate")
    schema = b.table(spark, sf_dir, "events").schema
    key, columns = ["tag", "window_start"], "tag STRING, window_start TIMESTAMP, events BIGINT, per_minute DOUBLE"
    for _ in range(2):
        source = incremental.read_increments(spark, f"{sf_dir}/events.parquet*", schema)
        tagged = source.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("tag"))
        incremental.run_to_versions(incremental.stream_rate(tagged), f"{root}/out", key, columns, f"{root}/state")
    return readable(sinks.read_versions(spark, f"{root}/out", key, columns))
