"""The pipeline's tables as views over the test tables.

Flags that the pipelines react to (processed, poison, abort, refused) are set by arithmetic on keys
so that every case occurs; each view covers the whole underlying table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def usage_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("subscriber_id"),
        F.floor("o_totalprice").cast("bigint").alias("units"),
        (1 + F.col("o_orderkey") % 9).cast("bigint").alias("rate"),
    )


# Fixed value: the id of the usage row whose product overflows.
BAD_USAGE_ID = 1013


def usage_with_bad_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.col("id") == BAD_USAGE_ID
    return usage_record(spark, sf_dir).withColumns(
        {
            "units": F.when(bad, F.lit(9223372036854775807)).otherwise(F.col("units")),
            "rate": F.when(bad, F.lit(2).cast("bigint")).otherwise(F.col("rate")),
        }
    )


def billed_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Charges from an earlier run: finished orders, with a cost that a new run must not change."""
    return (
        table(spark, sf_dir, "orders")
        .filter("o_orderstatus = 'F'")
        .select(
            F.col("o_orderkey").alias("source_id"),
            F.col("o_custkey").alias("subscriber_id"),
            F.floor("o_totalprice").cast("bigint").alias("units"),
            F.lit(1).cast("bigint").alias("rate"),
            F.floor("o_totalprice").cast("bigint").alias("cost"),
        )
    )


def harvest_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_ = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        id_.alias("id"),
        F.col("props").alias("payload"),
        (id_ % 211 == 7).alias("poison_flag"),
        F.when(id_ % 97 == 3, 1)
        .when(id_ % 101 == 5, 2)
        .when(id_ % 499 == 11, 10)
        .otherwise(0)
        .alias("transient_fail_until_attempt"),
        (id_ == 777).alias("abort_flag"),
        F.lit(False).alias("processed"),
    )


def persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_ = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        id_.alias("id"),
        F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
        F.when(id_ % 50 != 0, F.split_part(F.col("c_name"), F.lit("#"), F.lit(2))).alias("last_name"),
        F.col("c_mktsegment").alias("profession"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        (id_ % 3 == 0).alias("processed"),
    )


def person_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited lines of all persons; some have two fields only, some one too many."""
    id_ = F.col("id")
    names = F.concat_ws(",", "first_name", F.coalesce("last_name", F.lit("")))
    full = F.concat_ws(",", names, "email", "profession")
    line = F.when(id_ % 40 == 0, names).when(id_ % 41 == 0, F.concat(full, F.lit(",more"))).otherwise(full)
    return persons(spark, sf_dir).select(line.alias("value"))


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").cast("decimal(19,2)").alias("value")
    )


def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The receiver's answer to each dispatch group; every fourth group is refused."""
    groups = table(spark, sf_dir, "customer").select(
        F.call_function("div", F.col("c_custkey"), F.lit(32)).alias("group_no")
    )
    return groups.distinct().withColumn("accepted", F.col("group_no") % 4 != 0)


def event_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_ = F.col("o_orderkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    orders = table(spark, sf_dir, "orders")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        id_.alias("id"),
        (F.col("o_custkey") % 50 + 1).alias("event_id"),
        F.concat(F.lit("T-"), id_.cast("string")).alias("ticket_code"),
        F.col("c_name").alias("holder_name"),
        F.col("c_mktsegment").alias("event_name"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Hall "), "o_orderstatus")).alias(
            "event_location"
        ),
        F.when(id_ % 4 != 0, F.col("o_orderpriority")).alias("seat"),
        F.col("o_orderdate").alias("event_datetime"),
        (id_ % 5 == 0).alias("processed"),
    )


def document_text(code: Column, holder: Column) -> Column:
    return F.concat(code, F.lit("|"), holder)


def generated_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows of the tickets that are processed already."""
    content = document_text(F.col("ticket_code"), F.col("holder_name"))
    return (
        event_tickets(spark, sf_dir)
        .filter("processed")
        .select(
            F.col("id").alias("ticket_id"),
            F.lit("LOCAL").alias("storage_type"),
            F.concat(F.lit("/data/tickets/"), F.col("id").cast("string"), F.lit(".pdf")).alias(
                "storage_path"
            ),
            F.sha2(content, 256).alias("checksum_sha256"),
            F.octet_length(content).cast("bigint").alias("file_size_bytes"),
        )
    )


# Fixed value: the header of payment files.
PAYMENT_HEADER = "transaction_id,account_id,amount,currency,status"


def payment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delimited payment lines; every twentieth lacks all fields behind the account."""
    key = F.col("o_orderkey").cast("string")
    account = F.col("o_custkey").cast("string")
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    head = F.concat(F.lit("TXN-"), key, F.lit(",ACC-"), account, F.lit(","))
    line = F.when(F.col("o_orderkey") % 20 == 0, F.concat(head, F.lit(","))).otherwise(
        F.concat(head, amount, F.lit(",USD,COMPLETED"))
    )
    return table(spark, sf_dir, "orders").select(line.alias("value"))


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ledger rows: one execution per event."""
    id_ = F.col("event_id")
    ms = F.round(F.col("value") * 10).cast("bigint")
    params = F.create_map(
        F.lit("DATE"),
        F.date_format("ts", "yyyy-MM-dd"),
        F.lit("ATTEMPT_NUMBER"),
        (F.col("user_id") % 3 + 1).cast("string"),
    )
    return table(spark, sf_dir, "events").select(
        id_.alias("execution_id"),
        F.col("event_type").alias("job_name"),
        params.alias("params"),
        F.col("ts").alias("start_time"),
        F.when(id_ % 10 != 1, F.timestamp_add("MILLISECOND", ms, F.col("ts"))).alias("end_time"),
        F.when(id_ % 10 == 0, "FAILED")
        .when(id_ % 10 == 1, "STARTED")
        .otherwise("COMPLETED")
        .alias("status"),
    )


def metric_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed events with a duration and the status code of their answer."""
    id_ = F.col("event_id")
    code = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("50"), (id_ % 5).cast("string")))
        .when(F.col("user_id") % 7 == 0, F.concat(F.lit("40"), (id_ % 5).cast("string")))
        .otherwise("200")
    )
    return table(spark, sf_dir, "events").select(
        "ts", F.col("event_type").alias("tag"), F.col("value").alias("duration"), code.alias("status_code")
    )


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored job definitions, one per customer name."""
    id_ = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        id_.alias("definition_id"),
        F.lower("c_name").alias("job_name"),
        F.concat(F.lit("1."), (id_ % 7).cast("string"), F.lit(".0")).alias("version"),
        (id_ % 2 == 0).alias("enabled"),
        F.when(id_ % 11 == 0, "FAILED")
        .when(id_ % 3 == 0, "LOADED")
        .otherwise("UNLOADED")
        .alias("load_status"),
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Built-in jobs: the customers of the building segment double as registered names."""
    return (
        table(spark, sf_dir, "customer")
        .filter("c_mktsegment = 'BUILDING'")
        .select(
            F.lower("c_name").alias("job_name"),
            F.lit("2.0.0").alias("version"),
            F.concat(F.lit("built in "), F.lower("c_mktsegment")).alias("author"),
        )
    )


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uploaded archives made from raw pages, with every kind of defect."""
    id_ = F.col("page_id")
    html = F.encode("html", "UTF-8")
    magic = F.lit(bytes([0x50, 0x4B, 0x03, 0x04]))
    return table(spark, sf_dir, "pages").select(
        id_.alias("upload_id"),
        F.concat(F.lit("page-"), id_.cast("string"), F.when(id_ % 7 == 0, ".zip").otherwise(".JAR")).alias(
            "file_name"
        ),
        F.when(id_ % 5 == 0, html).when(id_ % 31 == 1, F.lit(b"")).otherwise(F.concat(magic, html)).alias("content"),
        F.when(id_ % 6 == 0, F.col("url")).otherwise(F.regexp_extract("url", "//([^/]+)", 1)).alias(
            "job_name"
        ),
        F.when(id_ % 13 == 0, "  ").otherwise(F.concat(F.lit("1."), id_.cast("string"))).alias("version"),
        F.when(id_ % 11 == 0, "Plain")
        .when(id_ % 17 == 0, "")
        .otherwise(F.concat(F.lit("org.example.Page"), id_.cast("string")))
        .alias("class_name"),
    )
