"""Ticket signing: token, display fields and registry row of every open ticket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.checks import check_min_bytes, check_optional_long, unprocessed
from millrace.functions.text import ticket_fields, ticket_file_name
from millrace.functions.tokens import checksum, sign_token
from millrace.operators.bucketed import Bucketed, bucketed
from millrace.operators.sinks import write_expecting
from millrace.plans.params import require, text
from millrace.schemas import GENERATED_FILES, MARK, STORED_FILES


def ticket_documents(tickets: DataFrame, secret: str, event_id: str | None = None) -> DataFrame:
    """Open tickets with token and document text; file name, checksum and size follow from it."""
    rows = ticket_fields(unprocessed(tickets, event_id)).withColumn(
        "token", sign_token(F.col("id"), F.col("ticket_code"), secret)
    )
    document = F.concat_ws(
        "\n",
        "event_name",
        "holder_name",
        "seat",
        "event_location",
        "event_time",
        "ticket_code",
        "token",
    )
    return rows.withColumn("document", document).select(
        F.col("id").alias("ticket_id"),
        "event_id",
        "token",
        "document",
        ticket_file_name(F.col("id")).alias("file_name"),
        checksum(F.encode("document", "UTF-8")).alias("checksum_sha256"),
        F.octet_length(F.encode("document", "UTF-8")).cast("bigint").alias("file_size_bytes"),
    )


def registry_rows(documents: DataFrame, output_dir: str) -> DataFrame:
    """Registry rows with the document beside them; readers of the registry do not touch that column."""
    return documents.select(
        "ticket_id",
        "event_id",
        F.lit("LOCAL").alias("storage_type"),
        F.concat(F.lit(f"{output_dir}/"), F.col("file_name")).alias("storage_path"),
        "checksum_sha256",
        "file_size_bytes",
        "document",
    )


def stored_registry(spark: SparkSession, root: str) -> Bucketed:
    return bucketed(spark, f"{root}/generated_files", "ticket_id", STORED_FILES)


def stored_marks(spark: SparkSession, root: str) -> Bucketed:
    return bucketed(spark, f"{root}/tickets_processed", "id", MARK)


def run_tickets(
    tickets: DataFrame, root: str, secret: str, run_id: int, event_id: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Sign and register the open tickets; returns ``(registry, marks)``.

    The documents and their registry rows are stored in one write, keyed by ticket, then the marks. A
    ticket without a mark whose row is stored already only gets its mark: a run that broke between
    the two writes is completed by the next one.

    Registry and marks are bucketed by ticket. The open tickets are shuffled once, into the same buckets, and meet the
    stored keys there; the history itself never moves.
    """
    spark = tickets.sparkSession
    require(spark, check_min_bytes(text(secret)), check_optional_long(text(event_id)))
    registry, marks = stored_registry(spark, root), stored_marks(spark, root)
    open_ = marks.absent(unprocessed(tickets, event_id), "id", unique_keys=True)
    rows = registry_rows(ticket_documents(open_, secret, event_id), f"{root}/tickets")
    fresh = registry.absent(rows, unique_keys=True, in_place=True)
    registry.append(write_expecting(fresh, tickets, registry.read(), "ticket_id", "id"))
    # Every open ticket has its row now.
    done = open_.select("id", F.lit(run_id).cast("bigint").alias("run_id"))
    marks.append(done)
    names = T.StructType.fromDDL(GENERATED_FILES).names
    return registry.read().select(*names), marks.read()
