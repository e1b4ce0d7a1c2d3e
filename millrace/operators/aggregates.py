"""Totals, reconciliations, manifests and per-job maps; every aggregate combines on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import bundle_key, entry_name
from millrace.operators.joins import event_files
from millrace.operators.ordering import (
    ROWS_PER_BUCKET,
    Bounds,
    assign_chunk,
    assign_id_range,
    id_ranges,
    running_total,
)

# Where a merged definition came from, and its states.
BUILT_IN, UPLOADED = "CLASSPATH", "UPLOADED"
ACTIVE, LOADED, ENABLED, DISABLED = "ACTIVE", "LOADED", "ENABLED", "DISABLED"


def count_and_total(lines: DataFrame, amount: str = "amount") -> DataFrame:
    """All lines counted, present amounts summed."""
    return lines.agg(
        F.count("*").alias("payment_rows"),
        F.coalesce(F.sum(amount), F.lit(0)).alias("payment_total"),
    )


def reconcile(charges: DataFrame, usage: DataFrame) -> DataFrame:
    """Charged against rated: equal counts prove that nothing is billed twice.

    Both tables pass through one aggregate as tagged rows; sums are exact decimals.
    """
    charged = charges.select(
        F.lit(True).alias("charged"), F.col("source_id").alias("key"), F.col("cost").alias("amount")
    )
    rated = usage.select(
        F.lit(False).alias("charged"),
        F.col("id").alias("key"),
        F.try_multiply("units", "rate").alias("amount"),
    )
    per_key = (
        charged.unionByName(rated)
        .groupBy("key")
        .agg(
            F.count_if("charged").alias("c"),
            F.count_if(~F.col("charged")).alias("u"),
            F.sum(F.when(F.col("charged"), F.col("amount").cast("decimal(19,0)"))).alias("cs"),
            F.sum(F.when(~F.col("charged"), F.col("amount").cast("decimal(19,0)"))).alias("us"),
            F.count_if(~F.col("charged") & F.col("amount").isNull()).alias("uo"),
        )
    )

    def total(col: Column) -> Column:
        return F.coalesce(col, F.lit(0))

    return per_key.agg(
        total(F.sum("c")).alias("charge_rows"),
        F.count_if(F.col("c") > 0).alias("charged_sources"),
        total(F.sum("u")).alias("usage_rows"),
        total(F.sum("cs")).cast("decimal(38,0)").alias("charge_sum"),
        total(F.sum("us")).cast("decimal(38,0)").alias("usage_sum"),
        F.count_if(F.col("c") > 1).alias("double_billed"),
        # Usage that cannot be rated exactly is in no sum.
        total(F.sum("uo")).alias("unrated_rows"),
    )


def set_digest(*parts: Column) -> list[Column]:
    """Four exact sums over slices of each row's SHA-256: an order-free digest of a set of rows.

    Unlike a hash over the concatenated rows it needs constant state per group and merges on the
    map side (the additive hash of Bellare and Micciancio, 1997).
    """
    sized = [F.coalesce(F.concat(F.char_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    h = F.sha2(F.concat(*sized), 256)
    slices = [F.conv(F.substring(h, 1 + 15 * i, 15), 16, 10).cast("decimal(28,0)") for i in range(4)]
    return [F.sum(s).alias(f"_d{i}") for i, s in enumerate(slices)]


def finish_digest() -> Column:
    return F.sha2(F.concat_ws("-", *[F.col(f"_d{i}").cast("string") for i in range(4)]), 256)


def bundle_entries(files: DataFrame, tickets: DataFrame, event_id: int | None = None) -> DataFrame:
    """The content of every bundle, one row per entry."""
    return event_files(files, tickets, event_id).select(
        "event_id",
        "ticket_id",
        entry_name(F.col("ticket_id"), F.col("storage_path")).alias("entry"),
        "file_size_bytes",
        "checksum_sha256",
    )


def ordered_entries(entries: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """The entries with their place in the archive, which is in ticket order."""
    return running_total(
        entries, ["ticket_id"], ["event_id"], name="entry_no", rows_per_bucket=rows_per_bucket
    )


def bundle_manifest(entries: DataFrame) -> DataFrame:
    """One row per event that has files: count, size, content digest and storage path."""
    return (
        entries.groupBy("event_id")
        .agg(
            F.count("*").alias("ticket_count"),
            F.sum("file_size_bytes").alias("file_size_bytes"),
            *set_digest(F.col("entry"), F.col("checksum_sha256")),
        )
        .select(
            "event_id",
            F.lit("LOCAL").alias("storage_type"),
            bundle_key(F.col("event_id")).alias("storage_path"),
            finish_digest().alias("checksum_sha256"),
            "file_size_bytes",
            "ticket_count",
            F.lit("COMPLETED").alias("status"),
        )
    )


def group_stats(members: DataFrame, group: str = "group_no") -> DataFrame:
    return members.groupBy(group).agg(F.count("*").alias("records_included"))


def status_health(definitions: DataFrame, registry: DataFrame) -> DataFrame:
    """Loaded and failed counts; DOWN as soon as one definition failed to load."""
    rows = registry.select(F.lit(1).alias("loaded"), F.lit(0).alias("failed")).unionAll(
        definitions.filter(F.col("load_status") == "FAILED").select(F.lit(0), F.lit(1))
    )
    return rows.agg(
        F.coalesce(F.sum("loaded"), F.lit(0)).alias("loaded"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
    ).withColumn("status", F.when(F.col("failed") > 0, "DOWN").otherwise("UP"))


def _counters(chunk: int) -> list[Column]:
    outcome = F.col("outcome")
    skip = ~outcome.isin("OK", "FILTERED")
    return [
        F.count("*").alias("read_count"),
        F.count_if(outcome == "FILTERED").alias("filter_count"),
        F.count_if(outcome == "OK").alias("write_count"),
        F.count_if(skip & (F.col("phase") == "READ")).alias("read_skip_count"),
        F.count_if(skip & (F.col("phase") == "PROCESS")).alias("process_skip_count"),
        F.count_if(skip & (F.col("phase") == "WRITE")).alias("write_skip_count"),
        F.ceil(F.count("*") / chunk).cast("bigint").alias("commit_count"),
    ]


def step_counters(rows: DataFrame, chunk: int, step: str = "step_name") -> DataFrame:
    """Counters per step of committed rows with an ``outcome`` of OK, FILTERED or a skip kind.

    Commits are the chunks the rows fill, so no positions are needed.
    """
    return rows.groupBy(step).agg(*_counters(chunk))


def all_counters(rows: DataFrame, chunk: int, *more: Column) -> DataFrame:
    """The counters of all rows and ``more`` aggregates as one row, zeros if there is none."""
    return rows.agg(*_counters(chunk), *more)


def running_by_job(
    executions: DataFrame,
    jobs: DataFrame,
    page_size: int = 1000,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """For every registered job its open executions as maps of execution id to parameters.

    A job with none keeps one empty map; a job with more than ``page_size`` has several pages.
    """
    open_runs = executions.filter(F.col("status") == "STARTED").select(
        "job_name", "execution_id", "params_text"
    )
    paged = assign_chunk(
        open_runs, "execution_id", page_size, ["job_name"], "page", rows_per_bucket
    )
    pairs = F.sort_array(
        F.collect_list(F.struct(F.col("execution_id").cast("string"), F.col("params_text")))
    )
    pages = paged.groupBy("job_name", "page").agg(F.map_from_entries(pairs).alias("running"))
    known = jobs.select("job_name").distinct()
    idle = known.join(open_runs.select("job_name").distinct(), "job_name", "left_anti").withColumns(
        {"page": F.lit(0).cast("bigint"), "running": F.create_map().cast("map<string,string>")}
    )
    # Pages of a busy job are on the left, where a skewed partition can be split.
    return pages.join(known, "job_name", "left_semi").unionByName(idle)


def tagged_counter(events: DataFrame, tag: str = "job_name") -> DataFrame:
    return events.groupBy(tag).agg(F.count("*").alias("executions"))


def partition_totals(
    charges: DataFrame, bounds: DataFrame, n: int, key: str = "source_id", cost: str = "cost"
) -> DataFrame:
    """Rows and cost per id range, empty ranges included."""
    both = bounds.select(F.struct("min_id", "max_id").alias("b")).scalar()
    limits = Bounds(both.getField("min_id"), both.getField("max_id"))
    totals = (
        assign_id_range(charges, key, n, limits)
        .groupBy("range_no")
        .agg(
            F.count("*").alias("charge_rows"),
            F.sum(F.col(cost).cast("decimal(19,0)")).alias("total_cost"),
        )
    )
    return (
        id_ranges(bounds, n)
        .join(totals, "range_no", "left")
        .select(
            "range_no",
            "min_id",
            "max_id",
            F.coalesce("charge_rows", F.lit(0).cast("bigint")).alias("charge_rows"),
            F.coalesce("total_cost", F.lit(0)).cast("decimal(38,0)").alias("total_cost"),
        )
    )


def union_with_precedence(first: DataFrame, second: DataFrame, key: str = "job_name") -> DataFrame:
    """First source wins on an equal name, only enabled rows of the second join it.

    Columns the second source lacks are NULL; ``source`` and ``status`` tell where a row came from.
    """
    active = first.withColumns({"source": F.lit(BUILT_IN), "status": F.lit(ACTIVE)})
    status = (
        F.when(F.upper("load_status") == LOADED, LOADED)
        .when(F.col("enabled"), ENABLED)
        .otherwise(DISABLED)
    )
    uploaded = (
        second.filter("enabled")
        .join(first.select(key), key, "left_anti")
        .withColumns({"source": F.lit(UPLOADED), "status": status})
        .drop("enabled", "load_status")
    )
    return active.unionByName(uploaded, allowMissingColumns=True)
