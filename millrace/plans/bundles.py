"""Event bundles: one manifest row per event, replaced when the event is bundled again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.checks import check_positive_long
from millrace.operators.aggregates import bundle_entries, bundle_manifest
from millrace.operators.sinks import read_versions, replace_in
from millrace.plans.params import require, text
from millrace.schemas import GENERATED_BUNDLES
from millrace.sources.files import require_files


def run_bundles(
    files: DataFrame,
    tickets: DataFrame,
    root: str,
    event_id: str | None = None,
    found: DataFrame | None = None,
) -> DataFrame:
    """Bundle one event, or all events in one pass, and return the stored bundles.

    ``found`` lists the files that really exist; a registered file missing there fails the run
    before anything is stored. An event without files leaves no row.
    """
    spark = files.sparkSession
    event = None
    if event_id is not None:
        require(spark, check_positive_long(text(event_id)))
        event = int(event_id)
    entries = bundle_entries(files, tickets, event)
    if found is not None:
        wanted = files.select("ticket_id", F.col("storage_path").alias("path"))
        present = require_files(wanted.join(entries.select("ticket_id"), "ticket_id", "left_semi"), found)
        entries = entries.join(present.select("ticket_id"), "ticket_id", "left_semi")
    path = f"{root}/generated_bundles"
    replace_in(bundle_manifest(entries), path, "event_id", GENERATED_BUNDLES)
    return read_versions(spark, path, "event_id", GENERATED_BUNDLES)
