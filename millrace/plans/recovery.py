"""Dispatch recovery: rebuild the payloads of refused groups and send them again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import payload_item, to_payload_json
from millrace.operators.faults import DISPATCH_SIZE, recover, run_status
from millrace.operators.joins import group_members
from millrace.operators.sinks import replace_in
from millrace.session import stable
from millrace.sources.tables import scan_by_status

GROUP_SCHEMA = "group_no BIGINT, dispatch_status STRING, records_included BIGINT"


@dataclass(frozen=True)
class RecoveryRun:
    status: str
    groups: DataFrame


def recovery_payloads(groups: DataFrame, members: DataFrame, size: int = DISPATCH_SIZE) -> DataFrame:
    """``(group_no, page, payload)`` of every refused group; one without members sends an empty list."""
    pages = group_members(
        scan_by_status(groups, "ERROR").select("group_no"), members, payload_item(), size
    )
    body = F.struct(F.size("items").alias("items_size"), "items")
    return pages.select("group_no", "page", to_payload_json(body).alias("payload"))


def run_recovery(
    groups: DataFrame, members: DataFrame, accepted: DataFrame, root: str
) -> RecoveryRun:
    """Send all refused groups again and store those whose state changed.

    The refused groups are one snapshot: a group that turns SENT does not move the others.
    """
    errors = scan_by_status(groups, "ERROR")
    after = stable(recover(errors, members, accepted))
    changed = after.filter(~F.col("failed")).select("group_no", "dispatch_status", "records_included")
    replace_in(changed, f"{root}/recovered_group", "group_no", GROUP_SCHEMA)
    return RecoveryRun(run_status(after).first()["status"], after)
