"""Declared schemas of the pipeline tables."""

from __future__ import annotations

PERSONS_CSV = "first_name STRING, last_name STRING, email STRING, profession STRING"

PERSONS = (
    "id BIGINT, first_name STRING, last_name STRING, profession STRING, email STRING,"
    " processed BOOLEAN"
)

PERSONS_V2 = (
    "source_id BIGINT, snapshot_date DATE, first_name STRING, last_name STRING, email STRING,"
    " profession STRING, salary DECIMAL(19,2), uuid_v4 STRING"
)

DISPATCHED_GROUP = (
    "group_no BIGINT, uuid_v4 STRING, dispatch_status STRING, records_included BIGINT"
)

GROUP_MEMBER = "id BIGINT, group_no BIGINT"

GENERATED_FILES = (
    "ticket_id BIGINT, event_id BIGINT, storage_type STRING, storage_path STRING,"
    " checksum_sha256 STRING, file_size_bytes BIGINT"
)

# The registry as it is stored has the document itself behind its columns.
STORED_FILES = f"{GENERATED_FILES}, document STRING"

GENERATED_BUNDLES = (
    "event_id BIGINT, storage_type STRING, storage_path STRING, checksum_sha256 STRING,"
    " file_size_bytes BIGINT, ticket_count BIGINT, status STRING"
)

DEAD_LETTER = (
    "source_id BIGINT, raw_payload STRING, failure_phase STRING, failure_type STRING,"
    " exception_class STRING, exception_msg STRING, attempt_count INT, job_execution_id BIGINT,"
    " recorded_at TIMESTAMP_NTZ"
)

BILLING_CHARGE = (
    "source_id BIGINT, subscriber_id BIGINT, units BIGINT, rate BIGINT, cost BIGINT,"
    " job_execution_id BIGINT"
)

MARK = "id BIGINT, run_id BIGINT"

CHECKPOINT = "identity STRING, run_id BIGINT, last_id BIGINT, status STRING"

RANGE_LEDGER = (
    "identity STRING, run_id BIGINT, range_no INT, min_id BIGINT, max_id BIGINT, status STRING"
)

STEP_EXECUTION = (
    "run_id BIGINT, step_name STRING, status STRING, reason STRING, read_count BIGINT, filter_count BIGINT,"
    " write_count BIGINT, read_skip_count BIGINT, process_skip_count BIGINT, write_skip_count BIGINT,"
    " commit_count BIGINT, rollback_count BIGINT"
)
