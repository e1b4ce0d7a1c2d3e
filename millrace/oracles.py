"""The catalog's queries as SQL over the same tables."""

from __future__ import annotations

import re

from millrace.catalog import GRID, RUN_DATE, RUN_ID, SECRET, SHORT_PAYLOAD, STAMP
from millrace.functions.text import MESSAGE_LENGTH, MISSING_FIELD

# The two pads of the keyed hash, by its definition: the secret filled to 64 bytes, each with one of two fixed values.
_KEY = SECRET.encode().ljust(64, b"\x00")
_INNER, _OUTER = (bytes(byte ^ value for byte in _KEY).hex() for value in (0x36, 0x5C))


def _uuid(text: str) -> str:
    h = f"sha256({text})"
    return (
        f"(substr({h},1,8)||'-'||substr({h},9,4)||'-4'||substr({h},14,3)||'-a'"
        f"||substr({h},18,3)||'-'||substr({h},21,12))"
    )


def _hmac(message: str) -> str:
    inner = f"sha256(unhex('{_INNER}') || encode({message}))"
    outer = f"unhex(sha256(unhex('{_OUTER}') || unhex({inner})))"
    return f"replace(translate(to_base64({outer}), '+/', '-_'), '=', '')"


def _stamp(col: str) -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S')"


def _iso(col: str) -> str:
    micros = f"strftime({col}, '%f')"
    return f"""(strftime({col}, '%Y-%m-%dT%H:%M')
        || CASE WHEN second({col}) = 0 AND {micros} = '000000' THEN '' ELSE strftime({col}, ':%S') END
        || CASE WHEN {micros} = '000000' THEN ''
                WHEN right({micros}, 3) = '000' THEN '.' || left({micros}, 3)
                ELSE '.' || {micros} END)"""


# Views by name; a view may use others.
VIEWS: dict[str, str] = {
    "usage_record": """
        SELECT o_orderkey AS id, o_custkey AS subscriber_id,
               CAST(floor(o_totalprice) AS BIGINT) AS units, CAST(1 + o_orderkey % 9 AS BIGINT) AS rate
        FROM orders""",
    "usage_bad": """
        SELECT id, subscriber_id,
               CASE WHEN id = 1013 THEN 9223372036854775807 ELSE units END AS units,
               CASE WHEN id = 1013 THEN 2 ELSE rate END AS rate
        FROM usage_record""",
    "charges": """
        SELECT id AS source_id, subscriber_id, units, rate, units * rate AS cost FROM usage_record""",
    "billed_before": """
        SELECT o_orderkey AS source_id, o_custkey AS subscriber_id,
               CAST(floor(o_totalprice) AS BIGINT) AS units, CAST(1 AS BIGINT) AS rate,
               CAST(floor(o_totalprice) AS BIGINT) AS cost
        FROM orders WHERE o_orderstatus = 'F'""",
    "harvest_source": """
        SELECT event_id AS id, props AS payload, event_id % 211 = 7 AS poison_flag,
               CASE WHEN event_id % 97 = 3 THEN 1 WHEN event_id % 101 = 5 THEN 2
                    WHEN event_id % 499 = 11 THEN 10 ELSE 0 END AS transient_fail_until_attempt,
               event_id = 777 AS abort_flag
        FROM events""",
    "outcomes": """
        SELECT *, CASE WHEN abort_flag THEN 'ABORT' WHEN poison_flag THEN 'POISON'
                       WHEN transient_fail_until_attempt > 0 THEN 'TRANSIENT' ELSE 'NONE' END AS fault,
               CASE WHEN abort_flag THEN 'ABORT' WHEN poison_flag THEN 'SKIP'
                    WHEN transient_fail_until_attempt >= 3 THEN 'RETRY_EXHAUSTED' ELSE 'OK' END AS outcome
        FROM harvest_source""",
    "persons": """
        SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name,
               CASE WHEN c_custkey % 50 <> 0 THEN split_part(c_name, '#', 2) END AS last_name,
               c_mktsegment AS profession, lower(c_name) || '@example.com' AS email,
               c_custkey % 3 = 0 AS processed, CAST(c_acctbal AS DECIMAL(19,2)) AS value
        FROM customer""",
    "taken_persons": """
        SELECT *, (row_number() OVER (ORDER BY id) - 1) // 32 AS group_no FROM persons WHERE last_name IS NOT NULL""",
    "person_lines": """
        SELECT *, CASE WHEN id % 40 = 0 THEN 2 WHEN id % 41 = 0 THEN 5 ELSE 4 END AS n_fields,
               first_name || ',' || coalesce(last_name, '')
               || CASE WHEN id % 40 = 0 THEN '' ELSE ',' || email || ',' || profession END
               || CASE WHEN id % 40 <> 0 AND id % 41 = 0 THEN ',more' ELSE '' END AS line
        FROM persons""",
    "all_members": f"""
        SELECT *, CAST((row_number() OVER (ORDER BY id) - 1) // 32 AS BIGINT) AS group_no,
               {_uuid(f"'{RUN_DATE}|' || id")} AS uuid_v4
        FROM persons WHERE NOT processed""",
    "sent_members": """
        SELECT * REPLACE (CASE WHEN group_no % 4 <> 0 THEN group_no END AS group_no) FROM all_members""",
    "stored_groups": """
        SELECT group_no, CASE WHEN group_no % 4 = 0 THEN 'ERROR' ELSE 'SENT' END AS dispatch_status,
               CASE WHEN group_no % 4 = 0 THEN 0 ELSE count(*) END AS records_included
        FROM all_members GROUP BY group_no""",
    "acceptance": "SELECT DISTINCT c_custkey // 32 AS group_no FROM customer",
    "tickets": """
        SELECT o_orderkey AS id, o_custkey % 50 + 1 AS event_id, 'T-' || o_orderkey AS ticket_code,
               c_name AS holder_name, c_mktsegment AS event_name,
               CASE WHEN o_orderstatus <> 'P' THEN 'Hall ' || o_orderstatus END AS event_location,
               CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS seat,
               o_orderdate AS event_datetime, o_orderkey % 5 = 0 AS processed
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "files": """
        SELECT id AS ticket_id, 'LOCAL' AS storage_type, '/data/tickets/' || id || '.pdf' AS storage_path,
               sha256(ticket_code || '|' || holder_name) AS checksum_sha256,
               CAST(octet_length(encode(ticket_code || '|' || holder_name)) AS BIGINT) AS file_size_bytes
        FROM tickets WHERE processed""",
    "entries": """
        SELECT event_id, ticket_id,
               ticket_id || '-' || regexp_extract(storage_path, '[^/]+$') AS entry,
               file_size_bytes, checksum_sha256
        FROM files JOIN tickets ON ticket_id = id""",
    "manifest": f"""
        SELECT event_id, 'LOCAL' AS storage_type, 'bundles/event-' || event_id || '.zip' AS storage_path,
               sha256({" || '-' || ".join(
                   f"CAST(sum(CAST(('0x' || substr(h, {1 + 15 * i}, 15)) AS UBIGINT)) AS VARCHAR)"
                   for i in range(4))}) AS checksum_sha256,
               CAST(sum(file_size_bytes) AS BIGINT) AS file_size_bytes,
               count(*) AS ticket_count, 'COMPLETED' AS status
        FROM (SELECT *, sha256(length(entry) || ':' || entry || length(checksum_sha256) || ':' || checksum_sha256) AS h FROM entries)
        GROUP BY event_id""",
    "payments": """
        SELECT CASE WHEN o_orderkey % 20 = 0 THEN 'TXN-' || o_orderkey || ',ACC-' || o_custkey || ',,'
                    ELSE 'TXN-' || o_orderkey || ',ACC-' || o_custkey || ','
                         || CAST(o_totalprice AS DECIMAL(18,2)) || ',USD,COMPLETED' END AS line_value,
               CAST(CASE WHEN o_orderkey % 20 = 0 THEN 2 ELSE 5 END AS INTEGER) AS n_fields,
               CASE WHEN o_orderkey % 20 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
        FROM orders""",
    "runs": """
        SELECT event_id AS execution_id, event_type AS job_name, strftime(ts, '%Y-%m-%d') AS date,
               CAST(user_id % 3 + 1 AS VARCHAR) AS attempt, ts AS start_time,
               CASE WHEN event_id % 10 <> 1
                    THEN ts + to_milliseconds(CAST(round(value * 10) AS BIGINT)) END AS end_time,
               CASE WHEN event_id % 10 = 0 THEN 'FAILED' WHEN event_id % 10 = 1 THEN 'STARTED'
                    ELSE 'COMPLETED' END AS status,
               md5(length(event_type) || ':' || event_type || '14:ATTEMPT_NUMBER1:' || (user_id % 3 + 1)
                   || '4:DATE10:' || strftime(ts, '%Y-%m-%d')) AS identity
        FROM events""",
    "defined": """
        SELECT event_type AS job_name, min(event_id) AS definition_id, '1.0.0' AS version
        FROM events WHERE event_type <> 'view' GROUP BY event_type""",
    "metric": """
        SELECT ts, event_type AS tag, value AS duration,
               CASE WHEN event_type = 'error' THEN '50' || event_id % 5
                    WHEN user_id % 7 = 0 THEN '40' || event_id % 5 ELSE '200' END AS status_code
        FROM events""",
    "definitions": """
        SELECT lower(c_name) AS job_name, '1.' || c_custkey % 7 || '.0' AS version,
               c_custkey % 2 = 0 AS enabled,
               CASE WHEN c_custkey % 11 = 0 THEN 'FAILED' WHEN c_custkey % 3 = 0 THEN 'LOADED'
                    ELSE 'UNLOADED' END AS load_status
        FROM customer""",
    "registry": """
        SELECT lower(c_name) AS job_name, '2.0.0' AS version, 'built in building' AS author
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "bounds": "SELECT min(id) AS lo, max(id) AS hi FROM usage_record",
    "ranged": f"""
        SELECT u.*, CAST(least({GRID - 1}, (id - lo) // ((hi - lo) // {GRID})) AS INTEGER) AS range_no
        FROM usage_bad u, bounds""",
    "ranks": """
        SELECT *, row_number() OVER (PARTITION BY range_no ORDER BY id) - 1 AS pos,
               CAST(units AS HUGEINT) * rate > 9223372036854775807 AS bad
        FROM ranged""",
    "range_state": """
        SELECT range_no, count(*) AS read_rows, min(id) FILTER (bad) AS first_bad,
               min(pos) FILTER (bad) // 100 AS bad_chunk
        FROM ranks GROUP BY range_no""",
    "cut_ranks": "SELECT *, row_number() OVER (ORDER BY id) - 1 AS pos FROM outcomes",
}


def sql(body: str) -> str:
    """The body behind the views it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, view in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(view)
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    joint = "," if body.lstrip().upper().startswith("WITH ") else ""
    rest = body.lstrip()[5:] if joint else body
    return f"WITH {views}{joint}\n{rest}"


def _committed(limit: int, chunk: int = 5) -> str:
    return f"""
        WITH skips AS (SELECT id, row_number() OVER (ORDER BY id) AS n FROM outcomes
                       WHERE outcome IN ('SKIP', 'RETRY_EXHAUSTED')),
             cut AS (SELECT least(coalesce((SELECT id FROM skips WHERE n = {limit + 1}), 9000000000000000000),
                                  coalesce((SELECT min(id) FROM outcomes WHERE outcome = 'ABORT'),
                                           9000000000000000000)) AS cut_id),
             p AS (SELECT coalesce((SELECT pos FROM cut_ranks, cut WHERE id = cut_id),
                                   9000000000000000000) // {chunk} AS bad_chunk)"""


def _rate(where: str = "", tag: bool = True) -> str:
    key = "tag, " if tag else ""
    return f"""
        SELECT {key}strftime(date_trunc('minute', ts) - to_minutes(k), '%Y-%m-%d %H:%M:%S') AS window_start,
               count(*) AS events, count(*) / 5.0::DOUBLE AS per_minute
        FROM metric, range(5) AS r(k) {where}
        GROUP BY ALL"""


def _p95(bucket: str) -> str:
    return f"""
        SELECT tag, {_stamp(bucket)} AS window_start, round(quantile_cont(duration, 0.95), 6) AS quantile
        FROM metric GROUP BY ALL"""


_FIVE = "time_bucket(INTERVAL '5 minutes', ts)"
_BLANK = "IS NULL OR trim({0}) = ''"

_DATES = """
    SELECT event_id,
           CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN '  '
                WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                WHEN 3 THEN ' ' || strftime(ts, '%Y-%m-%d') || ' '
                WHEN 4 THEN strftime(ts, '%Y-%m') WHEN 5 THEN '2024-02-30'
                ELSE strftime(ts, '%Y-%m-%d') END AS given
    FROM events"""

_LONGS = """
    SELECT o_orderkey,
           CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' || o_orderkey || ' '
                WHEN 2 THEN '-' || o_orderkey WHEN 3 THEN o_orderpriority
                WHEN 4 THEN '9223372036854775808' ELSE CAST(o_orderkey AS VARCHAR) END AS given
    FROM orders"""

_UPLOADS = """
    SELECT page_id AS upload_id,
           'page-' || page_id || CASE WHEN page_id % 7 = 0 THEN '.zip' ELSE '.JAR' END AS file_name,
           CASE WHEN page_id % 5 = 0 THEN encode(html) WHEN page_id % 31 = 1 THEN encode('')
                ELSE unhex('504B0304') || encode(html) END AS content,
           CASE WHEN page_id % 6 = 0 THEN url ELSE regexp_extract(url, '//([^/]+)', 1) END AS job_name,
           CASE WHEN page_id % 13 = 0 THEN '  ' ELSE '1.' || page_id END AS version,
           CASE WHEN page_id % 11 = 0 THEN 'Plain' WHEN page_id % 17 = 0 THEN ''
                ELSE 'org.example.Page' || page_id END AS class_name
    FROM pages"""

_UNSAFE = "'Job name and version must contain only alphanumeric, dot, dash, or underscore: '"

_KEYS = """
    SELECT page_id, CASE page_id % 5 WHEN 0 THEN '../' || path WHEN 1 THEN '/' || path
                         WHEN 2 THEN path || '/../../../x' WHEN 3 THEN path || '/./../y' ELSE path END AS key
    FROM (SELECT page_id, regexp_extract(url, '//[^/]+/([^?#]*)', 1) AS path FROM pages)"""

_ITEM = "{'uuid_v4': uuid_v4, 'first_name': first_name, 'last_name': last_name, 'email': email, 'profession': profession}"

_RECOVERED = """
    SELECT group_no,
           CASE WHEN dispatch_status = 'ERROR' AND group_no % 8 <> 0 THEN 'SENT' ELSE dispatch_status
           END AS dispatch_status,
           CASE WHEN dispatch_status = 'ERROR' AND group_no % 8 <> 0 THEN n ELSE records_included
           END AS records_included,
           dispatch_status = 'ERROR' AND group_no % 8 = 0 AS failed
    FROM stored_groups JOIN (SELECT group_no, count(*) AS n FROM all_members GROUP BY group_no) USING (group_no)"""

_TICKET_DOC = f"""
    SELECT id AS ticket_id, event_id,
           event_name || chr(10) || holder_name || chr(10) || coalesce(seat, '{MISSING_FIELD}') || chr(10)
           || coalesce(event_location, '{MISSING_FIELD}') || chr(10)
           || strftime(event_datetime, '%Y-%m-%d %H:%M') || chr(10) || ticket_code || chr(10)
           || id || '|' || ticket_code || '.' || {_hmac("id || '|' || ticket_code")} AS document
    FROM tickets WHERE NOT processed"""

_REPLACED = """
    SELECT * FROM billed_before WHERE source_id NOT IN (SELECT source_id FROM charges WHERE rate >= 5)
    UNION ALL SELECT * FROM charges WHERE rate >= 5"""

_MARKED = """
    SELECT id, event_id, processed OR hit AS processed, {0} AS changed
    FROM (SELECT *, id IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS hit FROM tickets)"""

_BILLED = f"""
    SELECT id AS source_id, u.subscriber_id, u.units, u.rate, u.units * u.rate AS cost,
           CASE WHEN bad_chunk IS NULL OR pos // 100 < bad_chunk THEN 1 ELSE 2 END::BIGINT AS job_execution_id
    FROM usage_record u JOIN (SELECT id, range_no, pos FROM ranks) USING (id)
    JOIN range_state USING (range_no)"""

_CHECKED = f"""
        SELECT upload_id,
               CASE WHEN NOT lower(file_name) LIKE '%.jar'
                    THEN 'File must have .jar extension; received: ' || file_name
                    WHEN octet_length(content) = 0 THEN 'File is empty — cannot read magic bytes'
                    WHEN left(hex(content), 8) <> '504B0304'
                    THEN 'File is not a valid JAR — missing ZIP/PK magic bytes. Expected 0x504B0304, got: '
                         || lower(left(hex(content), 8))
                    WHEN trim(class_name) = '' THEN 'mainClassName must not be blank'
                    WHEN NOT regexp_full_match(class_name, '([a-zA-Z_$][a-zA-Z0-9_$]*\\.)+[a-zA-Z_$][a-zA-Z0-9_$]*')
                    THEN 'mainClassName must be a fully-qualified Java class name (e.g. com.example.MyClass): '
                         || class_name
                    WHEN trim(job_name) = '' THEN 'Job name and version must not be blank'
                    WHEN NOT regexp_full_match(job_name, '[a-zA-Z0-9._\\-]+') THEN {_UNSAFE} || job_name
                    WHEN trim(version) = '' THEN 'Job name and version must not be blank'
                    WHEN NOT regexp_full_match(version, '[a-zA-Z0-9._\\-]+') THEN {_UNSAFE} || version
               END AS reason
        FROM ({_UPLOADS})"""

# Three harvest runs: rows of the first, of the second by position, and where the second ends.
_HARVEST = (
    _committed(5)
    + """,
             first AS (SELECT id FROM cut_ranks, p WHERE pos // 5 < bad_chunk),
             reached1 AS (SELECT id FROM outcomes, cut WHERE id < cut_id AND outcome IN ('SKIP', 'RETRY_EXHAUSTED')),
             second AS (SELECT id, transient_fail_until_attempt >= 3 AS skip,
                               row_number() OVER (ORDER BY id) - 1 AS pos
                        FROM outcomes WHERE id NOT IN (SELECT id FROM first)),
             skips2 AS (SELECT id, pos, row_number() OVER (ORDER BY id) AS n FROM second WHERE skip),
             cut2 AS (SELECT coalesce((SELECT id FROM skips2 WHERE n = 6), 9000000000000000000) AS cut_id,
                             coalesce((SELECT pos // 5 FROM skips2 WHERE n = 6), 9000000000000000000) AS bad_chunk),
             letters AS (SELECT id, 1 AS run FROM reached1
                         UNION ALL SELECT s.id, 2 FROM skips2 s, cut2 WHERE s.id < cut2.cut_id),
             per_id AS (SELECT id, count(*) AS letters, CAST(max(run) AS BIGINT) AS last_letter_run
                        FROM letters GROUP BY id)"""
)

BODIES: dict[str, str] = {
    # sources
    "scan_delimited": "SELECT first_name, last_name, email, profession FROM persons",
    "scan_permissive": "SELECT first_name, last_name, email, profession FROM person_lines WHERE n_fields = 4",
    "dead_letter_read": f"""
        SELECT CAST(NULL AS BIGINT) AS source_id, line AS raw_payload, 'READ' AS failure_phase, 'SKIP' AS failure_type,
               'MalformedLineException' AS exception_class,
               'Line has ' || n_fields || ' fields, 4 expected' AS exception_msg, 1 AS attempt_count,
               CAST({RUN_ID} AS BIGINT) AS job_execution_id, '{STAMP}' AS recorded_at
        FROM person_lines WHERE n_fields <> 4""",
    "dead_letter_write": f"""
        SELECT id AS source_id, payload AS raw_payload, 'WRITE' AS failure_phase, 'SKIP' AS failure_type,
               'ConstraintViolationException' AS exception_class,
               'Row breaks ' || CASE WHEN payload IS NULL THEN 'not_null(payload)'
                                     WHEN length(payload) > {SHORT_PAYLOAD} THEN 'max_length(payload)'
                                     ELSE 'at_least(id)' END AS exception_msg,
               1 AS attempt_count, CAST({RUN_ID} AS BIGINT) AS job_execution_id, '{STAMP}' AS recorded_at
        FROM harvest_source WHERE payload IS NULL OR length(payload) > {SHORT_PAYLOAD} OR id < 100""",
    "scan_lenient_lines": "SELECT line_value, n_fields, CAST(amount AS DOUBLE) AS amount FROM payments",
    "scan_ordered": "SELECT * FROM harvest_source ORDER BY id",
    "scan_id_ranges": f"""
        SELECT u.*, CAST(least({GRID - 1}, (id - lo) // ((hi - lo) // {GRID})) AS INTEGER) AS range_no
        FROM usage_record u, bounds""",
    "scan_one_range": f"""
        SELECT u.*, 'partition' || least({GRID - 1}, (id - lo) // ((hi - lo) // {GRID})) AS name
        FROM usage_record u, bounds""",
    "scan_keyset": "SELECT * EXCLUDE (value) FROM persons WHERE id > 0 AND NOT processed",
    "scan_keyset_page": """
        SELECT * EXCLUDE (value) FROM persons WHERE id > 20 AND NOT processed ORDER BY id LIMIT 50""",
    "scan_undispatched": "SELECT id, email FROM sent_members WHERE group_no IS NULL",
    "scan_by_status": "SELECT * FROM stored_groups WHERE dispatch_status = 'ERROR'",
    "scan_files": """
        SELECT s_suppkey // 100 AS block, CAST(sum(octet_length(encode(s_name)) + 1) AS BIGINT) AS size_bytes,
               sha256(string_agg(s_name || chr(10), '' ORDER BY s_suppkey)) AS checksum_sha256
        FROM supplier GROUP BY ALL""",
    "missing_files": """
        SELECT DISTINCT c_custkey // 100 AS path FROM customer
        WHERE c_custkey // 100 NOT IN (SELECT s_suppkey // 100 FROM supplier)""",
    # sinks
    "append": """
        SELECT id, upper(first_name) AS first_name, upper(last_name) AS last_name, profession, email,
               false AS processed
        FROM persons""",
    "insert_if_absent": """
        SELECT * FROM billed_before UNION ALL
        SELECT * FROM charges WHERE source_id NOT IN (SELECT source_id FROM billed_before)""",
    "insert_repeated_keys": """
        SELECT l_orderkey AS source_id, l_linenumber, cost, l_partkey
        FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cost FROM lineitem)
        WHERE l_orderkey NOT IN (SELECT source_id FROM billed_before)
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, cost, l_partkey) = 1""",
    "insert_stored_twice": "SELECT * FROM charges",
    "insert_bucketed": """
        SELECT source_id, cost FROM (
          SELECT o_orderkey AS source_id, CAST(floor(o_totalprice) AS BIGINT) AS cost FROM orders WHERE o_orderstatus = 'F'
          UNION ALL SELECT source_id, cost FROM charges
          WHERE source_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))""",
    "replace_by_key": _REPLACED,
    "replace_stored": _REPLACED,
    "mark_processed": _MARKED.format("hit AND NOT processed"),
    "mark_processed_unguarded": _MARKED.format("hit"),
    "tag_members": f"""
        SELECT id, group_no,
               CASE WHEN group_no IS NULL THEN '2024-01-01 00:00:00' ELSE '{STAMP}' END AS updated_at
        FROM persons LEFT JOIN (SELECT id, group_no FROM sent_members) USING (id)""",
    "reset_tables": """
        SELECT 'persons' AS table_name, count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM persons
        UNION ALL SELECT 'usage_record', count(*), 0 FROM usage_record
        UNION ALL SELECT 'harvest_source', count(*), 0 FROM harvest_source""",
    "seed_if_empty": "SELECT *, 'empty' AS target FROM usage_record",
    "dead_letter": f"""
        SELECT id AS source_id, payload AS raw_payload, 'PROCESS' AS failure_phase, outcome AS failure_type,
               CASE outcome WHEN 'SKIP' THEN 'PoisonItemException'
                    ELSE 'TransientProcessingException' END AS exception_class,
               CASE outcome WHEN 'SKIP' THEN 'Poison item detected for harvest_source.id=' || id
                    ELSE 'Transient failure for harvest_source.id=' || id || ' retryCount=2 threshold='
                         || transient_fail_until_attempt END AS exception_msg,
               CAST(CASE outcome WHEN 'SKIP' THEN 1 ELSE 4 END AS INTEGER) AS attempt_count,
               CAST({RUN_ID} AS BIGINT) AS job_execution_id, '{STAMP}' AS recorded_at
        FROM outcomes WHERE outcome IN ('SKIP', 'RETRY_EXHAUSTED')""",
    "write_expecting": "SELECT id AS ticket_id, ticket_code FROM tickets WHERE NOT processed",
    # projections
    "upper_names": "SELECT id, upper(first_name) AS first_name, upper(last_name) AS last_name FROM persons",
    "full_name": "SELECT id, first_name, last_name, first_name || ' ' || last_name AS full_name FROM persons",
    "snapshot": f"""
        SELECT id AS source_id, '{RUN_DATE}' AS snapshot_date, first_name, last_name, email, profession,
               CAST(value AS DOUBLE) AS salary, {_uuid(f"'{RUN_DATE}|' || id")} AS uuid_v4
        FROM persons""",
    "payload_item": "SELECT id, uuid_v4, first_name, last_name, email, profession FROM all_members",
    "rate_exact": "SELECT source_id, cost FROM charges",
    "rate_or_null": """
        SELECT id, CASE WHEN CAST(units AS HUGEINT) * rate <= 9223372036854775807
                        THEN CAST(CAST(units AS HUGEINT) * rate AS BIGINT) END AS cost
        FROM usage_bad""",
    "ticket_fields": f"""
        SELECT id, coalesce(seat, '{MISSING_FIELD}') AS seat,
               coalesce(event_location, '{MISSING_FIELD}') AS event_location,
               strftime(event_datetime, '%Y-%m-%d %H:%M') AS event_time
        FROM tickets""",
    "sign_token": f"""
        SELECT o_orderkey AS id, o_orderkey || '|T-' || o_orderkey || '.'
               || {_hmac("o_orderkey || '|T-' || o_orderkey")} AS token
        FROM orders""",
    "verify_token": "SELECT o_orderkey AS id, o_orderkey % 10 <> 3 AS valid FROM orders",
    "checksum": """
        SELECT doc_id, sha256(text) AS checksum_sha256, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes
        FROM documents""",
    "verify_checksum": """
        SELECT doc_id, CASE WHEN lang = 'en' AND sha256(upper(source)) <> sha256(text)
                            THEN 'Checksum mismatch: stored=' || sha256(upper(source)) || ' actual=' || sha256(text)
                       END AS load_error
        FROM documents""",
    "truncate_message": f"""
        SELECT doc_id, CAST(length(substr(text, 1, {MESSAGE_LENGTH})) AS INTEGER) AS kept_chars,
               md5(substr(text, 1, {MESSAGE_LENGTH})) AS kept_md5
        FROM documents""",
    "root_cause": """
        SELECT event_id,
               CASE WHEN event_id % 3 <> 0 THEN 'PoisonItemException'
                    WHEN event_id % 2 = 0 THEN 'TransientProcessingException'
                    ELSE 'RuntimeException' END AS exception_class,
               CASE WHEN event_id % 3 = 0 AND event_id % 2 = 0 THEN props ELSE event_type END AS exception_msg
        FROM events""",
    "to_payload_json": """
        SELECT id, CASE WHEN processed THEN '{}'
                        ELSE CAST(to_json({'first_name': first_name, 'last_name': last_name, 'email': email,
                                           'profession': profession}) AS VARCHAR) END AS payload
        FROM persons""",
    "parse_value_json": "SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(19,2)) AS DOUBLE) AS value FROM customer",
    "storage_key": """
        SELECT ticket_id, ticket_id || '.pdf' AS file_name, 'bundles/event-' || ticket_id % 50 || '.zip' AS bundle,
               ticket_id || '-' || ticket_id || '.pdf' AS entry
        FROM files""",
    "audit_normalise": """
        SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type ELSE '-' END AS job_name,
               CASE WHEN event_id % 4 = 0 THEN 'system' ELSE CAST(user_id AS VARCHAR) END AS user_id,
               CASE WHEN event_id % 3 = 0 OR trim(props) = '' THEN '-' ELSE props END AS details,
               CASE WHEN event_id % 2 = 0 THEN 'FAILURE' ELSE 'SUCCESS' END AS outcome
        FROM events""",
    # filters and validation
    "unprocessed": "SELECT id, event_id, processed FROM tickets WHERE NOT processed",
    "unprocessed_of_event": """
        SELECT id, event_id, processed FROM tickets WHERE NOT processed AND event_id = 7""",
    "in_ids": "SELECT * FROM usage_record WHERE id IN (SELECT l_orderkey FROM lineitem)",
    "worker_steps": """
        SELECT execution_id, 'usageWorkerStep:partition' || execution_id % 4 AS step_name, status
        FROM runs WHERE execution_id % 2 = 0 AND status = 'COMPLETED'""",
    "check_date": f"""
        SELECT event_id,
               CASE WHEN given {_BLANK.format('given')} THEN 'DATE parameter is required'
                    WHEN regexp_full_match(trim(given), '\\d{{4}}-\\d{{2}}-\\d{{2}}')
                         AND TRY_CAST(trim(given) AS DATE) IS NOT NULL THEN NULL
                    ELSE 'DATE must be a valid date in yyyy-MM-dd format, got: ' || given END AS reason
        FROM ({_DATES})""",
    "check_positive_long": f"""
        SELECT o_orderkey,
               CASE WHEN given {_BLANK.format('given')} THEN 'EVENT_ID is required'
                    WHEN number IS NULL THEN 'EVENT_ID must be a numeric value, got: ' || given
                    WHEN number <= 0 THEN 'EVENT_ID must be a positive long, got: ' || number
               END AS reason,
               CASE WHEN NOT (given {_BLANK.format('given')}) AND number IS NULL
                    THEN 'EVENT_ID must be a number: ' || given END AS optional_reason
        FROM (SELECT *, CASE WHEN regexp_full_match(trim(given), '[+-]?[0-9]+')
                             THEN TRY_CAST(trim(given) AS BIGINT) END AS number FROM ({_LONGS}))""",
    "check_min_bytes": """
        SELECT p_partkey,
               CASE WHEN regexp_full_match(secret, '\\s*') THEN 'TOKEN_SECRET is required and must not be blank'
                    WHEN octet_length(encode(secret)) < 32
                    THEN 'TOKEN_SECRET must be at least 32 bytes for HMAC-SHA256 strength' END AS reason
        FROM (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN '  '
                     ELSE p_name || ' ' || p_brand || ' ' || p_type || ' ' || p_partkey END AS secret FROM part)""",
    "check_fixed": f"""
        SELECT p_partkey,
               CASE WHEN p_size % 5 <> 0 AND p_size <> {GRID}
                    THEN 'GRID_SIZE is fixed at {GRID} and cannot be overridden, got: ' || p_size END AS reason
        FROM part""",
    "check_upload": _CHECKED,
    "check_uploads": f"""
        WITH judged AS (SELECT u.*, c.reason AS own FROM ({_UPLOADS}) u JOIN ({_CHECKED}) c USING (upload_id)),
             names AS (SELECT job_name, min(upload_id) AS first_id FROM judged WHERE own IS NULL GROUP BY job_name)
        SELECT upload_id,
               CASE WHEN own IS NOT NULL THEN own
                    WHEN job_name IN (SELECT job_name FROM judged WHERE upload_id % 10 = 3) OR upload_id > first_id
                    THEN 'A job definition with name ' || chr(39) || job_name || chr(39) || ' already exists' END AS reason
        FROM judged LEFT JOIN names USING (job_name)""",
    "check_constraints": """
        SELECT 'not_null(l_shipdate)' AS rule, count(*) AS violations FROM lineitem WHERE l_shipdate IS NULL
        UNION ALL SELECT 'max_length(l_returnflag)', count(*) FROM lineitem WHERE length(l_returnflag) > 1
        UNION ALL SELECT 'at_least(l_quantity)', count(*) FROM lineitem WHERE l_quantity < 2
        UNION ALL SELECT 'at_least(l_linenumber)', count(*) FROM lineitem WHERE l_linenumber < 1
        UNION ALL SELECT 'unique(l_orderkey)', count(*)
                  FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'foreign_key(l_partkey)', count(*) FROM lineitem
                  WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
        UNION ALL SELECT 'foreign_key(l_orderkey)', count(*) FROM lineitem
                  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""",
    "check_path_safe": f"""
        WITH keys AS ({_KEYS}),
             moves AS (SELECT page_id, key, unnest(string_split(key, '/')) AS part,
                              generate_subscripts(string_split(key, '/'), 1) AS i FROM keys),
             depth AS (SELECT page_id, sum(CASE part WHEN '..' THEN -1 WHEN '' THEN 0 WHEN '.' THEN 0 ELSE 1 END)
                                       OVER (PARTITION BY page_id ORDER BY i) AS d FROM moves),
             low AS (SELECT page_id, min(d) AS low FROM depth GROUP BY page_id)
        SELECT page_id, CASE WHEN starts_with(key, '/') OR low < 0
                             THEN 'Illegal storage key (path traversal): ' || key END AS reason
        FROM keys JOIN low USING (page_id)""",
    # joins
    "event_files": "SELECT f.*, event_id FROM files f JOIN tickets ON ticket_id = id",
    "group_members": f"""
        WITH placed AS (SELECT *, (row_number() OVER (PARTITION BY group_no ORDER BY id) - 1) // 10 AS page
                        FROM all_members),
             pages_ AS (SELECT group_no, page, CAST(to_json(list({_ITEM} ORDER BY id)) AS VARCHAR) AS items
                        FROM placed GROUP BY group_no, page),
             totals AS (SELECT group_no, count(*) AS n FROM all_members GROUP BY group_no)
        SELECT g.group_no, CAST(coalesce(page, 0) AS BIGINT) AS page, coalesce(n, 0) AS members_total,
               coalesce(items, '[]') AS items
        FROM acceptance g LEFT JOIN totals USING (group_no) LEFT JOIN pages_ USING (group_no)""",
    "anti_existing": "SELECT * FROM charges WHERE source_id NOT IN (SELECT source_id FROM billed_before)",
    "not_exists_any": """
        SELECT * FROM usage_record WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_mktsegment IS NULL)""",
    "enrich": "SELECT id, email, CAST(value AS DOUBLE) AS value FROM persons",
    "with_definition": """
        SELECT execution_id, job_name, definition_id, version FROM runs LEFT JOIN defined USING (job_name)""",
    # aggregates
    "count_and_total": """
        SELECT count(*) AS payment_rows, CAST(sum(amount) AS DOUBLE) AS payment_total FROM payments""",
    "reconcile": """
        SELECT CAST((SELECT count(*) FROM charges) AS BIGINT) AS charge_rows,
               CAST((SELECT count(DISTINCT source_id) FROM charges) AS BIGINT) AS charged_sources,
               CAST((SELECT count(*) FROM usage_record) AS BIGINT) AS usage_rows,
               CAST((SELECT sum(cost) FROM charges) AS BIGINT) AS charge_sum,
               CAST((SELECT sum(units * rate) FROM usage_record) AS BIGINT) AS usage_sum,
               CAST(0 AS BIGINT) AS double_billed, CAST(0 AS BIGINT) AS unrated_rows""",
    "bundle_entries": "SELECT event_id, ticket_id, entry, file_size_bytes, checksum_sha256 FROM entries",
    "ordered_entries": """
        SELECT event_id, row_number() OVER (PARTITION BY event_id ORDER BY ticket_id) - 1 AS entry_no, entry
        FROM entries""",
    "bundle_manifest": "SELECT * FROM manifest",
    "group_stats": "SELECT group_no, count(*) AS records_included FROM sent_members GROUP BY group_no",
    "status_health": """
        SELECT (SELECT count(*) FROM registry) AS loaded,
               (SELECT count(*) FROM definitions WHERE load_status = 'FAILED') AS failed,
               CASE WHEN (SELECT count(*) FROM definitions WHERE load_status = 'FAILED') > 0
                    THEN 'DOWN' ELSE 'UP' END AS status""",
    "id_bounds": "SELECT lo AS min_id, hi AS max_id FROM bounds",
    "step_counters": f"""
        WITH b AS (SELECT min(id) AS lo, max(id) AS hi FROM outcomes)
        SELECT 'harvestStep:partition' || least({GRID - 1}, (id - lo) // ((hi - lo) // {GRID})) AS step_name,
               count(*) AS read_count, CAST(0 AS BIGINT) AS filter_count,
               count(*) FILTER (outcome = 'OK') AS write_count, CAST(0 AS BIGINT) AS read_skip_count,
               count(*) FILTER (outcome <> 'OK') AS process_skip_count, CAST(0 AS BIGINT) AS write_skip_count,
               CAST(ceil(count(*) / 5.0) AS BIGINT) AS commit_count
        FROM outcomes, b GROUP BY ALL""",
    "running_by_job": """
        WITH jobs AS (SELECT DISTINCT event_type AS job_name FROM events
                      UNION ALL SELECT lower(n_name) FROM nation),
             placed AS (SELECT *, (row_number() OVER (PARTITION BY job_name ORDER BY execution_id) - 1) // 50 AS page
                        FROM runs WHERE status = 'STARTED'),
             maps AS (SELECT job_name, page, CAST(count(*) AS INTEGER) AS open_runs,
                             '{' || string_agg('"' || execution_id || '":"{\\"DATE\\":\\"' || date
                                 || '\\",\\"ATTEMPT_NUMBER\\":\\"' || attempt || '\\"}"', ','
                                 ORDER BY CAST(execution_id AS VARCHAR)) || '}' AS running
                      FROM placed GROUP BY job_name, page)
        SELECT job_name, CAST(coalesce(page, 0) AS BIGINT) AS page, coalesce(open_runs, 0) AS open_runs,
               coalesce(running, '{}') AS running
        FROM jobs LEFT JOIN maps USING (job_name)""",
    "tagged_counter": "SELECT job_name, count(*) AS executions FROM runs GROUP BY job_name",
    "partition_totals": f"""
        WITH g AS (SELECT k, lo + k * ((hi - lo) // {GRID}) AS a,
                          CASE WHEN k = {GRID - 1} THEN hi ELSE lo + (k + 1) * ((hi - lo) // {GRID}) - 1 END AS z
                   FROM bounds, range({GRID}) AS r(k))
        SELECT CAST(k AS INTEGER) AS range_no, a AS min_id, z AS max_id, count(*) AS charge_rows,
               CAST(sum(cost) AS BIGINT) AS total_cost
        FROM g JOIN charges ON source_id BETWEEN a AND z GROUP BY ALL""",
    # ordering
    "ordered_output": "SELECT id, ticket_code FROM tickets ORDER BY id",
    "page_of": "SELECT * FROM usage_record ORDER BY id LIMIT 512",
    "assign_chunk": "SELECT id, group_no AS chunk_no FROM all_members",
    "assign_chunk_per_range": """
        SELECT id, range_no, CAST(pos // 100 AS BIGINT) AS chunk_no FROM ranks""",
    "assign_id_range": """
        SELECT id, CAST(least(6, (id - lo) // ((hi - lo) // 7)) AS INTEGER) AS range_no
        FROM usage_record, bounds""",
    "id_ranges": """
        SELECT CAST(k AS INTEGER) AS range_no, 'partition' || k AS name, lo + k * ((hi - lo) // 7) AS min_id,
               CASE WHEN k = 6 THEN hi ELSE lo + (k + 1) * ((hi - lo) // 7) - 1 END AS max_id
        FROM bounds, range(7) AS r(k)""",
    "running_total": """
        SELECT source_id, subscriber_id, cost,
               CAST(sum(cost) OVER (PARTITION BY subscriber_id ORDER BY source_id) - cost AS BIGINT) AS billed_before,
               CAST(sum(cost) OVER (PARTITION BY subscriber_id) AS BIGINT) AS billed_total
        FROM charges""",
    "union_with_precedence": """
        SELECT job_name, version, author, 'CLASSPATH' AS source, 'ACTIVE' AS status FROM registry
        UNION ALL
        SELECT job_name, version, NULL, 'UPLOADED',
               CASE WHEN load_status = 'LOADED' THEN 'LOADED' ELSE 'ENABLED' END
        FROM definitions WHERE enabled AND job_name NOT IN (SELECT job_name FROM registry)""",
    # fault tolerance
    "classify": "SELECT id, fault FROM outcomes",
    "retry_outcome": """
        SELECT id, outcome,
               CAST(CASE WHEN fault = 'TRANSIENT' THEN least(transient_fail_until_attempt + 1, 3) ELSE 1 END
                    AS INTEGER) AS calls,
               CAST(CASE WHEN outcome = 'RETRY_EXHAUSTED' THEN 4
                         WHEN fault = 'TRANSIENT' THEN transient_fail_until_attempt + 1 ELSE 1 END
                    AS INTEGER) AS attempt_count
        FROM outcomes""",
    "skip_limit_cut": """
        SELECT max(id) FILTER (n = 6) AS cut
        FROM (SELECT id, row_number() OVER (ORDER BY id) AS n FROM outcomes
              WHERE outcome IN ('SKIP', 'RETRY_EXHAUSTED'))""",
    "commit_prefix": _committed(5)
    + " SELECT id, payload FROM cut_ranks, p WHERE outcome = 'OK' AND pos // 5 < bad_chunk",
    "commit_prefix_skip_limit": _committed(4)
    + " SELECT id, payload FROM cut_ranks, p WHERE outcome = 'OK' AND pos // 5 < bad_chunk",
    "resume": _committed(5)
    + " SELECT id, payload FROM cut_ranks, p WHERE pos // 5 >= bad_chunk",
    "isolate_partitions": """
        SELECT id AS source_id, subscriber_id, units, rate, CAST(CAST(units AS HUGEINT) * rate AS BIGINT) AS cost,
               range_no
        FROM ranks JOIN range_state USING (range_no) WHERE bad_chunk IS NULL OR pos // 100 < bad_chunk""",
    "range_outcomes": """
        SELECT range_no, read_rows, first_bad,
               (SELECT min(id) FROM ranks k WHERE k.range_no = s.range_no AND k.pos // 100 = s.bad_chunk) AS boundary,
               CASE WHEN first_bad IS NULL THEN 'COMPLETED' ELSE 'FAILED' END AS status
        FROM range_state s""",
    "restart_partitions": """
        SELECT u.*, range_no FROM usage_record u JOIN (SELECT id, range_no FROM ranked) USING (id)
        JOIN range_state USING (range_no) WHERE first_bad IS NOT NULL""".replace("ranked", "ranks"),
    "dispatch_groups": "SELECT * FROM stored_groups",
    "dispatch_tags": "SELECT id, group_no FROM sent_members WHERE group_no IS NOT NULL",
    "dispatch_payloads": f"""
        SELECT group_no, CAST(to_json({{'items_size': count(*), 'items': list({_ITEM} ORDER BY id)}}) AS VARCHAR)
               AS payload
        FROM all_members GROUP BY group_no""",
    "recover": _RECOVERED,
    # run ledger
    "run_identity": "SELECT execution_id, identity FROM runs",
    "overlay_params": """
        SELECT execution_id, 'ATTEMPT_NUMBER=' || attempt || ',DATE=' || date || ',GRID_SIZE=4' AS params
        FROM runs""",
    "launch_decision": """
        WITH asked AS (
               SELECT event_id AS request_id, event_type AS job_name,
                      CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '2024-13-01'
                           WHEN 5 THEN strftime(CAST(ts AS DATE) + 40, '%Y-%m-%d')
                           ELSE strftime(ts, '%Y-%m-%d') END AS date,
                      CASE WHEN event_id % 2 = 0 THEN CAST(user_id % 5 + 1 AS VARCHAR) ELSE '1' END AS attempt
               FROM events),
             named AS (SELECT *, md5(length(job_name) || ':' || job_name || '14:ATTEMPT_NUMBER1:' || attempt
                                     || CASE WHEN date IS NULL THEN ''
                                             ELSE '4:DATE' || length(date) || ':' || date END) AS identity
                       FROM asked),
             history AS (
               SELECT identity, max(execution_id) AS last_execution_id,
                      arg_max(state, execution_id) FILTER (state IN ('STARTED', 'COMPLETED')) AS state
               FROM (SELECT identity, execution_id,
                            CASE WHEN attempt = '1' AND job_name = 'error' THEN 'FAILED' ELSE status END AS state
                     FROM runs) GROUP BY identity),
             decided AS (
        SELECT request_id, job_name, identity,
               CASE WHEN job_name = 'view' THEN 'NOT_FOUND'
                    WHEN date IS NULL OR trim(date) = '' THEN 'MISSING_DATE'
                    WHEN TRY_CAST(date AS DATE) IS NULL THEN 'INVALID_DATE'
                    WHEN state = 'STARTED' THEN 'ALREADY_RUNNING'
                    WHEN state = 'COMPLETED' THEN 'ALREADY_COMPLETE'
                    WHEN last_execution_id IS NOT NULL THEN 'RESTART' ELSE 'NEW' END AS decision,
               last_execution_id
        FROM named LEFT JOIN history USING (identity))
        SELECT * REPLACE (CASE WHEN decision IN ('NEW', 'RESTART')
                                    AND row_number() OVER (PARTITION BY identity, decision ORDER BY request_id) > 1
                               THEN 'ALREADY_RUNNING' ELSE decision END AS decision)
        FROM decided""",
    "run_audit": f"""
        SELECT definition_id AS job_definition_id, execution_id AS job_execution_id, version AS job_version, ms AS duration_ms,
               outcome, '{{"startedAt":"' || {_iso('start_time')} || '"'
               || CASE WHEN end_time IS NULL THEN '' ELSE ',"finishedAt":"' || {_iso('end_time')} || '"' END
               || ',"durationMs":' || ms || ',"outcome":"' || outcome || '"}}' AS execution_metadata
        FROM (SELECT *, coalesce((epoch_us(end_time) - epoch_us(start_time)) // 1000, 0) AS ms,
                     CASE WHEN status = 'COMPLETED' THEN 'SUCCESS' ELSE 'FAILURE' END AS outcome FROM runs)
        JOIN defined USING (job_name)""",
    "restart_proof": """
        SELECT identity, count(*) AS executions, count(*) FILTER (status = 'FAILED') AS failed,
               count(*) FILTER (status = 'COMPLETED') AS completed,
               arg_min(status, execution_id) AS first_status, arg_max(status, execution_id) AS last_status,
               arg_min(status, execution_id) = 'FAILED' AND arg_max(status, execution_id) = 'COMPLETED'
               AS recovered
        FROM runs GROUP BY identity""",
    "restart_history": """
        SELECT identity, execution_id, status,
               row_number() OVER (PARTITION BY identity ORDER BY execution_id) - 1 AS turn
        FROM runs""",
    "run_ledger": f"""
        WITH failed_first AS (SELECT count(first_bad) > 0 AS f FROM range_state),
             done AS (SELECT job_execution_id AS execution_id, count(*) AS charges FROM ({_BILLED}) GROUP BY 1),
             listed AS (
               SELECT 1 AS execution_id, 'billing' AS job_name, '{RUN_DATE}' AS run_date, 0 AS turn,
                      CASE WHEN f THEN 'FAILED' ELSE 'COMPLETED' END AS status, f AS several FROM failed_first
               UNION ALL SELECT 2, 'billing', '{RUN_DATE}', 1, 'COMPLETED', f FROM failed_first WHERE f
               UNION ALL SELECT 2 + f::INT, 'payment_summary', '{RUN_DATE}', 0, 'COMPLETED', false FROM failed_first
               UNION ALL SELECT 3 + f::INT, 'payment_summary', '2024-01-01', 0, 'COMPLETED', false FROM failed_first)
        SELECT CAST(l.execution_id AS BIGINT) AS execution_id, job_name, run_date, turn, status,
               CASE status WHEN 'COMPLETED' THEN 'SUCCESS' ELSE 'FAILURE' END AS outcome,
               CAST(0 AS BIGINT) AS duration_ms, CAST(1 + several::INT AS BIGINT) AS executions,
               CAST(several::INT AS BIGINT) AS failed, CAST(1 AS BIGINT) AS completed, several AS recovered,
               'ALREADY_COMPLETE' AS next_decision, CASE WHEN job_name = 'billing' THEN charges END AS charges
        FROM listed l LEFT JOIN done d ON d.execution_id = l.execution_id""",
    # metrics
    "rate_per_minute": _rate(),
    "rate_per_minute_total": _rate(tag=False),
    "server_error_rate": _rate("WHERE regexp_matches(status_code, '^5..$')"),
    "client_error_rate": _rate("WHERE regexp_matches(status_code, '^4..$')"),
    "p95": _p95(_FIVE),
    "p95_sliding": """
        SELECT tag, strftime(date_trunc('minute', ts) - to_minutes(k), '%Y-%m-%d %H:%M:%S') AS window_start,
               count(*) AS n, true AS close
        FROM metric, range(5) AS r(k) WHERE duration IS NOT NULL GROUP BY ALL""",
    "p95_daily": _p95("date_trunc('day', ts)"),
    "mean_ratio": f"""
        SELECT tag, {_stamp(_FIVE)} AS window_start,
               round(CAST(sum(CAST(duration AS DECIMAL(18,6))) AS DOUBLE) / count(duration), 6) AS mean
        FROM metric GROUP BY ALL""",
    "percent_of": """
        SELECT profession, count(*) FILTER (processed) AS used, count(*) AS available,
               round(CAST(count(*) FILTER (processed) AS DOUBLE) / count(*) * 100, 6) AS percent
        FROM persons GROUP BY profession""",
    # jobs
    "job_person_etl": f"""
        SELECT email, upper(first_name) AS first_name, upper(last_name) AS last_name, profession,
               '{RUN_DATE}' AS snapshot_date, CAST(value AS DOUBLE) AS salary, group_no % 4 <> 0 AS sent,
               CASE WHEN group_no % 4 <> 0 THEN group_no END AS group_no
        FROM taken_persons""",
    "job_person_etl_groups": """
        SELECT group_no, CASE WHEN group_no % 4 = 0 THEN 'ERROR' ELSE 'SENT' END AS dispatch_status,
               CASE WHEN group_no % 4 = 0 THEN 0 ELSE n END AS records_included,
               CASE WHEN group_no % 4 = 0 THEN 0 ELSE n END AS tagged
        FROM (SELECT group_no, count(*) AS n FROM taken_persons GROUP BY group_no)""",
    "job_person_etl_letters": f"""
        SELECT CAST(NULL AS BIGINT) AS source_id, line AS raw_payload, 'READ' AS failure_phase, 'SKIP' AS failure_type,
               'MalformedLineException' AS exception_class,
               'Line has ' || n_fields || ' fields, 4 expected' AS exception_msg, 1 AS attempt_count,
               CAST({RUN_ID} AS BIGINT) AS job_execution_id
        FROM person_lines WHERE n_fields <> 4
        UNION ALL
        SELECT number, CAST(to_json({{'first_name': upper(first_name), 'last_name': last_name, 'email': email,
                                      'profession': profession}}) AS VARCHAR),
               'WRITE', 'SKIP', 'ConstraintViolationException', 'Row breaks not_null(last_name)', 1, {RUN_ID}
        FROM (SELECT *, row_number() OVER (ORDER BY id) AS number FROM person_lines WHERE n_fields = 4)
        WHERE last_name IS NULL""",
    "job_dispatch_recovery": f"""
        SELECT group_no, dispatch_status, records_included, 'FAILED' AS run_status
        FROM ({_RECOVERED}) WHERE group_no % 4 = 0 AND NOT failed""",
    "job_recovery_payloads": f"""
        SELECT group_no, page,
               CAST(to_json({{'items_size': count(*), 'items': list({_ITEM} ORDER BY id)}}) AS VARCHAR) AS payload
        FROM (SELECT *, CAST((row_number() OVER (PARTITION BY group_no ORDER BY id) - 1) // 20 AS BIGINT) AS page
              FROM all_members WHERE group_no % 4 = 0)
        GROUP BY group_no, page""",
    "job_ticket_signing": f"""
        SELECT ticket_id, event_id, sha256(document) AS checksum_sha256,
               CAST(octet_length(encode(document)) AS BIGINT) AS file_size_bytes,
               CAST({RUN_ID} AS BIGINT) AS run_id
        FROM ({_TICKET_DOC})""",
    "job_event_bundles": "SELECT * FROM manifest",
    "job_event_bundles_files": """
        SELECT *, 'missing file: /data/tickets/' || (SELECT max(id) FROM tickets WHERE processed) || '.pdf' AS refused,
               false AS stored_before
        FROM manifest""",
    "job_harvest": _HARVEST
    + """
        SELECT o.id,
               CAST(CASE WHEN o.id IN (SELECT id FROM first) THEN CASE WHEN o.outcome = 'OK' THEN 1 END
                         WHEN s.pos // 5 < cut2.bad_chunk THEN CASE WHEN NOT s.skip THEN 2 END
                         ELSE 3 END AS BIGINT) AS processed_by,
               letters, last_letter_run
        FROM outcomes o LEFT JOIN second s USING (id) LEFT JOIN per_id USING (id), cut2""",
    "job_harvest_steps": _HARVEST
    + """,
             ends AS (
               SELECT 1 AS run_id, (SELECT cut_id FROM cut) < 9000000000000000000 AS failed,
                      CASE WHEN (SELECT cut_id FROM cut) = (SELECT min(id) FROM outcomes WHERE outcome = 'ABORT')
                           THEN 'ABORT' ELSE 'SKIP_LIMIT' END AS why
               UNION ALL SELECT 2, (SELECT cut_id FROM cut2) < 9000000000000000000, 'SKIP_LIMIT'
               UNION ALL SELECT 3, false, ''),
             committed AS (
               SELECT 1 AS run_id, outcome FROM cut_ranks, p WHERE pos // 5 < bad_chunk
               UNION ALL SELECT 2, CASE WHEN skip THEN 'SKIP' ELSE 'OK' END FROM second, cut2 WHERE pos // 5 < cut2.bad_chunk
               UNION ALL SELECT 3, 'OK' FROM second, cut2 WHERE pos // 5 >= cut2.bad_chunk)
        SELECT CAST(run_id AS BIGINT) AS run_id, 'harvestStep' AS step_name,
               CASE WHEN failed THEN 'FAILED' ELSE 'COMPLETED' END AS status, CASE WHEN failed THEN why END AS reason,
               count(outcome) AS read_count, CAST(0 AS BIGINT) AS filter_count,
               count(*) FILTER (outcome = 'OK') AS write_count, CAST(0 AS BIGINT) AS read_skip_count,
               count(*) FILTER (outcome IN ('SKIP', 'RETRY_EXHAUSTED')) AS process_skip_count,
               CAST(0 AS BIGINT) AS write_skip_count, CAST(ceil(count(outcome) / 5) AS BIGINT) AS commit_count,
               CAST(CASE WHEN failed THEN 1 ELSE 0 END AS BIGINT) AS rollback_count
        FROM ends LEFT JOIN committed USING (run_id) GROUP BY run_id, failed, why""",
    "job_billing": _BILLED,
    "job_billing_ranges": f"""
        WITH g AS (SELECT CAST(k AS INTEGER) AS range_no, lo + k * ((hi - lo) // {GRID}) AS min_id,
                          CASE WHEN k = {GRID - 1} THEN hi ELSE lo + (k + 1) * ((hi - lo) // {GRID}) - 1 END AS max_id
                   FROM bounds, range({GRID}) AS r(k))
        SELECT CAST(1 AS BIGINT) AS run_id, range_no, min_id, max_id,
               CASE WHEN first_bad IS NULL THEN 'COMPLETED' ELSE 'FAILED' END AS status
        FROM g JOIN range_state USING (range_no)
        UNION ALL
        SELECT 2, range_no, min_id, max_id, 'COMPLETED' FROM g JOIN range_state USING (range_no)
        WHERE first_bad IS NOT NULL""",
    "job_payment_summary": """
        SELECT count(*) AS payment_rows, CAST(sum(amount) AS DOUBLE) AS payment_total FROM payments""",
    # streaming
    "run_incremental": "SELECT source_id, cost FROM charges",
    "stream_rate": _rate(),
}


def oracle_sql() -> dict[str, str]:
    return {name: sql(body) for name, body in BODIES.items()}
