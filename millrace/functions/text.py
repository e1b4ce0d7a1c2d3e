"""Text, JSON and naming projections."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The missing-field mark and the display format of a printed ticket.
MISSING_FIELD = "—"
TICKET_TIME_FORMAT = "yyyy-MM-dd HH:mm"

# Fixed value: characters kept of a stored failure message.
MESSAGE_LENGTH = 2048

# White space as a JVM string's isBlank() sees it (control characters and Unicode
# separators without the no-break ones), and what its trim() removes (all up to U+0020).
BLANKS = "".join(
    chr(code)
    for code in [
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x1680,
        *range(0x2000, 0x2007),
        *range(0x2008, 0x200B),
        0x2028,
        0x2029,
        0x205F,
        0x3000,
    ]
)
EDGES = "".join(chr(code) for code in range(0x21))


def is_blank(col: Column) -> Column:
    """True for NULL, empty or white-space-only text."""
    return col.isNull() | (F.btrim(col, F.lit(BLANKS)) == "")


def strip_edges(col: Column) -> Column:
    """Drop control characters and spaces at both ends."""
    return F.btrim(col, F.lit(EDGES))


def none_if_blank(col: Column) -> Column:
    return F.when(~is_blank(col), col)


def upper_names(df: DataFrame, first: str = "first_name", last: str = "last_name") -> DataFrame:
    """Upper-case both names; a missing name stays missing."""
    return df.withColumns({first: F.upper(first), last: F.upper(last)})


def full_name(df: DataFrame, first: str = "first_name", last: str = "last_name") -> DataFrame:
    """Add ``full_name`` beside the originals."""
    return df.withColumn("full_name", F.concat(F.col(first), F.lit(" "), F.col(last)))


def key_uuid(*keys: Column) -> Column:
    """A UUID-shaped (version 4) text derived from the keys, so that a re-run yields the same one."""
    h = F.sha2(F.concat_ws("|", *keys), 256)
    return F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("4"), F.substring(h, 14, 3)),
        F.concat(F.lit("a"), F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )


def snapshot(df: DataFrame, date: str, value: str = "value", key: str = "id") -> DataFrame:
    """Person rows with their looked-up value as dated snapshot rows.

    The UUID comes from date and key: a repeated run produces the very same row, which lets
    the sink recognise it.
    """
    day = F.lit(date).cast("date")
    return df.select(
        F.col(key).alias("source_id"),
        day.alias("snapshot_date"),
        "first_name",
        "last_name",
        "email",
        "profession",
        F.col(value).cast("decimal(19,2)").alias("salary"),
        key_uuid(day.cast("string"), F.col(key).cast("string")).alias("uuid_v4"),
    )


def payload_item() -> Column:
    """The five fields of a person that leave the system, in snake case."""
    return F.struct("uuid_v4", "first_name", "last_name", "email", "profession")


def payload_items(df: DataFrame, key: str = "id") -> DataFrame:
    """The key beside the payload item."""
    return df.select(key, payload_item().alias("item"))


def to_payload_json(payload: Column) -> Column:
    """JSON text of a struct with its NULL fields written out; a NULL struct gives ``{}``."""
    text = F.to_json(payload, {"ignoreNullFields": "false"})
    return F.when(payload.isNull(), F.lit("{}")).otherwise(text)


def parse_value_json(col: Column) -> Column:
    """The decimal in ``{"value": 1.99}``."""
    return F.from_json(col, "value DECIMAL(19,2)").getField("value")


def ticket_fields(df: DataFrame) -> DataFrame:
    """Display fields of a ticket: missing seat or location become a dash, time to the minute."""
    return df.withColumns(
        {
            "seat": F.coalesce("seat", F.lit(MISSING_FIELD)),
            "event_location": F.coalesce("event_location", F.lit(MISSING_FIELD)),
            "event_time": F.date_format("event_datetime", TICKET_TIME_FORMAT),
        }
    )


def fill(template: str, values: dict[str, Column]) -> Column:
    """The template with its ``{name}`` fields replaced by columns."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)


def truncate_message(col: Column, length: int = MESSAGE_LENGTH) -> Column:
    """At most ``length`` characters; NULL stays NULL."""
    return F.substring(col, 1, length)


def root_cause(
    outer_class: Column,
    outer_message: Column,
    inner_class: Column,
    inner_message: Column,
    known: list[str],
) -> Column:
    """Struct ``(exception_class, exception_msg)``: one wrapping layer is removed unless the outer
    class is a known one or nothing is wrapped."""
    keep = outer_class.isin(known) | inner_class.isNull()
    return F.struct(
        F.when(keep, outer_class).otherwise(inner_class).alias("exception_class"),
        F.when(keep, outer_message).otherwise(inner_message).alias("exception_msg"),
    )


def ticket_file_name(ticket_id: Column) -> Column:
    return F.concat(ticket_id.cast("string"), F.lit(".pdf"))


def bundle_key(event_id: Column) -> Column:
    return F.concat(F.lit("bundles/event-"), event_id.cast("string"), F.lit(".zip"))


def entry_name(ticket_id: Column, path: Column) -> Column:
    """Archive entry of a file: the id in front keeps equal file names apart."""
    base = F.regexp_extract(path, "[^/]+$", 0)
    return F.concat(ticket_id.cast("string"), F.lit("-"), base)


def audit_normalise(df: DataFrame) -> DataFrame:
    """Audit rows with defaults for blank job, user, details and outcome."""
    defaults = {"job_name": "-", "user_id": "system", "details": "-", "outcome": "SUCCESS"}
    return df.withColumns(
        {name: F.coalesce(none_if_blank(F.col(name)), F.lit(text)) for name, text in defaults.items()}
    )


def iso_local_time(col: Column) -> Column:
    """ISO local date-time text with seconds and fraction only as far as they are not zero."""
    micros = F.date_format(col, "SSSSSS")
    return F.concat(
        F.date_format(col, "yyyy-MM-dd'T'HH:mm"),
        F.when((F.second(col) == 0) & (micros == "000000"), F.lit("")).otherwise(
            F.date_format(col, ":ss")
        ),
        F.when(micros == "000000", F.lit(""))
        .when(micros.endswith("000"), F.date_format(col, ".SSS"))
        .otherwise(F.concat(F.lit("."), micros)),
    )
