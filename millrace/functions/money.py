"""Exact integer money: every product is checked, whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate_or_null(units: Column, rate: Column) -> Column:
    """``units * rate`` in minor units, NULL where the product leaves 64 bits."""
    return F.try_multiply(units.cast("bigint"), rate.cast("bigint"))


def overflows(units: Column, rate: Column) -> Column:
    return units.isNotNull() & rate.isNotNull() & rate_or_null(units, rate).isNull()


def rate_exact(units: Column, rate: Column) -> Column:
    """``units * rate`` in minor units; a product beyond 64 bits fails the query."""
    message = F.concat(
        F.lit("long overflow: "), units.cast("string"), F.lit(" * "), rate.cast("string")
    )
    return F.when(overflows(units, rate), F.raise_error(message).cast("bigint")).otherwise(
        rate_or_null(units, rate)
    )
