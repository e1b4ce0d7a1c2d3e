"""Payment summary: rows and total of delimited payment files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.aggregates import count_and_total
from millrace.sources.files import scan_lenient_lines, scan_lines


def payment_summary(spark: SparkSession, path: str) -> DataFrame:
    return count_and_total(scan_lenient_lines(scan_lines(spark, path)))
