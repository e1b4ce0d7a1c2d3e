"""Run parameters: checks and identity, evaluated by the same columns the operators use."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ledger import run_identity


def text(value: str | None) -> Column:
    return F.lit(value).cast("string")


def require(spark: SparkSession, *reasons: Column) -> None:
    """Raise the first reason that is not NULL."""
    reason = spark.range(1).select(F.coalesce(*reasons, F.lit(None).cast("string"))).first()[0]
    if reason is not None:
        raise ValueError(reason)


def as_map(params: dict[str, str]) -> Column:
    pairs = [F.lit(part) for pair in params.items() for part in pair]
    return F.create_map(*pairs).cast("map<string,string>")


def identity_of(spark: SparkSession, job_name: str, params: dict[str, str]) -> str:
    return spark.range(1).select(run_identity(F.lit(job_name), as_map(params))).first()[0]
