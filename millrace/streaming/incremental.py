"""Incremental runs: checkpointed input position plus an idempotent sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sinks import insert_if_absent_into, replace_in


def read_increments(
    spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """Files that arrive at ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_incremental(
    source: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    key: str,
    schema: str,
    checkpoint: str,
    order: list[str] | None = None,
) -> None:
    """Process what is new and stop.

    Spark remembers the files done in ``checkpoint``; a batch that is delivered again after a
    failure, or all of them after the checkpoint is lost, adds nothing because rows present in the
    target are left out.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        insert_if_absent_into(transform(batch), target, key, schema, order, clustered=True)

    query = (
        source.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_rate(events: DataFrame, minutes: int = 5, slide: int = 1, tag: str = "tag", delay: str = "10 minutes") -> DataFrame:
    """Events per minute over sliding windows of a stream; late rows up to ``delay`` count."""
    return (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{minutes} minutes", f"{slide} minutes"), tag)
        .agg(F.count("*").alias("events"))
        .select(
            tag,
            F.col("window.start").alias("window_start"),
            "events",
            (F.col("events") / F.lit(minutes)).alias("per_minute"),
        )
    )


def run_to_files(rates: DataFrame, target: str, checkpoint: str) -> None:
    """Append the closed windows of a streaming aggregate to files and stop; windows still open stay in its state."""
    query = (
        rates.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_to_versions(aggregate: DataFrame, target: str, key: list[str], schema: str, checkpoint: str) -> None:
    """Keep a streaming aggregate up to date in a table of versions and stop.

    Every batch replaces the groups it changed with their totals so far, the last windows too, which no watermark has
    closed yet. A batch that is delivered again replaces rows by equal ones. Read the table by ``sinks.read_versions``;
    the bounds of the windows in its manifest keep readers of some hours away from the rest.
    """

    def store(batch: DataFrame, _batch_id: int) -> None:
        replace_in(batch, target, key, schema)

    query = (
        aggregate.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
