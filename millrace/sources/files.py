"""Delimited files, raw lines and whole files."""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import strip_edges
from millrace.session import local_path


def scan_delimited(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> DataFrame:
    """Headerless delimited text, columns by position; a malformed line fails the read."""
    schema = ", ".join(f"`{name}` STRING" for name in names)
    return (
        spark.read.schema(schema)
        .option("header", False)
        .option("sep", sep)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def scan_permissive(spark: SparkSession, path: str, names: list[str], sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """Headerless delimited text as ``(rows, broken)``: a line with another number of fields breaks nothing but itself.

    ``rows`` has the columns by position; ``broken`` has the whole line as ``line`` and its number of fields as
    ``n_fields``. Blank lines are left out.
    """
    schema = ", ".join(f"`{name}` STRING" for name in names) + ", `_broken` STRING"
    options = {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select("value", F.from_csv("value", schema, options).alias("_row"))
    rows = parsed.filter(F.col("_row._broken").isNull()).select(*[F.col("_row").getField(name).alias(name) for name in names])
    plain = F.split("value", "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E")
    broken = parsed.filter(F.col("_row._broken").isNotNull()).select(
        F.col("value").alias("line"), F.size(plain).alias("n_fields")
    )
    return rows, broken


#: Files whose first lines' numbers (8 bytes each) go to all tasks.
SENT_FIRST_LINES = 1 << 20


def scan_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line after the first one of each file, blank ones included, as ``value``.

    The first line is the one read first from the block at the file's start, whatever it says; lines that look
    like it stay. Numbers by task and row tell the lines apart; both reads of a file see the same blocks. The numbers
    of the first lines are one per file, of which the driver knows how many there are, so they are broadcast and no line
    is shuffled.
    """
    text = spark.read.text(path)
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    first = lines.filter("_start = 0").groupBy("_file").agg(F.min("_at").alias("_at")).select("_at")
    if len(text.inputFiles()) <= SENT_FIRST_LINES:
        first = F.broadcast(first)
    return lines.select("value", "_at").join(first, "_at", "left_anti").select("value")


def fields(line: Column, sep: str = ",") -> Column:
    """Fields of a line without trailing empty ones; an empty line has one empty field."""
    plain = "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"
    kept = F.regexp_replace(line, f"(?:{plain})+$", "")
    none = (kept == "") & (line != "")
    return F.when(none, F.array().cast("array<string>")).otherwise(F.split(kept, plain))


def scan_lenient_lines(
    lines: DataFrame, min_fields: int = 3, value_index: int = 2, scale: int = 18
) -> DataFrame:
    """``(line_value, n_fields, amount)`` per line.

    A line with fewer than ``min_fields`` fields has a NULL amount and still counts as a row;
    an amount that is present but no number, or that has digits behind ``scale`` decimals, fails the query.
    """
    type_ = f"decimal(38,{scale})"
    parts = lines.select(fields(F.col("value")).alias("f"), F.col("value").alias("line_value"))
    text = strip_edges(F.get("f", value_index))
    number = text.try_cast(type_)
    decimals = F.length(F.regexp_extract(text, r"\.(\d*?)0*$", 1))
    shifted = text.rlike("[eE]") & (number.cast("double") != text.try_cast("double"))
    exact = F.when((decimals > scale) | shifted, F.raise_error(F.concat(F.lit("too many decimals: "), text)).cast(type_))
    amount = F.when(F.size("f") < min_fields, F.lit(None).cast(type_)).otherwise(
        F.coalesce(exact, number, F.raise_error(F.concat(F.lit("not a number: "), text)).cast(type_))
    )
    return parts.select("line_value", F.size("f").alias("n_fields"), amount.alias("amount"))


#: Files per batch that a listing or reading task hands on.
FILES_PER_BATCH = 10_000
#: A path with one of these is a pattern to Spark's readers.
PATTERN = set("{}[]*?\\")


def _listing(base: str) -> tuple[Callable, Callable]:
    """Two functions for tasks: what lies in ``base`` as (path, whether a folder), and all files in and below such paths.

    Names count as for Spark's readers: hidden ones are left out, but not folders named as Spark's metadata, and those that
    are no UTF-8.
    """

    def hidden(name: str) -> bool:
        return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")

    def encoded(name: str) -> bool:
        try:
            return bool(name.encode())
        except UnicodeEncodeError:
            return False

    def inside(folder: str, whole: bool) -> Iterator[tuple[str, bool]]:
        try:
            entries = os.scandir(folder)
        except FileNotFoundError:
            if folder == base:
                raise
            return  # removed since its own folder was listed
        with entries:
            for entry in entries:
                if not encoded(entry.name):
                    continue
                if os.path.isdir(entry.path):
                    if hidden(entry.name) and not entry.name.startswith(("_metadata", "_common_metadata")):
                        continue
                    if whole:
                        yield from inside(entry.path, True)
                    else:
                        yield entry.path, True
                elif not hidden(entry.name) and os.path.isfile(entry.path):
                    yield entry.path, False

    def top(path: str) -> Iterable[tuple[str, bool]]:
        if os.path.isfile(path):
            return [] if hidden(os.path.basename(path)) else [(path, False)]
        return inside(path, False)

    def below(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        paths = (found for path, folder in rows for found, _ in (inside(path, True) if folder else [(path, False)]))
        while some := list(islice(paths, FILES_PER_BATCH)):
            yield pa.RecordBatch.from_pydict({"path": pa.array(some, pa.string())})

    return top, below


def _reading() -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's function from paths to path, size and SHA-256 of the files that are not empty.

    A checksum file that Hadoop's local writer has left beside a file must agree with it, as for Spark's readers.
    """

    def sums_of(path: str) -> tuple:
        """The open checksum file behind its header and the bytes per checksum; ``(None, 0)`` if there is none."""
        folder, name = os.path.split(path)
        try:
            sums = open(f"{folder}/.{name}.crc", "rb")
            head = sums.read(8)
        except OSError:
            return None, 0
        if head[:4] == b"crc\0" and len(head) == 8:
            return sums, int.from_bytes(head[4:], "big")
        sums.close()
        return None, 0

    def digest(path: str) -> tuple[str, int, str]:
        (sums, step), all_, size = sums_of(path), hashlib.sha256(), 0
        with open(path, "rb") as file:
            while part := file.read(step * max(1, (1 << 20) // step) if sums else 1 << 20):
                all_.update(part)
                size += len(part)
                for i in range(0, len(part) if sums else 0, step or 1):
                    if zlib.crc32(part[i : i + step]).to_bytes(4, "big") != sums.read(4):
                        raise OSError(f"checksum error: {path}")
        if sums:
            sums.close()
        return f"file:{path}", size, all_.hexdigest()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (digest(path) for batch in batches for path in batch.column(0).to_pylist())
        while some := list(islice(rows, FILES_PER_BATCH)):
            paths, sizes, digests = zip(*some)
            read = {"path": pa.array(paths, pa.string()), "size_bytes": pa.array(sizes, pa.int64())}
            full = pa.RecordBatch.from_pydict(read | {"checksum_sha256": pa.array(digests, pa.string())})
            yield full.filter(pa.array([size > 0 for size in sizes]))

    return run


def scan_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, size and SHA-256 of every file that is not empty; the bytes stay in the scanning task.

    On local and mounted storage tasks also list the files, when the query runs, so the driver holds no list of them.
    Spark's reader, which keeps the status of every file there, is left for other storage and for a path with a pattern.
    """
    base = local_path(spark, path)
    if base is None or PATTERN & set(path) or not os.path.exists(base):
        return (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True)
            .load(path)
            .select(
                "path",
                F.octet_length("content").cast("bigint").alias("size_bytes"),
                F.sha2("content", 256).alias("checksum_sha256"),
            )
        )
    context, (top, below) = spark.sparkContext, _listing(base)
    tasks = 2 * context.defaultParallelism
    # Dealt out as an RDD: from a shuffle of a plan Spark would take the size of these few rows for that of all files, and
    # broadcast them in joins. So it has no size until all paths are shuffled.
    first = context.parallelize([base], 1).flatMap(top).keyBy(lambda entry: entry[0]).partitionBy(tasks).values()
    listed = spark.createDataFrame(first, "path STRING, folder BOOLEAN").mapInArrow(below, "path STRING")
    named = context._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    wanted = listed.filter(F.substring_index("path", "/", -1).rlike(f"(?s)\\A(?:{named})\\z"))
    tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return wanted.repartition(tasks, "path").mapInArrow(_reading(), "path STRING, size_bytes BIGINT, checksum_sha256 STRING")


def missing_files(expected: DataFrame, found: DataFrame, path: str = "path") -> DataFrame:
    """Expected paths that no file answers to."""
    return expected.select(path).distinct().join(found.select(path), path, "left_anti")


def require_files(expected: DataFrame, found: DataFrame, path: str = "path") -> DataFrame:
    """``expected`` joined to its files; a missing file fails the query."""
    joined = expected.join(found.withColumn("_found", F.lit(True)), path, "left")
    there = F.coalesce(
        F.col("_found"), F.raise_error(F.concat(F.lit("missing file: "), F.col(path))).cast("boolean")
    )
    return joined.filter(there).drop("_found")
