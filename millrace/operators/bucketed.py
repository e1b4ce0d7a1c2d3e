"""Stored tables bucketed by key: new rows go to where their keys are, so that what is stored never moves.

A plain folder makes every run shuffle its whole history to find out which keys are there. Here the history lies in as
many files as there are buckets; only the new rows are shuffled, once, into the same buckets, and each task meets one
bucket and writes one file. The number of buckets is stored beside the table when it is made and holds for good; make
it with as many as a session will have shuffle partitions, since Spark deals both sides anew for more.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sinks import first_per_key, read_table

#: Buckets of a new table unless the session's number of shuffle partitions is larger.
BUCKETS = 16


@dataclass(frozen=True)
class Bucketed:
    """A registered table over ``path``; ``name`` is its name in the session."""

    spark: SparkSession
    name: str
    path: str
    key: str
    buckets: int

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def placed(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """The rows in the tasks of their buckets."""
        return df.repartition(self.buckets, key or self.key)

    def absent(self, df: DataFrame, key: str | None = None, unique_keys: bool = False, in_place: bool = False) -> DataFrame:
        """The rows of new keys, one a key, in the tasks of their buckets; ``key`` is their name for it.

        Repeated keys shrink to a row per task before the shuffle; the stored side has no exchange, and with rows that
        are ``in_place`` already there is none at all.
        """
        key = key or self.key
        rows = df if unique_keys else first_per_key(df, key)
        rows = rows if in_place else self.placed(rows, key)
        return rows.join(self._keys(key), key, "left_anti").select(*df.columns)

    def _keys(self, name: str) -> DataFrame:
        return self.read().select(F.col(self.key).alias(name)).hint("merge")

    def append(self, placed: DataFrame) -> None:
        """Store rows that ``absent`` or ``placed`` gave: one file for every bucket that gets any."""
        columns = self.read().columns
        placed.select(*columns).write.mode("append").format("parquet").bucketBy(self.buckets, self.key).saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def insert_if_absent(self, df: DataFrame, unique_keys: bool = False) -> None:
        """Append what is absent; running it again adds nothing twice."""
        self.append(self.absent(df, unique_keys=unique_keys))


def bucketed(spark: SparkSession, path: str, key: str, schema: str, buckets: int | None = None) -> Bucketed:
    """The table at ``path``, made if it is not there; then ``buckets`` or the session's shuffle partitions count."""
    layout = read_table(spark, f"{path}_layout", "key STRING, buckets INT")
    stored = layout.first()
    if stored is None:
        n = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
        row = spark.createDataFrame([(key, n)], "key STRING, buckets INT")
        row.coalesce(1).write.mode("append").parquet(f"{path}_layout")
        stored = row.first()
    if stored["key"] != key:
        raise ValueError(f"{path} is bucketed by {stored['key']}")
    name = f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromDDL(schema))
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
        f" CLUSTERED BY (`{key}`) INTO {stored['buckets']} BUCKETS LOCATION '{location}'"
    )
    return Bucketed(spark, name, path, key, stored["buckets"])

