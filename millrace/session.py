"""Session helpers: settings, the shared folder, and cutting lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        folder = tempfile.mkdtemp(prefix="millrace-")
        context.setCheckpointDir(folder)
    return folder


def scratch(spark: SparkSession, name: str) -> str:
    """A new, empty path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/millrace-{uuid.uuid4().hex}/{name}"


def local_path(spark: SparkSession, path: str) -> str | None:
    """``path`` as the operating system names it, if it lies on local or mounted storage."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def stable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from the written rows.

    The result survives the loss of any executor and never changes between passes.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared folder and read it back, with the path for ``dropped``."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch`` has named; anything else stays."""
    parent = path.rstrip("/").rsplit("/", 1)[0]
    if not parent.startswith(f"{shared_folder(spark).rstrip('/')}/millrace-"):
        raise ValueError(f"{path} is no scratch folder of this session")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
