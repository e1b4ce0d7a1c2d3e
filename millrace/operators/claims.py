"""Names that only one of several writers can take."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    """The file system of a path, and the path in full."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store, store.makeQualified(target)


def claim(spark: SparkSession, path: str) -> bool:
    """Create the file ``path``; False if it exists. Of any number of callers exactly one gets True.

    The store must be able to create a file exclusively, as HDFS and the object stores with conditional writes are; on
    local paths the operating system does it.
    """
    store, target = _path(spark, path)
    store.mkdirs(target.getParent())
    context = spark.sparkContext
    try:
        if target.toUri().getScheme() == "file":
            files = context._jvm.java.nio.file
            none = context._gateway.new_array(files.attribute.FileAttribute, 0)
            files.Files.createFile(files.Paths.get(target.toUri()), none)
        else:
            store.create(target, False).close()
    except Py4JJavaError as problem:
        if problem.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def claimed(spark: SparkSession, path: str) -> bool:
    store, target = _path(spark, path)
    return store.exists(target)


def next_number(spark: SparkSession, folder: str, first: int) -> int:
    """The smallest number from ``first`` on that nobody has claimed in ``folder``; it is claimed now."""
    number = first
    while not claim(spark, f"{folder}/{number}"):
        number += 1
    return number
