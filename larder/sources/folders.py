"""Folders of stored tables, in whatever file system they lie: listing and removing them."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below a path, in order; none if the path is missing."""
    target, system = _located(spark, path)
    if not system.exists(target):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(target) if found.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; no error if there is none."""
    target, system = _located(spark, path)
    system.delete(target, True)


def file_scans(table: DataFrame, files: int) -> DataFrame:
    """A stored Parquet table as a union of scans of ``files`` files each, in the order of the files' paths.

    Spark sizes the tasks of a scan by its bytes, which say little about the rows of well compressed files.
    """
    paths = sorted(unquote(path) for path in table.inputFiles())
    if len(paths) <= files:
        return table
    reader = table.sparkSession.read.schema(table.schema)
    scans = [reader.parquet(*paths[i : i + files]) for i in range(0, len(paths), files)]
    while len(scans) > 1:
        scans = [a.union(b) for a, b in zip(scans[::2], scans[1::2])] + scans[len(scans) - len(scans) % 2 :]
    return scans[0]
