"""Written intermediate tables in the folder the cluster shares between nodes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from larder.sources.folders import remove

_local_folders: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or the folder given to ``setCheckpointDir``.

    A local session without the setting gets a temporary folder; on a cluster
    such a folder would be private to one machine, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if given := context.getCheckpointDir():
        return given.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="larder-")
    return _local_folders[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def materialize(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """Write the frame once and go on from the written table.

    Used where several passes follow an expensive shuffle. The columns stay
    prunable and a lost executor costs a re-read, not the shuffle.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in the block delete their shuffle files as they end, not when the driver next collects garbage."""
    name = "spark.sql.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def stored(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """The frame from a scratch table that is gone after the block; nothing lazy may outlive it."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    try:
        frame.write.parquet(path)
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        remove(spark, path)


def release(*frames: DataFrame) -> None:
    """Delete the scratch tables that ``materialize`` returned these frames for; nothing lazy may still need them."""
    for frame in frames:
        for folder in {path.rpartition("/")[0] for path in frame.inputFiles()}:
            remove(frame.sparkSession, folder)
