"""Versioned product snapshots, paging and result publication.

Folders under the root:

``prepared/version=<v>``  one snapshot, in files of disjoint, ascending key ranges
``ranges/version=<v>``    one row per snapshot file: its keys, row count and first row number
``pointer``               appended rows (version, count, created_at); the newest is current
``results/run_id=<r>/attempt=<a>``  published predictions of one attempt; the run row names the one that counts
``runs/bucket=<b>``       appended run events, by a hash of the run id; the last non-null value of a field counts
"""

from __future__ import annotations

import math
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.operators.cells import latest_fields
from larder.operators.prepare import prepare_products
from larder.operators.publish import check_joined, joined_predictions, result_rows
from larder.schema import (
    KEY,
    POINTER_SCHEMA,
    PREPARED_SCHEMA,
    RUN_EVENT_SCHEMA,
    RUN_FIELDS,
    TABLE_LAYOUT,
    ProductLayout,
    strings,
)
from larder.sources.folders import remove, subfolders
from larder.sources.scratch import stored

ATTEMPT_EVENT_SCHEMA = T.StructType([*RUN_EVENT_SCHEMA.fields, T.StructField("attempt", T.StringType())])

PAGE_CAP = 1000
ROWS_PER_FILE = 1_000_000
ROWS_PER_SMALL_FILE = 10_000
RUN_BUCKETS = 64
PUBLISH_SOURCE = "data-mart"

RANGE_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("first_code", T.StringType()),
        T.StructField("last_code", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("start", T.LongType()),
    ]
)
RESULT_SCHEMA = strings(
    "result_key", "cluster", "created_at", "product_name", "categories", "run_id", "attempt"
)


def utc_now() -> str:
    """UTC time in microseconds, always of one width so that text order is time order."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def run_bucket(run_id: Column) -> Column:
    """The folder of a run's events."""
    return F.pmod(F.xxhash64(run_id), F.lit(RUN_BUCKETS)).cast("int")


@dataclass(frozen=True)
class Snapshot:
    version: str
    count: int
    created_at: str


class NoSnapshot(RuntimeError):
    """No dataset version has been published yet."""


class VersionMismatch(RuntimeError):
    """The current version is not the expected one."""


def checked_time(text: str | None) -> str:
    """The text if it is a time with a zone, now if there is none; times of any width may be mixed."""
    if text is None:
        return utc_now()
    if datetime.fromisoformat(text).tzinfo is None:
        raise ValueError(f"time without a zone: {text}")
    return text


def check_page(offset: int, limit: int, cap: int) -> int:
    """The effective page size, or an error for an impossible page."""
    if offset < 0:
        raise ValueError(f"offset must not be negative, got {offset}")
    if limit <= 0:
        raise ValueError(f"limit must be positive, got {limit}")
    return min(limit, cap)


@dataclass(frozen=True)
class ProductMart:
    spark: SparkSession
    root: str
    page_cap: int = PAGE_CAP

    # Snapshots

    def refresh(
        self,
        raw: DataFrame,
        version: str,
        created_at: str | None = None,
        layout: ProductLayout = TABLE_LAYOUT,
    ) -> Snapshot:
        """Prepare the raw products and make them the current version."""
        return self.publish_snapshot(prepare_products(raw, layout), version, created_at)

    def publish_snapshot(
        self, prepared: DataFrame, version: str, created_at: str | None = None
    ) -> Snapshot:
        """Store prepared products as a version: data, then ranges, then the pointer.

        The data is range-partitioned and sorted by its unique key once here,
        so that no page has to sort it again. Until the pointer row exists
        nobody reads the version, and a repeated attempt replaces its files.
        """
        if not re.fullmatch(r"[A-Za-z0-9._-]+", version):
            raise ValueError(f"version may hold letters, digits, '.', '_' and '-': {version!r}")
        if not self.pointers().filter(F.col("version") == version).isEmpty():
            raise ValueError(f"version exists: {version}")
        created_at = checked_time(created_at)
        prepared = prepared.select(*PREPARED_SCHEMA.names)
        rows = prepared.count()
        (
            prepared.repartitionByRange(self._file_count(rows), KEY)
            .sortWithinPartitions(KEY)
            .write.mode("overwrite")
            .parquet(self._version_path(version))
        )
        before = Window.orderBy("first_code").rowsBetween(Window.unboundedPreceding, -1)
        (
            self.snapshot(version)
            .groupBy(F.col("_metadata.file_name").alias("file"))
            .agg(
                F.min(KEY).alias("first_code"),
                F.max(KEY).alias("last_code"),
                F.count(F.lit(1)).alias("rows"),
            )
            # One row per file, once per version, so that no page has to sum them.
            .withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))
            .write.mode("overwrite")
            .parquet(f"{self.root}/ranges/version={version}")
        )
        snapshot = Snapshot(version, rows, created_at)
        row = [(snapshot.version, snapshot.count, snapshot.created_at)]
        self.spark.createDataFrame(row, POINTER_SCHEMA).write.mode("append").parquet(
            f"{self.root}/pointer"
        )
        return snapshot

    def pointers(self) -> DataFrame:
        """Every published version."""
        return self._read_or_empty("pointer", POINTER_SCHEMA)

    def current_pointer(self) -> DataFrame:
        """The newest pointer row by time, whatever the width of its text, or no row."""
        at = F.to_timestamp("created_at")
        return self.pointers().orderBy(at.desc(), F.desc("version")).limit(1)

    def current(self) -> Snapshot:
        row = self.current_pointer().first()
        if row is None:
            raise NoSnapshot("no snapshot has been published")
        return Snapshot(row["version"], row["count"], row["created_at"])

    def require_current(self, snapshot: Snapshot) -> None:
        """Error if another version has become current since."""
        current = self.current()
        if current.version != snapshot.version:
            raise VersionMismatch(f"{snapshot.version} is no longer current, {current.version} is")

    def snapshot(self, version: str) -> DataFrame:
        """All rows of one version (S13); only its own files are listed and read."""
        return self.spark.read.schema(PREPARED_SCHEMA).parquet(self._version_path(version))

    def read_current(self) -> tuple[Snapshot, DataFrame]:
        """The current version, pinned once, and all its rows (L4)."""
        pinned = self.current()
        return pinned, self.snapshot(pinned.version)

    def page(self, offset: int, limit: int, version: str | None = None) -> DataFrame:
        """Rows ``offset`` to ``offset + limit`` by key of the current version (L3).

        Who reads several pages names the version of the first; once another
        version is current, that is an error instead of a mixture (L4). The
        ranges tell which files hold the page, so a page reads these files, at
        most one per row, at any depth. ``total`` is the pointer's count.
        """
        size = check_page(offset, limit, self.page_cap)
        pinned = self.current()
        if version not in (None, pinned.version):
            raise VersionMismatch(f"pages of {version} were asked for, but {pinned.version} is current")
        files = (
            self._ranges(pinned.version)
            .select("file", "rows", "start")
            .filter((F.col("start") < offset + size) & (F.col("start") + F.col("rows") > offset))
            .collect()
        )
        if files:
            folder = self._version_path(pinned.version)
            rows = self.spark.read.schema(PREPARED_SCHEMA).parquet(
                *[f"{folder}/{found['file']}" for found in files]
            )
            start = min(found["start"] for found in files)
        else:
            rows, start = self.spark.createDataFrame([], PREPARED_SCHEMA), offset
        page = rows.orderBy(KEY).offset(offset - start).limit(size)
        number = F.row_number().over(Window.orderBy(KEY)).cast("bigint")
        return page.select(
            F.lit(pinned.version).alias("version"),
            F.lit(pinned.count).cast("bigint").alias("total"),
            F.lit(offset).cast("bigint").alias("offset"),
            F.lit(size).cast("bigint").alias("limit"),
            (number + F.lit(offset)).alias("row_number"),
            *PREPARED_SCHEMA.names,
        )

    # Results

    def publish(
        self,
        run_id: str,
        predictions: DataFrame,
        silhouette: float,
        created_at: str | None = None,
        version: str | None = None,
        put_seq: int | None = None,
    ) -> int:
        """Join, check, store the results, then the run row; returns the number published.

        Predictions are joined once. Each attempt writes a folder of its own, and
        the run row, which comes last, names it: ``results`` shows the named
        attempt of complete runs, so a retry that fails midway changes nothing.
        ``version`` should be the one trained on; by default the current one.
        """
        if not run_id:
            raise ValueError("a publication wants a run id")
        created_at = checked_time(created_at)
        products = self.snapshot(version or self.current().version)
        attempt = uuid.uuid4().hex
        with stored(joined_predictions(predictions, products), "joined-predictions") as joined:
            published = check_joined(joined)
            self._store_results(result_rows(joined, run_id, created_at), attempt)
        self.put_run(
            run_id,
            put_seq,
            attempt,
            status="complete",
            completed_at=created_at,
            published_rows=str(published),
            silhouette=str(silhouette),
            source=PUBLISH_SOURCE,
        )
        return published

    def _store_results(self, rows: DataFrame, attempt: str) -> None:
        stored = rows.withColumn("attempt", F.lit(attempt))
        stored.write.mode("append").partitionBy("run_id", "attempt").parquet(f"{self.root}/results")

    def results(self, run_id: str | None = None) -> DataFrame:
        """Published predictions of complete runs."""
        rows = self._read_or_empty("results", RESULT_SCHEMA)
        if run_id is not None:
            rows = rows.filter(F.col("run_id") == run_id)
        complete = self._last_events(run_id).filter(F.col("status") == "complete").select("run_id", "attempt")
        return rows.join(complete, ["run_id", "attempt"], "left_semi").drop("attempt")

    def remove_attempts(self, run_id: str) -> int:
        """Delete result folders of a run that its run row doesn't name; returns how many.

        Call it when no publication of the run is under way: one that has stored its rows and not yet put its run row
        looks like a failed one.
        """
        named = {row["attempt"] for row in self._last_events(run_id).select("attempt").collect()}
        # Partition values are escaped in folder names.
        own = [name for name in subfolders(self.spark, f"{self.root}/results") if unquote(name) == f"run_id={run_id}"]
        folders = [f"{self.root}/results/{name}" for name in own]
        stray = [
            f"{folder}/{name}"
            for folder in folders
            for name in subfolders(self.spark, folder)
            if name.removeprefix("attempt=") not in named
        ]
        for path in stray:
            remove(self.spark, path)
        return len(stray)

    # Runs

    def put_run(self, run_id: str, put_seq: int | None = None, attempt: str | None = None, **fields: str) -> None:
        """Append one run event; fields it leaves out keep their value."""
        unknown = sorted(set(fields) - set(RUN_FIELDS))
        if unknown:
            raise ValueError(f"no such run fields: {', '.join(unknown)}")
        if not fields:
            raise ValueError("a put must carry at least one field")
        sequence = time.time_ns() if put_seq is None else put_seq
        row = (run_id, *[fields.get(name) for name in RUN_FIELDS], sequence, attempt)
        self.put_run_events(self.spark.createDataFrame([row], ATTEMPT_EVENT_SCHEMA))

    def put_run_events(self, events: DataFrame) -> None:
        """Append run events in bulk."""
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_EVENT_SCHEMA]
        attempt = F.col("attempt") if "attempt" in events.columns else F.lit(None).cast("string")
        # Rows of a bucket come together, so a bulk put adds a file per bucket, not one per task and bucket.
        dealt = events.select(*columns, attempt.alias("attempt"), run_bucket(F.col("run_id")).alias("bucket"))
        dealt.repartition("bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.root}/runs")

    def runs(self, run_id: str | None = None) -> DataFrame:
        """One row per run, or of one run, with the last value of every field.

        Asking for one run opens one folder of events.
        """
        return self._last_events(run_id).drop("attempt")

    def _last_events(self, run_id: str | None = None) -> DataFrame:
        if run_id is None:
            events = self._read_or_empty("runs", ATTEMPT_EVENT_SCHEMA)
        else:
            events = self._read_or_empty(f"runs/bucket={self._bucket_of(run_id)}", ATTEMPT_EVENT_SCHEMA)
            events = events.filter(F.col("run_id") == run_id)
        return latest_fields(events, "run_id", (*RUN_FIELDS, "attempt"), "put_seq")

    def _bucket_of(self, run_id: str) -> int:
        return self.spark.range(1).select(run_bucket(F.lit(run_id))).first()[0]

    def fold_runs(self) -> int:
        """Replace the events of every bucket by those that still decide a field; returns how many events went.

        The folded events are written first and the files they replace removed after: who reads in between
        sees events twice, which changes nothing, and a fold that fails midway can be repeated. One fold at a time,
        and none beside puts that carry an older ``put_seq``.
        """
        events = self._read_or_empty("runs", ATTEMPT_EVENT_SCHEMA)
        files = events.inputFiles()
        fields = [*RUN_FIELDS, "attempt"]
        last = events.groupBy("run_id").agg(
            *[F.max(F.when(F.col(name).isNotNull(), F.col("put_seq"))).alias(f"__{name}") for name in fields]
        )
        decides = reduce(or_, [F.col("put_seq").eqNullSafe(F.col(f"__{name}")) for name in fields])
        kept = events.join(last, "run_id").filter(decides).select(*ATTEMPT_EVENT_SCHEMA.names).distinct()
        before = events.count()
        with stored(kept, "folded-runs") as folded:
            after = folded.count()
            self.put_run_events(folded)
        for path in files:
            remove(self.spark, path)
        return before - after

    @contextmanager
    def tracked_run(self, run_id: str) -> Iterator[None]:
        """Mark the run running, and failed if the block raises.

        Completing it is up to ``publish``.
        """
        started_at = utc_now()
        self.put_run(run_id, status="running", started_at=started_at)
        try:
            yield
        except BaseException:
            self.put_run(run_id, status="failed", started_at=started_at, failed_at=utc_now())
            raise

    # Storage

    def _file_count(self, rows: int) -> int:
        """Files for so many rows: of bounded size, and enough of them to use all cores."""
        cores = self.spark.sparkContext.defaultParallelism
        spread = min(cores, math.ceil(rows / ROWS_PER_SMALL_FILE))
        return max(1, spread, math.ceil(rows / ROWS_PER_FILE))

    def _version_path(self, version: str) -> str:
        return f"{self.root}/prepared/version={version}"

    def _ranges(self, version: str) -> DataFrame:
        return self.spark.read.schema(RANGE_SCHEMA).parquet(
            f"{self.root}/ranges/version={version}"
        )

    def _read_or_empty(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
