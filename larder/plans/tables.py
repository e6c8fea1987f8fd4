"""The five cell tables, and loading, training and inspecting on them."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from larder.operators.cells import (
    RESULT_CELLS,
    Cell,
    from_cells,
    product_cells,
    result_cells,
    row_counts,
    run_statuses,
    seed_counts,
    seed_products,
    to_cells,
)
from larder.plans.mart import utc_now
from larder.plans.train import CLUSTERS, MAX_ITERATIONS, SEED, TrainingRun, train_products
from larder.schema import (
    FEATURE_SLOTS,
    FILE_LAYOUT,
    IDENTITY_COLUMNS,
    KEY,
    RUN_FIELDS,
    TABLE_LAYOUT,
    ProductLayout,
    strings,
)
from larder.sources.celltable import CellTable
from larder.sources.files import with_file_order
from larder.sources.scratch import materialize, stored

RUN_CELLS: dict[str, Cell] = {name: ("run", name) for name in RUN_FIELDS}
POINTER_CELLS: dict[str, Cell] = {
    name: ("meta", name) for name in ("version", "count", "created_at")
}
PREPARED_CELLS: dict[str, Cell] = {
    "version": ("meta", "version"),
    "code": ("meta", "code"),
    "product_name": ("info", "product_name"),
    "categories": ("info", "categories"),
    **{name: ("feature", name) for name in FEATURE_SLOTS},
}
POINTER_KEY = "current"


def prepared_cells(prepared: DataFrame, version: str) -> DataFrame:
    """Prepared products as text cells keyed ``version:code``."""
    rows = prepared.select(
        F.concat(F.lit(f"{version}:"), F.col("code")).alias("storage_key"),
        F.lit(version).alias("version"),
        *IDENTITY_COLUMNS,
        *FEATURE_SLOTS,
    )
    return to_cells(rows, "storage_key", PREPARED_CELLS)


def prepared_from_cells(cells: DataFrame, version: str) -> DataFrame:
    """Prepared products of a version from its cells, features as numbers again."""
    own = cells.filter(F.col("row_key").startswith(f"{version}:"))
    rows = from_cells(own, "storage_key", PREPARED_CELLS).filter(F.col("version") == version)
    texts = [F.coalesce(name, F.lit("")).alias(name) for name in ("product_name", "categories")]
    numbers = [F.col(name).try_cast("double").alias(name) for name in FEATURE_SLOTS]
    return rows.select("code", *texts, *numbers)


@dataclass(frozen=True)
class CellTables:
    """Raw, prepared, pointer, result and run tables below one folder."""

    spark: SparkSession
    root: str

    def table(self, name: str) -> CellTable:
        return CellTable(self.spark, f"{self.root}/{name}")

    @property
    def raw(self) -> CellTable:
        return self.table("raw")

    @property
    def prepared(self) -> CellTable:
        return self.table("prepared")

    def prepared_version(self, version: str) -> CellTable:
        """The cells of one version, in a folder of their own: who reads it lists no other version's files."""
        return self.table(f"prepared/version={version}")

    def prepared_products(self, version: str) -> DataFrame:
        return prepared_from_cells(self.prepared_version(version).log(), version)

    @property
    def pointer(self) -> CellTable:
        return self.table("pointer")

    @property
    def results(self) -> CellTable:
        return self.table("results")

    @property
    def runs(self) -> CellTable:
        return self.table("runs")

    def raw_products(
        self, layout: ProductLayout = TABLE_LAYOUT, scan_limit: int | None = None
    ) -> DataFrame:
        """Products of the raw table; all of them unless a scan limit is asked for."""
        cells = self.raw.log()
        if scan_limit is not None:
            cells = self.raw.scan(scan_limit).withColumn("put_seq", F.lit(0).cast("bigint"))
        return from_cells(cells, "code", product_cells(layout))

    def seed(self, raw: DataFrame, layout: ProductLayout = FILE_LAYOUT) -> dict[str, int]:
        """Load a file scan into the raw table; returns how many rows it put and rejected.

        The file is read once: rows are counted on the way and merged by key in file order into a stored
        table. The key ranges of the put come from that.
        """
        seen = Observation("seed")
        counts = [column.alias(name) for name, column in seed_counts(layout).items()]
        merged = seed_products(with_file_order(raw, packed=True).observe(seen, *counts), layout)
        with stored(merged, "seeded") as products:
            self.raw.put_ordered(products, KEY, product_cells(layout), F.lit(time.time_ns()))
        return dict(seen.get)

    def publish_prepared(
        self, prepared: DataFrame, version: str, count: int, created_at: str
    ) -> None:
        """A prepared snapshot and then the pointer to it, as cells."""
        sequence = F.lit(time.time_ns()).alias("put_seq")
        self.prepared_version(version).put(prepared_cells(prepared, version).withColumn("put_seq", sequence))
        row = [(POINTER_KEY, version, str(count), created_at)]
        schema = strings("metadata_key", *POINTER_CELLS)
        self.pointer.put_rows(
            self.spark.createDataFrame(row, schema), "metadata_key", POINTER_CELLS, sequence
        )

    def current_version(self) -> tuple[str, int, str]:
        row = self.pointer.rows("metadata_key", POINTER_CELLS).filter(
            F.col("metadata_key") == POINTER_KEY
        ).first()
        if row is None:
            raise RuntimeError("no prepared version has been published")
        return row["version"], int(row["count"]), row["created_at"]

    def put_run(self, run_id: str, **fields: str) -> None:
        """Put run cells; fields left out keep their value."""
        if not fields:
            raise ValueError("a put must carry at least one cell")
        row = [(run_id, *[fields.get(name) for name in RUN_FIELDS])]
        frame = self.spark.createDataFrame(row, strings("run_id", *RUN_FIELDS))
        self.runs.put_rows(frame, "run_id", RUN_CELLS, F.lit(time.time_ns()))

    def run_rows(self) -> DataFrame:
        return self.runs.rows("run_id", RUN_CELLS)

    def result_rows(self, run_id: str | None = None) -> DataFrame:
        """Published predictions of complete runs only."""
        complete = self.run_rows().filter(F.col("status") == "complete").select("run_id")
        rows = self.results.log()
        if run_id is not None:
            complete = complete.filter(F.col("run_id") == run_id)
            rows = rows.filter(F.col("row_key").startswith(f"{run_id}:"))
        return from_cells(rows, "result_key", RESULT_CELLS).join(complete, "run_id", "left_semi")

    def row_counts(self) -> DataFrame:
        names = ("raw", "prepared", "pointer", "results", "runs")
        return row_counts({name: self.table(name).log() for name in names})

    def run_statuses(self) -> DataFrame:
        return run_statuses(self.runs.log())


def train_from_table(
    tables: CellTables,
    run_id: str,
    clusters: int = CLUSTERS,
    seed: int = SEED,
    max_iterations: int = MAX_ITERATIONS,
    output_dir: str | None = None,
    scan_limit: int | None = None,
) -> TrainingRun:
    """Train on the raw table and put the results back, under an audited run."""
    started_at = utc_now()
    try:
        # The merge of the log runs once, into a stored table.
        products = materialize(tables.raw_products(TABLE_LAYOUT, scan_limit), "raw-products")
        if products.isEmpty():
            raise RuntimeError("raw table contains no products")
        tables.put_run(run_id, status="running", started_at=started_at)
        layout = ProductLayout(TABLE_LAYOUT.bounds, trim_text=True)
        run = train_products(
            products, clusters, seed, max_iterations, output_dir, layout
        )
        completed_at = utc_now()
        tables.results.put(
            result_cells(run.assigned, run_id, completed_at).withColumn(
                "put_seq", F.lit(time.time_ns())
            )
        )
        # One prediction per usable row. The run row comes last and commits.
        tables.put_run(
            run_id,
            status="complete",
            started_at=started_at,
            completed_at=completed_at,
            published_rows=str(run.usable_rows),
            silhouette=str(run.silhouette),
        )
        return run
    except BaseException:
        tables.put_run(run_id, status="failed", started_at=started_at, failed_at=utc_now())
        raise
