"""The registered queries: each operator over whole given tables.

Every query takes ``(spark, sf_dir)``. Queries that store something write below
the session's scratch folder.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import suppress

from pyspark.ml.clustering import KMeansModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.columns import not_blank, quoted
from larder.operators.cells import (
    cells_to_products,
    latest_cells,
    product_cells,
    products_to_cells,
    result_cells,
    row_counts,
    to_cells,
)
from larder.operators.clean import (
    bound_measurements,
    clean_products,
    dedupe_by_key,
    parse_measurements,
)
from larder.operators.prepare import (
    IMPUTED,
    assemble,
    impute_median,
    prepare_products,
    spread,
    standardize,
)
from larder.operators.publish import duplicate_codes, unknown_codes
from larder.operators.segment import (
    assign_to_centres,
    centre_rows,
    cluster_sizes,
    kmeans,
    lloyd_step,
    mean_silhouette,
    vectors_from_arrays,
)
from larder.operators.text import word_count
from larder.plans.mart import ProductMart
from larder.plans.tables import RUN_CELLS, CellTables, prepared_cells, prepared_from_cells
from larder.plans.train import CLUSTERS, MAX_ITERATIONS, SEED, train_prepared, train_products
from larder.schema import (
    FEATURE_SLOTS,
    IDENTITY_COLUMNS,
    TABLE_LAYOUT,
    ProductLayout,
    strings,
)
from larder.sources.celltable import CellTable
from larder.sources.files import read_lines, read_products_tsv, write_products_tsv
from larder.sources.outputs import (
    metrics_row,
    read_metrics,
    read_predictions,
    write_metrics,
    write_predictions,
)
from larder.sources.scratch import materialize, scratch_path
from workload.inputs import document_texts, raw_products, separated_points, table

Query = Callable[[SparkSession, str], DataFrame]

LAYOUT = TABLE_LAYOUT
TRIMMED = ProductLayout(TABLE_LAYOUT.bounds, trim_text=True)

CENTRES = [
    [(((k * 7 + i * 3) % 5) - 2) / 2 for i in range(len(FEATURE_SLOTS))] for k in range(CLUSTERS)
]
SCAN_LIMIT = 100
#: How far a fitted centre may be from the mean of its members; a fit may end with an iteration to go.
CENTRE_TOLERANCE = 0.02
PAGE_OFFSET = PAGE_LIMIT = 500
RUN_ID = "run-1"
VERSIONS = {"v1": "2024-01-01T00:00:00.000000Z", "v2": "2024-01-02T00:00:00.000000Z"}
PUBLISHED_AT = "2024-01-03T00:00:00.000000Z"


def rounded(name: str) -> Column:
    return (F.round(quoted(name), 6) + F.lit(0.0)).alias(name)


def rounded_slots(frame: DataFrame, *before: str) -> DataFrame:
    return frame.select(*before, *[rounded(name) for name in FEATURE_SLOTS])


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_products(raw_products(spark, sf_dir), TRIMMED)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare_products(raw_products(spark, sf_dir), LAYOUT)


def assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_to_centres(prepared(spark, sf_dir), FEATURE_SLOTS, CENTRES)


def keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw text row per trimmed, non-blank key."""
    raw = raw_products(spark, sf_dir).filter(not_blank(F.col("code")))
    return dedupe_by_key(raw.withColumn("code", F.trim("code")))


def by_code_length(frame: DataFrame) -> DataFrame:
    """Pinned clusters, so that results do not depend on a fit."""
    return frame.withColumn("cluster", (F.length("code") % CLUSTERS).cast("int"))


def mart(spark: SparkSession, label: str) -> ProductMart:
    return ProductMart(spark, scratch_path(spark, label))


# Sources and cleaning


def tsv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tsv")
    write_products_tsv(raw_products(spark, sf_dir), path)
    return read_products_tsv(spark, path, strings(*LAYOUT.columns))


def parse_locale_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_measurements(raw_products(spark, sf_dir), LAYOUT)
    unread = [F.isnan(quoted(name)).cast("int") for name in LAYOUT.features]
    return parsed.select(
        "code",
        *[F.nanvl(quoted(n), F.lit(None).cast("double")).alias(n) for n in LAYOUT.features],
        sum(unread[1:], unread[0]).alias("nan_fields"),
    )


def bound_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_measurements(raw_products(spark, sf_dir), LAYOUT)
    return bound_measurements(parsed, LAYOUT).select("code", *LAYOUT.features)


def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(spark, sf_dir)


# Preparation


def impute_with_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(clean(spark, sf_dir), "clean")
    filled = impute_median(stored, LAYOUT.features)
    return filled.select("code", *[name + IMPUTED for name in LAYOUT.features])


def standardize_imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(clean(spark, sf_dir), "clean")
    filled = impute_median(stored, LAYOUT.features).select(
        "code", *[F.col(name + IMPUTED).alias(name) for name in LAYOUT.features]
    )
    scores = standardize(filled, LAYOUT.features)
    return scores.select("code", *[rounded(name) for name in LAYOUT.features])


def prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_slots(prepared(spark, sf_dir), *IDENTITY_COLUMNS)


def vector_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = assemble(prepared(spark, sf_dir)).select("code", "features")
    return rounded_slots(spread(vectors), "code")


# Cells


def to_product_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products_to_cells(keyed(spark, sf_dir), LAYOUT)


def from_product_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through a stored table, each row put once."""
    cells = CellTable(spark, scratch_path(spark, "cells"))
    cells.put(products_to_cells(keyed(spark, sf_dir), LAYOUT, F.lit(0)))
    return cells_to_products(cells.log(), LAYOUT)


def scan_first_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = CellTable(spark, scratch_path(spark, "cells"))
    products = materialize(keyed(spark, sf_dir), "keyed")
    cells.put_ordered(products, "code", product_cells(LAYOUT), F.lit(0))
    return cells.scan(SCAN_LIMIT)


def cell_merge_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    puts = (
        table(spark, sf_dir, "events")
        .filter(F.col("value").isNotNull())
        .select(
            F.col("user_id").cast("string").alias("row_key"),
            F.lit("event").alias("family"),
            F.col("event_type").alias("qualifier"),
            F.col("value").cast("decimal(12,2)").cast("string").alias("value"),
            F.struct("ts", "event_id").alias("put_seq"),
        )
    )
    return latest_cells(puts)


def seed_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through files: stored in the order of all fields but the key, loaded in file order."""
    path = scratch_path(spark, "tsv")
    order = [quoted(name) for name in LAYOUT.columns if name != "code"]
    write_products_tsv(raw_products(spark, sf_dir, dealt=False).orderBy(*order), path)
    tables = CellTables(spark, scratch_path(spark, "tables"))
    tables.seed(read_products_tsv(spark, path, strings(*LAYOUT.columns)), LAYOUT)
    return tables.raw.cells()


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run audit puts in ``event_id`` order: every user is a run."""
    kind = F.col("event_type")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    value = F.col("value").cast("decimal(12,2)").cast("string")
    fields = {
        "status": F.when(kind == "signup", "running")
        .when(kind == "purchase", "complete")
        .when(kind == "error", "failed"),
        "started_at": F.when(kind == "signup", at),
        "completed_at": F.when(kind == "purchase", at),
        "failed_at": F.when(kind == "error", at),
        "published_rows": F.when(kind == "purchase", F.col("event_id").cast("string")),
        "silhouette": F.when(kind == "purchase", value),
        "source": F.when(kind.isin("view", "click"), kind),
    }
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_id"),
        *[column.alias(name) for name, column in fields.items()],
        F.col("event_id").alias("put_seq"),
    )


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = prepared(spark, sf_dir)
    runs = to_cells(run_events(spark, sf_dir), "run_id", RUN_CELLS)
    return row_counts(
        {
            "raw": to_cells(keyed(spark, sf_dir), "code", product_cells(LAYOUT)),
            "prepared": prepared_cells(products, "v1"),
            "results": result_cells(by_code_length(products), RUN_ID, PUBLISHED_AT),
            "runs": runs,
        }
    )


def prepared_cell_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared products through a stored table of text cells and back."""
    cells = CellTable(spark, scratch_path(spark, "cells"))
    stored = prepared_cells(prepared(spark, sf_dir), "v1")
    cells.put(stored.withColumn("put_seq", F.lit(0)))
    return rounded_slots(prepared_from_cells(cells.log(), "v1"), *IDENTITY_COLUMNS)


# Snapshots and results


def snapshot_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, raw = mart(spark, "mart"), raw_products(spark, sf_dir)
    for (version, created_at), layout in zip(VERSIONS.items(), (LAYOUT, TRIMMED), strict=True):
        store.refresh(raw, version, created_at, layout)
    return store.pointers()


def two_versions(spark: SparkSession, sf_dir: str) -> ProductMart:
    """Texts as stored in the first version, trimmed in the second."""
    store, products = mart(spark, "mart"), prepared(spark, sf_dir)
    trimmed = products.withColumn("product_name", F.trim("product_name"))
    for (version, created_at), frame in zip(VERSIONS.items(), (products, trimmed), strict=True):
        store.publish_snapshot(frame, version, created_at)
    return store


def snapshot_write_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older version, still whole after the newer one was published."""
    return rounded_slots(two_versions(spark, sf_dir).snapshot("v1"), *IDENTITY_COLUMNS)


def current_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return two_versions(spark, sf_dir).current_pointer()


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = two_versions(spark, sf_dir).page(PAGE_OFFSET, PAGE_LIMIT)
    columns = ("version", "total", "offset", "limit", "row_number", *IDENTITY_COLUMNS)
    return rounded_slots(page, *columns)


def publish_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = mart(spark, "mart")
    pinned = store.publish_snapshot(prepared(spark, sf_dir), "v1", VERSIONS["v1"])
    predictions = by_code_length(store.snapshot(pinned.version)).select("code", "cluster")
    store.publish(RUN_ID, predictions, 0.5, PUBLISHED_AT, pinned.version)
    return store.results(RUN_ID)


def faulty_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One prediction per keyed raw row: repeated keys, and no such product without a category."""
    raw = raw_products(spark, sf_dir).filter(not_blank(F.col("code")))
    mark = F.when(F.col("categories").isNull(), "?").otherwise("")
    return by_code_length(raw.select(F.concat(F.trim("code"), mark).alias("code")))


def unknown_prediction_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unknown_codes(faulty_predictions(spark, sf_dir), clean(spark, sf_dir))


def duplicate_prediction_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_codes(faulty_predictions(spark, sf_dir))


def run_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = mart(spark, "mart")
    store.put_run_events(run_events(spark, sf_dir))
    return store.runs()


def tracked_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run that publishes and one that fails, under their audit."""
    store = mart(spark, "mart")
    pinned = store.publish_snapshot(prepared(spark, sf_dir), "v1", VERSIONS["v1"])
    products = store.snapshot(pinned.version)
    with store.tracked_run("good"):
        store.publish("good", by_code_length(products), 0.5, version=pinned.version)
    unknown = by_code_length(products.withColumn("code", F.concat(F.lit("?"), "code")))
    with suppress(ValueError), store.tracked_run("bad"):
        store.publish("bad", unknown, 0.5, version=pinned.version)
    return store.runs().select("run_id", "status", "published_rows", "silhouette", "source")


def prediction_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return result_cells(by_code_length(clean(spark, sf_dir)), RUN_ID, PUBLISHED_AT)


# Models


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assigned(spark, sf_dir).select("code", "cluster", rounded("distance"))


def one_lloyd_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded_slots(lloyd_step(assigned(spark, sf_dir), FEATURE_SLOTS), "cluster")


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mean_silhouette(assigned(spark, sf_dir), FEATURE_SLOTS).select(rounded("silhouette"))


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_sizes(assigned(spark, sf_dir))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the pinned assignment, written and read back."""
    counted = {r["cluster"]: r["count"] for r in cluster_sizes(assigned(spark, sf_dir)).collect()}
    metrics = metrics_row(
        spark,
        cluster_count=CLUSTERS,
        cluster_sizes=dict(sorted(counted.items())),
        input_rows=raw_products(spark, sf_dir).count(),
        max_iterations=MAX_ITERATIONS,
        seed=SEED,
        usable_rows=sum(counted.values()),
    )
    path = scratch_path(spark, "metrics")
    write_metrics(metrics, path)
    return read_metrics(spark, path).select(
        "algorithm",
        "cluster_count",
        F.to_json("cluster_sizes").alias("cluster_sizes"),
        "input_rows",
        "max_iterations",
        "seed",
        "usable_rows",
    )


def predictions_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "predictions")
    write_predictions(by_code_length(clean(spark, sf_dir)), path, LAYOUT.features, single_file=True)
    return read_predictions(spark, path, LAYOUT.features)


def kmeans_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres of a fit on separated groups, numbered in their order."""
    points = table(spark, sf_dir, "lineitem").selectExpr(*separated_points("string"))
    vectors = materialize(assemble(points).select("code", "features"), "vectors")
    model = kmeans(CLUSTERS, SEED, MAX_ITERATIONS).fit(vectors)
    centres = sorted([round(x, 6) + 0.0 for x in centre] for _, centre in centre_rows(model))
    schema = ", ".join(["cluster int", *[f"{name} double" for name in FEATURE_SLOTS]])
    return spark.createDataFrame([(i, *centre) for i, centre in enumerate(centres)], schema)


def segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a training on the raw products."""
    return train_products(raw_products(spark, sf_dir), layout=TRIMMED).predictions


def at_nearest_centre(scored: DataFrame, model: KMeansModel) -> DataFrame:
    """Records with flags: the row's cluster is that of the nearest fitted centre, and this is the mean of its members."""
    centres = [centre for _, centre in centre_rows(model)]
    names = [f"x{i}" for i in range(len(centres[0]))]
    fitted = scored.select(*IDENTITY_COLUMNS, F.col("cluster").alias("fitted"), "features")
    nearest = materialize(assign_to_centres(spread(fitted, names=names), names, centres), "nearest")
    means = {row["cluster"]: [row[name] for name in names] for row in lloyd_step(nearest, names).collect()}
    shifts = {i: max(abs(x - at) for x, at in zip(mean, centres[i], strict=True)) for i, mean in means.items()}
    still = F.col("cluster").isin([i for i, shift in shifts.items() if shift <= CENTRE_TOLERANCE])
    return nearest.select(*IDENTITY_COLUMNS, (F.col("cluster") == F.col("fitted")).alias("nearest"), still.alias("centred"))


def segment_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products as the training cleaned them, scored by its model."""
    run = train_products(raw_products(spark, sf_dir), layout=TRIMMED)
    return at_nearest_centre(run.model.transform(run.trained_on), run.model.stages[-1])


def embedded(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("code"),
        F.lit("").alias("product_name"),
        F.col("label").cast("string").alias("categories"),
        "embedding",
    )
    return vectors_from_arrays(embeddings, "embedding")


def segment_prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = embedded(spark, sf_dir)
    model = train_prepared(vectors).model
    return at_nearest_centre(model.transform(vectors), model)


def saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model read back from its folder assigns every row as the stored one did."""
    vectors, folder = embedded(spark, sf_dir), scratch_path(spark, "run")
    run = train_prepared(vectors, output_dir=folder)
    again = KMeansModel.load(run.model_path).transform(vectors).select("code", F.col("cluster").alias("again"))
    stored = read_predictions(spark, run.predictions_path)
    return stored.join(again, "code").select("code", (F.col("cluster") == F.col("again")).alias("same"))


# Text


def count_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(document_texts(spark, sf_dir), "text")


def count_words_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through text files, read line by line."""
    path = scratch_path(spark, "lines")
    document_texts(spark, sf_dir).write.text(path)
    return word_count(read_lines(spark, path))


QUERIES: dict[str, Query] = {
    "tsv_scan": tsv_scan,
    "parse_locale_numbers": parse_locale_numbers,
    "bound_to_null": bound_to_null,
    "clean_products": clean,
    "dedupe_by_key": dedupe,
    "impute_median": impute_with_median,
    "standardize": standardize_imputed,
    "prepare_products": prepare,
    "vector_round_trip": vector_round_trip,
    "products_to_cells": to_product_cells,
    "cells_to_products": from_product_cells,
    "scan_first_keys": scan_first_keys,
    "cell_merge_latest": cell_merge_latest,
    "seed_raw": seed_raw,
    "table_row_counts": table_row_counts,
    "prepared_cells": prepared_cell_round_trip,
    "snapshot_refresh": snapshot_refresh,
    "snapshot_write_read": snapshot_write_read,
    "current_snapshot": current_snapshot,
    "page_rows": page_rows,
    "publish_results": publish_results,
    "unknown_codes": unknown_prediction_codes,
    "duplicate_codes": duplicate_prediction_codes,
    "run_lifecycle": run_lifecycle,
    "tracked_runs": tracked_runs,
    "result_cells": prediction_cells,
    "kmeans_assign": kmeans_assign,
    "lloyd_step": one_lloyd_step,
    "silhouette": silhouette,
    "cluster_sizes": sizes,
    "run_metrics": run_metrics,
    "kmeans_fit": kmeans_fit,
    "segment_products": segment_products,
    "segment_prepared": segment_prepared,
    "saved_model": saved_model,
    "predictions_sink": predictions_sink,
    "word_count": count_words,
    "word_count_lines": count_words_of_lines,
}
