from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from larder.operators.cells import (
    cells_to_products,
    first_rows,
    from_cells,
    latest_cells,
    latest_fields,
    products_to_cells,
    result_cells,
    row_counts,
    run_statuses,
    seed_counts,
    seed_products,
    to_cells,
)
from larder.plans.tables import CellTables
from larder.schema import CELL_SCHEMA, FILE_LAYOUT, PREPARED_SCHEMA, ProductLayout
from larder.sources.celltable import CellTable
from larder.sources.files import read_products_tsv, with_file_order
from larder.sources.scratch import scratch_root


def as_cells(spark, *rows):
    return spark.createDataFrame(list(rows), CELL_SCHEMA)


def test_cells_become_a_product_with_nulls_for_absent_cells(spark):
    cells = as_cells(
        spark,
        ("123", "info", "product_name", "Oats", 1),
        ("123", "info", "categories", "Cereals", 1),
        ("123", "nutrition", "proteins_100g", "13", 1),
        ("123", "nutrition", "energy_kcal_100g", "370", 1),
        ("123", "model", "proteins_100g", "99", 9),
    )
    product = cells_to_products(cells).first()
    assert product["code"] == "123"
    assert product["product_name"] == "Oats"
    assert product["proteins_100g"] == "13"
    assert product["energy-kcal_100g"] == "370"
    assert product["salt_100g"] is None


def test_blank_fields_give_no_cell_and_values_keep_their_blanks(file_products):
    rows = file_products(("1", " Oats ", "  ", "", None, "1", *[None] * 5))
    found = {(r["family"], r["qualifier"]): r["value"] for r in products_to_cells(rows).collect()}
    assert found == {("info", "product_name"): " Oats ", ("nutrition", "saturated_fat_100g"): "1"}


def test_a_later_put_changes_only_the_cells_it_carries(spark):
    cells = as_cells(
        spark,
        ("r", "a", "x", "old", 1),
        ("r", "a", "y", "kept", 1),
        ("r", "a", "x", "new", 2),
        ("r", "b", "x", "other family", 1),
    )
    resolved = {(r["family"], r["qualifier"]): r["value"] for r in latest_cells(cells).collect()}
    assert resolved == {("a", "x"): "new", ("a", "y"): "kept", ("b", "x"): "other family"}
    assert tuple(from_cells(cells, "k", {"x": ("a", "x"), "z": ("a", "z")}).first()) == ("r", "new", None)


def test_puts_of_one_moment_resolve_the_same_way_in_any_order(spark):
    rows = [("r", "a", "x", value, 1) for value in ("one", "two", "three")]
    for puts in (rows, rows[::-1]):
        assert [r["value"] for r in latest_cells(as_cells(spark, *puts)).collect()] == ["two"]


def test_last_field_wins_per_key(spark):
    events = spark.createDataFrame(
        [("r", "running", "t0", 1), ("r", None, None, 3), ("r", "complete", None, 2), ("q", None, None, 1)],
        "run_id string, status string, started_at string, put_seq long",
    )
    found = {row["run_id"]: row for row in latest_fields(events, "run_id", ["status", "started_at"], "put_seq").collect()}
    assert (found["r"]["status"], found["r"]["started_at"]) == ("complete", "t0")
    assert found["q"]["status"] is None


def test_scan_takes_the_smallest_keys_with_all_their_cells(spark):
    cells = as_cells(
        spark, *[(f"k{i}", "f", q, f"{q}{i}", 1) for i in (3, 1, 2, 10) for q in "xy"], ("k1", "f", "x", "z", 2)
    )
    found = sorted(tuple(row) for row in first_rows(cells, 2).collect())
    assert found == [
        ("k1", "f", "x", "z"), ("k1", "f", "y", "y1"), ("k10", "f", "x", "x10"), ("k10", "f", "y", "y10")
    ]
    with pytest.raises(ValueError, match="positive limit"):
        first_rows(cells, 0)


def test_table_appends_puts_and_reads_empty_when_never_written(spark, tmp_path):
    table = CellTable(spark, str(tmp_path / "t"))
    assert table.log().isEmpty()
    assert table.scan(5).isEmpty()
    rows = spark.createDataFrame([("ключ/1", "Овёс", "")], "k string, name string, none string")
    mapping = {"name": ("info", "name"), "none": ("info", "none")}
    table.put_rows(rows, "k", mapping, F.lit(1))
    table.put_rows(rows.withColumn("name", F.lit("later")), "k", mapping, F.lit(2))
    assert [tuple(r) for r in table.cells().collect()] == [("ключ/1", "info", "name", "later")]
    assert tuple(table.rows("k", mapping).first()) == ("ключ/1", "later", None)


def test_seeding_keeps_the_last_value_of_each_field_in_file_order(spark, export_path):
    raw = read_products_tsv(spark, export_path)
    merged = {row["code"]: row for row in seed_products(with_file_order(raw)).collect()}
    assert len(merged) == 40
    assert merged["1040"]["product_name"] == "Right on the scale"
    assert merged["1040"]["energy-kcal_100g"] == "286"
    assert merged["1040"]["categories"] == "Kind 9"


def test_rows_without_any_cell_are_rejected(file_products):
    rows = file_products(("1", *[None] * 10), (" 2 ", "x", *[""] * 9), ("", "y", *[None] * 9))
    counts = [column.alias(name) for name, column in seed_counts().items()]
    assert rows.agg(*counts).first().asDict() == {"seeded": 1, "rejected": 1}
    ordered = rows.withColumn("put_seq", F.lit(0))
    assert [row["code"] for row in seed_products(ordered, FILE_LAYOUT).collect()] == ["2"]


def test_result_cells_carry_the_run_and_keep_empty_texts(spark):
    predictions = spark.createDataFrame(
        [("7", 2, "Oats", None)], "code string, cluster int, product_name string, categories string"
    )
    found = {
        (r["row_key"], f"{r['family']}:{r['qualifier']}"): r["value"]
        for r in result_cells(predictions, "run-1", "2026-09-01T00:00:00Z").collect()
    }
    assert found == {
        ("run-1:7", "model:run_id"): "run-1",
        ("run-1:7", "model:cluster"): "2",
        ("run-1:7", "model:created_at"): "2026-09-01T00:00:00Z",
        ("run-1:7", "info:product_name"): "Oats",
        ("run-1:7", "info:categories"): "",
    }


def test_row_counts_and_run_statuses(spark):
    cells = as_cells(
        spark,
        ("r1", "run", "status", "running", 1),
        ("r1", "run", "status", "complete", 2),
        ("r2", "run", "started_at", "t", 1),
    )
    empty = spark.createDataFrame([], CELL_SCHEMA)
    assert {tuple(r) for r in row_counts({"runs": cells, "raw": empty}).collect()} == {("runs", 2), ("raw", 0)}
    assert {tuple(r) for r in run_statuses(cells).collect()} == {("r1", "complete"), ("r2", "unknown")}


def test_cells_without_put_order_come_from_any_mapping(spark):
    rows = spark.createDataFrame([("k", 1.5)], "key string, x double")
    assert [tuple(r) for r in to_cells(rows, "key", {"x": ("f", "x")}).collect()] == [("k", "f", "x", "1.5")]


def test_white_space_of_any_kind_is_no_cell_and_no_part_of_a_key(spark):
    raw = spark.createDataFrame([("k\u00a0", "\t"), ("\u2003k", "name"), ("\x1c", "lost")], "code string, product_name string")
    layout = ProductLayout({}, trim_text=False)
    rows = raw.withColumn("categories", F.lit(None).cast("string")).withColumn("put_seq", F.monotonically_increasing_id())
    assert [(r["code"], r["product_name"]) for r in seed_products(rows, layout).collect()] == [("k", "name")]
    cells = to_cells(raw, "code", {"product_name": ("info", "product_name")})
    assert sorted(r["value"] for r in cells.collect()) == ["lost", "name"]


def numbered_rows(spark, low, high, partitions=8, value="v"):
    return spark.range(low, high, 1, partitions).select(F.format_string("%05d", "id").alias("k"), F.lit(value).alias("name"))


def test_a_limited_scan_reads_the_files_of_its_keys_alone(spark, tmp_path):
    table, mapping = CellTable(spark, str(tmp_path / "cells")), {"name": ("f", "q")}
    table.put_ordered(numbered_rows(spark, 0, 8000), "k", mapping, F.lit(0), files=8)
    files = table.log().inputFiles()
    assert len(files) >= 8
    found = table.scan(3)
    assert "LessThanOrEqual(row_key,00002)" in found._jdf.queryExecution().executedPlan().toString()
    assert len(found.inputFiles()) == 1 and found.count() == 3
    assert len(table.scan(7990).inputFiles()) == len(files) and table.scan(9000).count() == 8000


def test_a_limited_scan_over_several_puts(spark, tmp_path):
    """Ordered puts that overlap, a plain one in between, and one whose ranges were never noted."""
    table, mapping = CellTable(spark, str(tmp_path / "cells")), {"name": ("f", "q")}
    table.put_ordered(numbered_rows(spark, 100, 4000), "k", mapping, F.lit(0), files=6)
    table.put_ordered(numbered_rows(spark, 90, 300, value="w"), "k", mapping, F.lit(1), files=3)
    table.put_rows(numbered_rows(spark, 95, 97, value="z"), "k", mapping, F.lit(2))
    unnoted = to_cells(numbered_rows(spark, 0, 5, value="u"), "k", mapping, F.lit(3)).withColumn("put_seq", F.lit(3))
    unnoted.withColumn("put_seq", F.col("put_seq").cast("long")).write.parquet(f"{table.path}/put=ordered-lost")
    expected = {**{f"{i:05d}": "v" for i in range(100, 4000)}, **{f"{i:05d}": "w" for i in range(90, 300)}}
    expected |= {"00095": "z", "00096": "z", **{f"{i:05d}": "u" for i in range(5)}}
    for limit in (1, 5, 8, 40, 250, 3000, 10_000):
        found = {r["row_key"]: r["value"] for r in table.scan(limit).collect()}
        assert found == {key: expected[key] for key in sorted(expected)[:limit]}
    assert len(table.scan(40).inputFiles()) < len(table.log().inputFiles())


def test_unordered_rows_put_as_ordered_stay_right(spark, tmp_path):
    table = CellTable(spark, str(tmp_path / "cells"))
    rows = to_cells(numbered_rows(spark, 0, 900).repartition(4), "k", {"name": ("f", "q")}, F.lit(1))
    for _ in range(2):
        table.put(rows, ordered=True)
    for limit in (1, 10, 300, 899, 900, 901):
        assert sorted(r["row_key"] for r in table.scan(limit).collect()) == [f"{i:05d}" for i in range(min(limit, 900))]


def test_seeding_reads_the_file_once_and_counts_on_the_way(spark, export_path, tmp_path):
    tables = CellTables(spark, str(tmp_path / "tables"))
    raw = read_products_tsv(spark, export_path, FILE_LAYOUT.raw_schema)
    seen = Observation("rows read")
    watched = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
    assert tables.seed(watched) == {"seeded": 41, "rejected": 0} and seen.get["rows"] == 42
    assert {r["row_key"] for r in tables.raw.cells().collect()} >= {"1000", "1040"}
    assert scratch_tables(spark, "seeded") == []


def scratch_tables(spark, label):
    folder = Path(scratch_root(spark).removeprefix("file:")) / spark.sparkContext.applicationId
    return sorted(path.name for path in folder.glob(f"{label}-*"))


def test_versions_of_prepared_cells_are_listed_apart(spark, tmp_path):
    tables = CellTables(spark, str(tmp_path / "tables"))
    rows = spark.createDataFrame([(f"c{i}", "n", "", *[float(i)] * 8) for i in range(9)], PREPARED_SCHEMA).coalesce(1)
    listed = []
    for i in range(10):
        tables.publish_prepared(rows, f"v{i}", 9, "2024-01-01T00:00:00.000000Z")
        listed.append(len(tables.prepared_products("v0").inputFiles()))
    assert len(set(listed)) == 1 and tables.prepared_products("v7").count() == 9
    assert {r["table_name"]: r["rows"] for r in tables.row_counts().collect()}["prepared"] == 90


def test_results_of_failed_table_runs_stay_hidden(spark, tmp_path):
    tables = CellTables(spark, str(tmp_path / "tables"))
    predictions = spark.createDataFrame([("7", "a", "b", 1)], "code string, product_name string, categories string, cluster int")
    for run_id, status in (("good", "complete"), ("bad", "failed")):
        tables.results.put(result_cells(predictions, run_id, "t").withColumn("put_seq", F.lit(1)))
        tables.put_run(run_id, status=status)
    assert [row["run_id"] for row in tables.result_rows().collect()] == ["good"]
    assert tables.result_rows("bad").isEmpty()
