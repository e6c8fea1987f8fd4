"""What one task holds must not grow with the table, nor what a merge sends by more than its rows."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from larder.functions import columns
from larder.operators.cells import latest_cells, latest_of_kinds
from larder.schema import CELL_SCHEMA
from larder.sources import celltable
from larder.sources.celltable import CellTable
from larder.sources.files import read_products_tsv, with_file_order


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def puts(spark, rows, order):
    return spark.range(0, rows, 1, 2).selectExpr(
        "lpad(cast(id div 5 as string), 6, '0') as row_key", "'f' as family", "cast(id % 5 as string) as qualifier",
        f"'{order}' || id as value", f"cast({order} as long) as put_seq",
    )


def test_a_task_reads_few_cells_of_a_large_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(celltable, "FILE_CELLS", 100)
    table = CellTable(spark, str(tmp_path / "cells"))
    table.put(puts(spark, 10_000, "1"))
    table.put(puts(spark, 500, "2"), ordered=True)
    log = table.log()
    assert len(log.inputFiles()) >= 105 and log.columns == CELL_SCHEMA.names
    held = log.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert held <= 100 * celltable.TASK_FILES
    assert log.count() == 10_500
    noted = table._ranges().collect()
    assert sum(row["keys"] for row in noted) >= 100 and min(row["first_key"] for row in noted) == "000000"
    assert {row["file"] for row in noted} <= {at.name for at in Path(table.path).glob("put=ordered-*/part-*")}
    assert table.scan(7).count() == 35


def test_cells_of_a_table_are_merged_row_by_row(spark, tmp_path, monkeypatch):
    table = CellTable(spark, str(tmp_path / "cells"))
    assert table.cells().isEmpty()
    rows = [
        ("r", "a", "x", "old", 1), ("r", "a", "x", "new", 2), ("r", "a", "y", "kept", 1), ("r", "b", "x", None, 3), ("q", "a", "x", "v", 1),
        ("q", "a", "x", "w", 1), (None, "a", "x", "keyless", 1), (None, "a", "x", "later", 2), ("r", None, "x", "no family", 1), ("r", "a", None, "no name", None),
    ]
    table.put(spark.createDataFrame(rows, CELL_SCHEMA))
    found = table.cells()
    assert "hashpartitioning(row_key#" in plan(found) and ", family" not in plan(found).split("hashpartitioning")[1].split(")")[0]
    expected = sorted(map(str, latest_cells(table.log()).collect()))
    assert sorted(map(str, found.collect())) == expected and len(expected) == 7
    monkeypatch.setattr(celltable, "MERGED_KINDS", 2)
    assert sorted(map(str, table.cells().collect())) == expected


def test_file_order_carries_no_paths(spark, tmp_path):
    path = str(tmp_path / "a b" / "tsv")
    spark.range(0, 400, 1, 12).select(F.col("id").cast("string").alias("code")).write.csv(path)
    rows = with_file_order(read_products_tsv(spark, path, "code string").filter("true")).orderBy("put_seq").collect()
    assert max(len(row["put_seq"]["file"]) for row in rows) <= 2
    # Every file loses its first line, the header.
    assert [int(row["code"]) for row in rows] == sorted(int(row["code"]) for row in rows)
    other = tmp_path / "a b" / "tsv" / "more.csv"
    other.write_text("code\nlast\n")
    longer = with_file_order(read_products_tsv(spark, path, "code string")).orderBy("put_seq").collect()
    assert longer[0]["code"] == "last" and longer[0]["put_seq"]["file"].endswith("/more.csv")


def test_the_order_of_numbered_files_is_two_numbers(spark, tmp_path):
    path = str(tmp_path / "tsv")
    spark.range(0, 400, 1, 12).select(F.col("id").cast("string").alias("code")).write.csv(path)
    rows = with_file_order(read_products_tsv(spark, path, "code string"), packed=True).orderBy("put_seq").collect()
    assert [int(row["code"]) for row in rows] == sorted(int(row["code"]) for row in rows) and len(rows) == 388
    assert {tuple(row["put_seq"].asDict()) for row in rows} == {("at", "row")} and len({row["put_seq"] for row in rows}) == 388
    # Splits of one file go by their offsets, however they are dealt to tasks.
    spark.range(0, 30_000, 1, 1).select(F.format_string("%08d", "id").alias("code")).write.csv(f"{path}-one")
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for name in before:
            spark.conf.set(name, "20000")
        split = with_file_order(read_products_tsv(spark, f"{path}-one", "code string"), packed=True)
        assert split.rdd.getNumPartitions() > 4
        assert [row["code"] for row in split.orderBy("put_seq").collect()] == [f"{i:08d}" for i in range(1, 30_000)]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    (tmp_path / "tsv" / "more.csv").write_text("code\nlast\n")
    longer = with_file_order(read_products_tsv(spark, path, "code string"), packed=True).orderBy("put_seq").collect()
    assert longer[0]["code"] == "last" and longer[0]["put_seq"]["file"].endswith("/more.csv")


def test_content_is_found_as_by_stripping_every_sort_of_white_space(spark):
    signs = [chr(i) for i in (*range(0x100), 0x1680, 0x2003, 0x2028, 0x3000, 0xFEFF, 0x6771, 0x1F600)]
    texts = [None, "", *signs, *(f" {a}" for a in signs), *(f" {a} {b}" for a in "\t\x1f\xa0 " for b in signs), "a ", "  ~", "\x7f"]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").coalesce(1).select("text", columns.has_content(F.col("text")).alias("found"))
    found = [(row["text"], row["found"]) for row in rows.collect()]
    assert found == [(text, bool(text) and bool(text.strip(columns.WHITE_SPACE))) for text in texts]
    # A printable sign settles it before all kinds of white space are searched for.
    condition = plan(rows)
    assert 0 < condition.index("ltrim(text") < condition.index("(trim(text")


def test_the_kind_of_a_cell_is_found_once(spark):
    cells = spark.createDataFrame([("r", f"f{i % 3}", str(i), "v", i) for i in range(12)], CELL_SCHEMA)
    merged = latest_of_kinds(cells, [(f"f{i % 3}", str(i)) for i in range(12)])
    assert merged.count() == 12
    # Not in each of the twelve greatest puts, which compare a number.
    partial = plan(merged).split("partial_max(", 1)[1].split("output=")[0]
    assert "family" not in partial and partial.count("kind#") == 12


def test_the_notes_of_a_put_are_one_small_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(celltable, "FILE_CELLS", 100)
    table = CellTable(spark, str(tmp_path / "cells"))
    table.put(puts(spark, 3_000, "1"), ordered=True)
    table.put(puts(spark, 0, "1"), ordered=True)
    rows = [(None, "f", "q", "v", 1), (None, "f", "r", "v", 1), ("a", "f", "q", "v", 1)]
    table.put(spark.createDataFrame(rows, CELL_SCHEMA).coalesce(1), ordered=True)
    assert len(list((tmp_path / f"cells{celltable.RANGES}").glob("part-*"))) <= 3
    cells = spark.read.parquet(table.path).groupBy(F.substring_index(F.input_file_name(), "/", -1))
    expected = cells.agg(F.min("row_key"), F.max("row_key"), F.count_distinct("row_key")).collect()
    found = table._ranges().select("file", "first_key", "last_key", "keys").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(tuple(row)) for row in expected if "null" not in str(row)) and len(found) >= 31
