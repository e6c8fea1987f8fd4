from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel

from larder.jobs import count_words, inspect_tables, seed, train_file, train_mart, train_table
from larder.operators.segment import vectors_from_arrays
from larder.plans.tables import CellTables
from larder.operators.prepare import fit_profile
from larder.plans.train import build_pipeline, train_prepared, train_products
from larder.sources.files import has_rows, read_lines, read_products_tsv, write_products_tsv
from larder.sources.outputs import read_metrics, read_predictions
from larder.schema import FILE_LAYOUT
from larder.operators.clean import clean_products


def test_training_from_a_file(spark, export_path, tmp_path):
    raw = read_products_tsv(spark, export_path)
    out = tmp_path / "out"
    run = train_products(raw, 4, 42, 10, str(out))
    assert (run.input_rows, run.usable_rows) == (42, 40)
    assert sum(run.cluster_sizes.values()) == 40
    assert -1.0 <= run.silhouette <= 1.0
    records = run.predictions.collect()
    assert [r["code"] for r in records] == sorted(r["code"] for r in records)
    assert len(records) == 40
    stored = read_predictions(spark, run.predictions_path, FILE_LAYOUT.features).collect()
    assert {(r["code"], r["cluster"]) for r in stored} == {(r["code"], r["cluster"]) for r in records}
    assert {r["code"]: r["energy-kcal_100g"] for r in stored}["1040"] == 286.0
    text = next(Path(run.metrics_path).glob("part-*.json")).read_text()
    keys = list(json.loads(text))
    assert keys == sorted(keys)
    metrics = read_metrics(spark, run.metrics_path).first()
    assert metrics["cluster_sizes"] == run.cluster_sizes
    assert metrics["silhouette_squared_euclidean"] == run.silhouette
    assert (metrics["cluster_count"], metrics["seed"], metrics["max_iterations"]) == (4, 42, 10)

    loaded = PipelineModel.load(run.model_path)
    again = loaded.transform(clean_products(raw)).select("code", "cluster").collect()
    assert {tuple(r) for r in again} == {(r["code"], r["cluster"]) for r in records}
    repeated = train_products(raw.repartition(5), 4, 42, 10)
    assert repeated.cluster_sizes == run.cluster_sizes
    assert {tuple(r) for r in repeated.predictions.collect()} == {tuple(r) for r in records}


def test_one_pipeline_fit_agrees(spark, export_path):
    clean = clean_products(read_products_tsv(spark, export_path))
    profile = fit_profile(clean, FILE_LAYOUT.features, exact=False)
    approximate = build_pipeline(profile, 2, 42, 10).fit(clean)
    assert approximate.transform(clean).select("cluster").distinct().count() == 2
    run = train_products(read_products_tsv(spark, export_path), 2, 42, 10, exact_median=False)
    assert sum(run.cluster_sizes.values()) == 40


def test_too_few_rows(spark, export_path):
    raw = read_products_tsv(spark, export_path).limit(2)
    with pytest.raises(ValueError, match="needs at least 3 usable rows, got 2"):
        train_products(raw, 3, 42, 5)


def test_training_from_ready_vectors(spark, tmp_path):
    rows = [(f"v{i:02d}", "", "", [10.0 * (i % 3) + i / 50, i / 20, 1.0]) for i in range(12)]
    schema = "code string, product_name string, categories string, vector array<double>"
    frame = vectors_from_arrays(spark.createDataFrame(rows, schema), "vector")
    run = train_prepared(frame, 3, 42, 10)
    assert (run.input_rows, run.usable_rows) == (12, 12)
    assert sum(run.cluster_sizes.values()) == 12
    assert run.predictions.count() == 12
    assert (run.model_path, run.predictions_path, run.metrics_path) == (None, None, None)
    assert run.metrics.first()["preprocessing_owner"] == "data-mart"
    stored = train_prepared(frame, 3, 42, 10, str(tmp_path / "o"), single_file=True)
    assert len(list(Path(stored.predictions_path).glob("part-*.json"))) == 1
    assert KMeansModel.load(stored.model_path).transform(frame).count() == 12
    with pytest.raises(ValueError, match="needs at least 13 prepared rows, got 12"):
        train_prepared(frame, 13, 42, 10)


def test_file_scan_reads_text_and_nulls(spark, tmp_path):
    path = tmp_path / "t.tsv"
    header = "\t".join(FILE_LAYOUT.columns)
    path.write_text(f'{header}\n 1 \t"a ""b"""\t\t1,5{chr(9) * 7}\n', encoding="utf-8")
    row = read_products_tsv(spark, str(path)).first()
    assert (row["code"], row["product_name"], row["categories"]) == (" 1 ", 'a "b"', None)
    assert row["energy-kcal_100g"] == "1,5"
    assert row["salt_100g"] is None
    write_products_tsv(read_products_tsv(spark, str(path)), str(tmp_path / "w"))
    assert read_products_tsv(spark, str(tmp_path / "w")).first() == row
    assert has_rows(read_products_tsv(spark, str(path)))
    (tmp_path / "l.txt").write_text("a b\n\nc", encoding="utf-8")
    assert [r["value"] for r in read_lines(spark, str(tmp_path / "l.txt")).collect()] == ["a b", "", "c"]


def test_jobs_end_to_end(spark, export_path, tmp_path, capsys):
    tables, mart = str(tmp_path / "tables"), str(tmp_path / "mart")
    seed.main(["--input", export_path, "--tables", tables])
    assert "Seeded 41 source rows" in capsys.readouterr().out
    seed.main(["--input", export_path, "--tables", tables])
    train_table.main(["--tables", tables, "--max-iterations", "5"])
    train_mart.main(["--tables", tables, "--mart", mart, "--max-iterations", "5"])
    train_file.main(["--input", export_path, "--max-iterations", "5", "--output", str(tmp_path / "o")])
    with pytest.raises(ValueError, match="needs at least 4 usable rows, got 3"):
        train_table.main(["--tables", tables, "--scan-limit", "3"])
    capsys.readouterr()
    inspect_tables.main(["--tables", tables])
    printed = capsys.readouterr().out
    assert "table raw holds 40 keys" in printed
    assert "table results holds 40 keys" in printed
    assert "table runs holds 2 keys" in printed
    assert printed.count(" is complete") == 1
    assert printed.count(" is failed") == 1
    inspect_tables.main(["--tables", tables, "--output", str(tmp_path / "statuses")])
    assert len(spark.read.csv(str(tmp_path / "statuses"), header=True).collect()) == 2
    with pytest.raises(SystemExit):
        train_table.main(["--tables", tables, "--clusters", "0"])
    with pytest.raises(RuntimeError, match="contains no products"):
        train_table.main(["--tables", str(tmp_path / "none")])


def test_snapshot_cells_and_pointer(spark, tmp_path, export_path):
    from larder.operators.prepare import prepare_products
    from larder.plans.tables import prepared_from_cells

    tables = CellTables(spark, str(tmp_path / "tables"))
    with pytest.raises(RuntimeError, match="no prepared version"):
        tables.current_version()
    tables.seed(read_products_tsv(spark, export_path))
    prepared = prepare_products(tables.raw_products())
    for version in ("v1", "v2"):
        tables.publish_prepared(prepared, version, 40, f"2024-{version}")
    assert tables.current_version() == ("v2", 40, "2024-v2")
    read = tables.prepared_products("v1")
    assert read.exceptAll(prepared_from_cells(tables.prepared.log(), "v1")).isEmpty()
    assert read.exceptAll(prepared).isEmpty() and prepared.exceptAll(read).isEmpty()
    counts = {row["table_name"]: row["rows"] for row in tables.row_counts().collect()}
    assert counts == {"raw": 40, "prepared": 80, "pointer": 1, "results": 0, "runs": 0}


def test_count_words_job(tmp_path, spark):
    (tmp_path / "w.txt").write_text("Café b, B\n_x b-a\n", encoding="utf-8")
    with pytest.raises(SystemExit):
        count_words.main(["--input", str(tmp_path / "w.txt")])
    count_words.main(["--input", str(tmp_path / "w.txt"), "--output", str(tmp_path / "c")])
    parts = sorted((tmp_path / "c").glob("part-*"))
    assert "".join(part.read_text() for part in parts) == "b\t3\n_x\t1\na\t1\ncaf\t1\n"
