from __future__ import annotations

import re
from pathlib import Path

import pytest

import larder.plans.mart
from larder.plans.mart import NoSnapshot, ProductMart, VersionMismatch, utc_now
from larder.schema import PREDICTION_SCHEMA, PREPARED_SCHEMA, RUN_EVENT_SCHEMA, TABLE_LAYOUT
from larder.sources.folders import subfolders
from larder.sources.scratch import scratch_root


def prepared(spark, count, mark=""):
    rows = [(f"c{i:05d}", f"Item {i}{mark}", "", *[float(i + j) for j in range(8)]) for i in range(count)]
    return spark.createDataFrame(rows, PREPARED_SCHEMA).repartition(7)


def predict(spark, *codes):
    return spark.createDataFrame([(code, len(code) % 4) for code in codes], PREDICTION_SCHEMA)


@pytest.fixture
def mart(spark, tmp_path):
    return ProductMart(spark, str(tmp_path / "mart"))


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """1200 products as the current version v2, after a version v1 of 900."""
    monkeypatch = pytest.MonkeyPatch()
    monkeypatch.setattr(larder.plans.mart, "ROWS_PER_SMALL_FILE", 100)
    mart = ProductMart(spark, str(tmp_path_factory.mktemp("mart")))
    mart.publish_snapshot(prepared(spark, 900, "a"), "v1", "2024-01-01T00:00:00.000000Z")
    mart.publish_snapshot(prepared(spark, 1200, "b"), "v2", "2024-01-02T00:00:00.000000Z")
    monkeypatch.undo()
    return mart


def test_nothing_published_yet(mart):
    with pytest.raises(NoSnapshot, match="no snapshot"):
        mart.current()
    with pytest.raises(NoSnapshot):
        mart.page(0, 10)
    assert mart.runs().isEmpty()
    assert mart.results().isEmpty()


def test_refresh_from_raw_products(mart, spark):
    rows = [(str(i), f"P{i}", None, *[str(i + j) for j in range(8)]) for i in range(5)]
    raw = spark.createDataFrame(rows, TABLE_LAYOUT.raw_schema)
    snapshot = mart.refresh(raw, "first")
    assert snapshot.count == 5
    assert mart.current() == snapshot
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z", snapshot.created_at)


def test_versions_stay_apart_and_the_newest_is_current(filled):
    assert filled.current().version == "v2"
    assert filled.current().count == 1200
    pinned, rows = filled.read_current()
    assert (pinned.version, rows.count()) == ("v2", 1200)
    old = filled.snapshot("v1")
    assert old.count() == 900
    assert old.filter("product_name not like '%a'").isEmpty()
    assert old.filter("f7 - f0 <> 7").isEmpty()


def test_a_version_is_published_once_and_needs_a_plain_name(filled, spark):
    with pytest.raises(ValueError, match="version exists"):
        filled.publish_snapshot(prepared(spark, 1), "v1")
    with pytest.raises(ValueError, match="version may hold"):
        filled.publish_snapshot(prepared(spark, 1), "../v3")


def test_freshness(filled):
    filled.require_current(filled.current())
    older = type(filled.current())("v1", 900, "2024-01-01T00:00:00.000000Z")
    with pytest.raises(VersionMismatch):
        filled.require_current(older)


def test_pages_concatenate_to_the_whole_version(filled):
    assert filled._ranges("v2").count() > 3
    seen = []
    for offset in range(0, 1300, 130):
        page = filled.page(offset, 130).collect()
        assert [row["row_number"] for row in page] == list(range(offset + 1, offset + 1 + len(page)))
        seen += [row["code"] for row in page]
    assert seen == [f"c{i:05d}" for i in range(1200)]


def test_page_columns_and_edges(filled):
    page = filled.page(1195, 5000)
    rows = page.collect()
    assert len(rows) == 5
    assert {(r["version"], r["total"], r["offset"], r["limit"]) for r in rows} == {("v2", 1200, 1195, 1000)}
    assert filled.page(1200, 10).isEmpty()
    assert filled.page(10**9, 10).isEmpty()
    assert len(filled.page(0, 1).collect()) == 1
    with pytest.raises(ValueError, match="offset must not be negative"):
        filled.page(-1, 10)
    with pytest.raises(ValueError, match="limit must be positive"):
        filled.page(0, 0)


def test_a_page_reads_only_the_files_that_hold_it(filled):
    assert len(filled.page(600, 2).inputFiles()) <= 2
    assert len(filled.snapshot("v2").inputFiles()) > 3


def test_publishing_joins_and_commits_with_the_run_row(filled, spark):
    published = filled.publish("r1", predict(spark, "c00001", "c00002"), 0.25, "2024-02-01T00:00:00.000000Z")
    assert published == 2
    rows = {row["result_key"]: row for row in filled.results("r1").collect()}
    assert set(rows) == {"r1:c00001", "r1:c00002"}
    assert rows["r1:c00001"]["product_name"] == "Item 1b"
    assert rows["r1:c00001"]["cluster"] == "2"
    run = filled.runs().filter("run_id = 'r1'").first()
    assert (run["status"], run["published_rows"], run["silhouette"]) == ("complete", "2", "0.25")
    again = filled.publish("r1", predict(spark, "c00003"), 0.5)
    assert again == 1
    assert [row["result_key"] for row in filled.results("r1").collect()] == ["r1:c00003"]


def test_publishing_against_the_trained_version(filled, spark):
    filled.publish("r2", predict(spark, "c00007"), 0.5, version="v1")
    assert filled.results("r2").first()["product_name"] == "Item 7a"
    with pytest.raises(ValueError, match="unknown"):
        filled.publish("r3", predict(spark, "c01000"), 0.5, version="v1")


@pytest.mark.parametrize(
    "codes,message",
    [
        ([], "nothing to publish"),
        (["c00001", "c00001"], "duplicate product codes: c00001"),
        (["c00001", "x"], "1 unknown product codes: x"),
    ],
)
def test_faulty_predictions_publish_nothing(filled, spark, codes, message):
    with pytest.raises(ValueError, match=message):
        filled.publish("bad", predict(spark, *codes), 0.5)
    assert filled.results("bad").isEmpty()
    assert filled.runs().filter("run_id = 'bad'").isEmpty()


def test_null_and_textual_clusters_are_refused(filled, spark):
    for cluster in (None, "x"):
        rows = spark.createDataFrame([("c00001", cluster)], "code string, cluster string")
        with pytest.raises(ValueError, match="1 rows without a product code or with a cluster"):
            filled.publish("bad", rows, 0.5)
    assert filled.runs().filter("run_id = 'bad'").isEmpty()


def test_a_retry_that_fails_midway_changes_nothing(filled, spark, monkeypatch):
    filled.publish("r1", predict(spark, "c00001"), 0.25)

    def broken(*_, **__):
        raise RuntimeError("boom")

    monkeypatch.setattr(ProductMart, "put_run", broken)
    with pytest.raises(RuntimeError, match="boom"):
        filled.publish("r1", predict(spark, "c00002"), 0.5)
    assert [row["result_key"] for row in filled.results("r1").collect()] == ["r1:c00001"]
    assert filled.runs().filter("run_id = 'r1'").first()["silhouette"] == "0.25"


def test_times_of_mixed_width_are_ordered_as_times(mart, spark):
    mart.publish_snapshot(prepared(spark, 3), "early", "2030-01-01T00:00:00Z")
    mart.publish_snapshot(prepared(spark, 3), "late", "2030-01-01T00:00:00.500Z")
    assert mart.current().version == "late"
    with pytest.raises(ValueError):
        mart.publish_snapshot(prepared(spark, 3), "odd", "yesterday")


def test_pages_of_a_version_end_with_it(mart, spark):
    mart.publish_snapshot(prepared(spark, 4), "v1")
    assert mart.page(0, 2, "v1").count() == 2
    mart.publish_snapshot(prepared(spark, 4), "newer")
    with pytest.raises(VersionMismatch, match="newer is current"):
        mart.page(2, 2, "v1")


def test_a_run_needs_an_id_and_known_fields(filled, spark):
    with pytest.raises(ValueError, match="wants a run id"):
        filled.publish("", predict(spark, "c00001"), 0.5)
    with pytest.raises(ValueError, match="no such run fields: state"):
        filled.put_run("r", state="x")
    with pytest.raises(ValueError, match="at least one field"):
        filled.put_run("r")


def test_run_lifecycle(mart, spark):
    mart.publish_snapshot(prepared(spark, 3), "v1")
    with mart.tracked_run("good"):
        assert mart.runs().first()["status"] == "running"
        mart.publish("good", predict(spark, "c00001"), 0.5)
    with pytest.raises(RuntimeError, match="boom"), mart.tracked_run("bad"):
        raise RuntimeError("boom")
    runs = {row["run_id"]: row for row in mart.runs().collect()}
    assert runs["good"]["status"] == "complete"
    assert runs["good"]["started_at"] <= runs["good"]["completed_at"]
    assert runs["bad"]["status"] == "failed"
    assert runs["bad"]["failed_at"] is not None
    assert runs["bad"]["published_rows"] is None


def test_file_count_follows_the_rows(mart):
    assert [mart._file_count(rows) for rows in (0, 40, 25_000, 10**6, 10**8 + 1)] == [1, 1, 3, 8, 101]


def test_times_have_one_width():
    assert len({len(utc_now()) for _ in range(50)}) == 1


def test_a_lookup_of_one_run_opens_one_folder(spark, tmp_path):
    mart = ProductMart(spark, str(tmp_path / "mart"))
    names = [f"run-{i}" for i in range(200)]
    events = [(name, "running", *[None] * 6, i) for i, name in enumerate(names)]
    mart.put_run_events(spark.createDataFrame(events, RUN_EVENT_SCHEMA))
    mart.put_run("run-7", 1000, status="complete", silhouette="0.5")
    found = mart.runs("run-7")
    assert (found.first()["status"], found.count()) == ("complete", 1)
    assert {Path(path).parent.name for path in found.inputFiles()} == {f"bucket={mart._bucket_of('run-7')}"}
    assert len({Path(path).parent.name for path in mart.runs().inputFiles()}) > 40
    assert mart.runs("nobody").isEmpty()


def test_folded_runs_say_the_same(spark, tmp_path):
    mart = ProductMart(spark, str(tmp_path / "mart"))
    assert mart.fold_runs() == 0
    for i in range(6):
        mart.put_run("a", i, status=f"s{i}")
    mart.put_run("a", 2, silhouette="0.1")
    mart.put_run("b", 1, status="running", started_at="t")
    before = sorted(map(tuple, mart.runs().collect()))
    assert mart.fold_runs() == 4
    assert sorted(map(tuple, mart.runs().collect())) == before
    assert mart.fold_runs() == 0 and sorted(map(tuple, mart.runs().collect())) == before
    mart.put_run("a", 9, status="complete")
    assert mart.runs("a").first()["status"] == "complete" and mart.runs("a").first()["silhouette"] == "0.1"


def test_a_retry_leaves_no_folders_behind(filled, spark, monkeypatch):
    """Attempts that stored rows and then failed are removed, the one that counts stays; scratch tables go."""
    run_id, put = "retried: by hand", ProductMart.put_run

    def fails(*args, **fields):
        raise OSError("no run row")

    for _ in range(2):
        monkeypatch.setattr(ProductMart, "put_run", fails)
        with pytest.raises(OSError):
            filled.publish(run_id, predict(spark, "c00003"), 0.5)
    monkeypatch.setattr(ProductMart, "put_run", put)
    assert filled.results(run_id).isEmpty()
    assert filled.publish(run_id, predict(spark, "c00003", "c00004"), 0.5) == 2
    (folder,) = [f"{filled.root}/results/{name}" for name in subfolders(spark, f"{filled.root}/results") if "retried" in name]
    assert len(subfolders(spark, folder)) == 3
    assert filled.remove_attempts(run_id) == 2 and len(subfolders(spark, folder)) == 1
    assert filled.results(run_id).count() == 2 and filled.remove_attempts(run_id) == 0
    scratch = subfolders(spark, f"{scratch_root(spark)}/{spark.sparkContext.applicationId}")
    assert not [name for name in scratch if name.startswith("joined-predictions")]
