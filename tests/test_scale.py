"""Plans and hot groups: what has to hold when the data is a million times larger."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from larder.operators.cells import cells_to_products, latest_cells, seed_products
from larder.operators.clean import clean_products, dedupe_by_key, usable_products
from larder.operators.prepare import FeatureProfile, apply_profile
from larder.operators.publish import check_predictions, prediction_counts
from larder.operators.segment import assign_to_centres, cluster_sizes, mean_silhouette, silhouette_scores
from larder.operators.text import word_count
from larder.plans.mart import ProductMart
from larder.schema import CELL_SCHEMA, FEATURE_SLOTS, PREPARED_SCHEMA, TABLE_LAYOUT
from larder.sources.folders import subfolders
from larder.sources.scratch import materialize, release, scratch_root, stored
from workload.inputs import raw_products

# The JVM does not compile methods above this many bytes of byte code.
HUGE_METHOD = 8000


def plan(frame) -> str:
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def method_sizes(frame) -> list[int]:
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    text = frame._jdf.queryExecution().explainString(mode)
    return [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def prepared(frame):
    features = TABLE_LAYOUT.features
    profile = FeatureProfile(
        {n: 1.5 for n in features}, {n: 2.5 for n in features}, {n: 3.5 for n in features}
    )
    return apply_profile(frame, profile)


def test_generated_code_stays_compilable(spark, sf_dir, static_plans):
    raw = raw_products(spark, sf_dir)
    clean = materialize(clean_products(raw, TABLE_LAYOUT), "clean")
    assigned = assign_to_centres(prepared(clean), FEATURE_SLOTS, [[float(k)] * 8 for k in range(4)])
    stored = materialize(assigned, "assigned")
    frames = {
        "usable": usable_products(raw, TABLE_LAYOUT),
        "clean": clean_products(raw, TABLE_LAYOUT),
        "prepared": prepared(clean),
        "assigned": assigned,
        "scored": silhouette_scores(stored, FEATURE_SLOTS),
        "mean of all in one": mean_silhouette(assigned, FEATURE_SLOTS),
    }
    for name, frame in frames.items():
        sizes = method_sizes(frame)
        assert sizes, name
        assert max(sizes) < HUGE_METHOD, (name, sizes)


def test_aggregates_reduce_before_the_shuffle(spark, sf_dir, static_plans):
    raw = raw_products(spark, sf_dir)
    cells = spark.createDataFrame([], CELL_SCHEMA)
    lines = spark.createDataFrame([("a",)], "value string")
    frames = {
        "dedupe": dedupe_by_key(raw),
        "latest": latest_cells(cells),
        "products": cells_to_products(cells),
        "seed": seed_products(raw.withColumn("put_seq", F.lit(1)), TABLE_LAYOUT),
        "words": word_count(lines),
        "sizes": cluster_sizes(raw.withColumn("cluster", F.length("code"))),
    }
    for name, frame in frames.items():
        text = plan(frame)
        shuffle = text.index("Exchange hashpartitioning")
        assert "partial_" in text[shuffle:], name


def test_statistics_read_only_the_measurements(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = [("k", "name", "category", *[1.0] * 8)]
    spark.createDataFrame(rows, PREPARED_SCHEMA).write.parquet(path)
    text = plan(spark.read.schema(PREPARED_SCHEMA).parquet(path).agg(F.avg("f0"), F.max("f3")))
    assert "ReadSchema: struct<f0:double,f3:double>" in text


def test_snapshot_filters_reach_the_scan(spark, tmp_path):
    mart = ProductMart(spark, str(tmp_path))
    rows = [(f"c{i}", "", "", *[1.0] * 8) for i in range(9)]
    mart.publish_snapshot(spark.createDataFrame(rows, PREPARED_SCHEMA), "v1")
    text = plan(mart.snapshot("v1").filter("code = 'c3'").select("code", "f2"))
    assert "EqualTo(code,c3)" in text
    assert "ReadSchema: struct<code:string,f2:double>" in text
    mart.publish("r", spark.createDataFrame([("c1", 1)], "code string, cluster int"), 0.5)
    assert "isnotnull(run_id" in plan(mart.results("r")).lower()
    assert "PartitionFilters: [isnotnull(run_id" in plan(mart.results("r"))


def hot_products(spark, rows=30_000):
    """Every third row has the key ``hot``."""
    ids = spark.range(rows).repartition(16)
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5000).cast("string"))
    texts = [
        (F.hash("id", F.lit(i)) % 120).cast("string").alias(name)
        for i, name in enumerate(TABLE_LAYOUT.features)
    ]
    return ids.select(
        key.alias("code"), F.lit("name").alias("product_name"), F.lit("").alias("categories"), *texts
    )


def test_a_hot_key_is_cleaned_like_any_other(spark):
    raw = hot_products(spark)
    found = {row["code"]: row for row in clean_products(raw, TABLE_LAYOUT).collect()}
    usable = usable_products(raw, TABLE_LAYOUT).collect()
    best: dict[str, tuple] = {}
    for row in usable:
        rank = tuple((v is not None, v) for v in tuple(row)[1:])
        if row["code"] not in best or rank < best[row["code"]]:
            best[row["code"]] = rank
    assert {code: tuple((v is not None, v) for v in tuple(row)[1:]) for code, row in found.items()} == best


def test_a_hot_key_sends_one_row_per_task(spark, static_plans):
    raw = hot_products(spark)
    frame = dedupe_by_key(raw)
    frame.collect()
    exchange = frame._jdf.queryExecution().executedPlan()
    while "Exchange" not in exchange.getClass().getSimpleName():
        exchange = exchange.children().head()
    sent = exchange.metrics().apply("shuffleRecordsWritten").value()
    keys = raw.select("code").distinct().count()
    # Each of the 16 tasks sends a key at most once; the hot third shrinks to 16 rows.
    assert sent <= 30_000 - 10_000 + 16
    assert sent >= keys


def test_a_hot_cell_and_a_hot_row_resolve(spark):
    puts = spark.range(20_000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.col("id").cast("string")).alias("row_key"),
        F.lit("f").alias("family"),
        F.when(F.col("id") % 2 == 0, "x").otherwise("y").alias("qualifier"),
        F.col("id").cast("string").alias("value"),
        F.col("id").alias("put_seq"),
    )
    hot = latest_cells(puts.repartition(8)).filter("row_key = 'hot'").collect()
    assert {(row["qualifier"], row["value"]) for row in hot} == {("x", "19998"), ("y", "19999")}


def test_a_hot_word_is_counted(spark):
    lines = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot HOT")).otherwise(F.concat(F.lit("w"), "id")).alias("value")
    )
    counts = word_count(lines).limit(2).collect()
    assert tuple(counts[0]) == ("hot", 6000)
    assert counts[1]["count"] == 1


def test_a_hot_duplicate_is_found_without_collecting_it(spark):
    predictions = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("code"),
        F.lit(1).alias("cluster"),
    )
    texts = [F.lit("").alias(name) for name in ("product_name", "categories")]
    products = predictions.select("code").distinct().select("code", *texts)
    assert tuple(prediction_counts(predictions, products).first()) == (9_000, 6_001, 0)
    with pytest.raises(ValueError, match="1 duplicate product codes: hot"):
        check_predictions(predictions, products)


def test_scratch_tables_go_to_the_shared_folder(spark, tmp_path, monkeypatch):
    assert scratch_root(spark).startswith("/tmp")

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, name, default):
            assert name == "spark.checkpoint.dir"
            return self.value

    class Cluster:
        conf = Conf("hdfs://shared/checkpoints/")

        class sparkContext:
            master = "spark://host:7077"
            applicationId = "app"
            given = None

            @classmethod
            def getCheckpointDir(cls):
                return cls.given

    assert scratch_root(Cluster) == "hdfs://shared/checkpoints"
    Cluster.conf = Conf(None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_root(Cluster)
    Cluster.sparkContext.given = "hdfs://set/later"
    assert scratch_root(Cluster) == "hdfs://set/later"


def test_scratch_tables_go_when_told_to(spark):
    folder = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}"
    frame = spark.range(9)
    kept, gone = materialize(frame, "stays"), materialize(frame, "goes")
    release(gone)
    with pytest.raises(RuntimeError), stored(frame, "goes") as held:
        assert held.count() == 9
        raise RuntimeError
    names = [name.rpartition("-")[0] for name in subfolders(spark, folder)]
    assert kept.count() == 9 and "stays" in names and "goes" not in names
    release(kept)
