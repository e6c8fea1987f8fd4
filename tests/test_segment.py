from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import larder.operators.segment as segment
from larder.operators.prepare import assemble
from larder.operators.segment import (
    assign_to_centres,
    centre_rows,
    cluster_sizes,
    evaluate_silhouette,
    kmeans,
    lloyd_step,
    mean_silhouette,
    silhouette_scores,
    vectors_from_arrays,
)


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        centre = (i % 4) * 10
        rows.append((f"{i:04d}", centre + rng.gauss(0, 1), rng.gauss(0, 1)))
    return spark.createDataFrame(rows, "code string, f0 double, f1 double").repartition(5)


def test_assignment_takes_the_nearest_centre_and_the_lowest_id_on_ties(spark):
    frame = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 2.1)], "code string, x double")
    found = assign_to_centres(frame, ["x"], [[0.0], [2.0], [2.0]]).orderBy("code").collect()
    assert [(r["cluster"], round(r["distance"], 6)) for r in found] == [(0, 0.0), (0, 1.0), (1, 0.01)]


def test_many_centres_give_the_same_assignment(points, monkeypatch):
    centres = [[float(k), float(k % 3)] for k in range(40)]
    unrolled = assign_to_centres(points, ["f0", "f1"], centres).collect()
    monkeypatch.setattr(segment, "UNROLLED_TERMS", 0)
    listed = assign_to_centres(points, ["f0", "f1"], centres).collect()
    assert sorted(map(tuple, unrolled)) == sorted(map(tuple, listed))


def test_fit_puts_every_row_at_its_nearest_centre_and_is_repeatable(points):
    def fit(frame):
        return kmeans(4, 42, 30).fit(assemble(frame, ["f0", "f1"]))

    model = fit(points)
    for partitions in (1, 8, 64):
        again = fit(points.repartition(partitions, "f1"))
        for (_, here), (_, there) in zip(centre_rows(model), centre_rows(again), strict=True):
            assert here == pytest.approx(there, rel=1e-12)
    assigned = model.transform(assemble(points, ["f0", "f1"]))
    centres = [centre for _, centre in centre_rows(model)]
    nearest = assign_to_centres(points, ["f0", "f1"], centres).select("code", F.col("cluster").alias("near"))
    assert assigned.join(nearest, "code").filter("cluster <> near").isEmpty()
    assert sum(row["count"] for row in cluster_sizes(assigned).collect()) == 400
    moved = {r["cluster"]: (r["f0"], r["f1"]) for r in lloyd_step(assigned, ["f0", "f1"]).collect()}
    for cluster, centre in centre_rows(model):
        assert moved[cluster] == pytest.approx(tuple(centre))


def test_silhouette_equals_the_definition_and_the_evaluator(spark):
    rng = random.Random(5)
    rows = [(str(i), rng.random(), rng.random(), i % 3) for i in range(60)] + [("alone", 9.0, 9.0, 7)]
    frame = spark.createDataFrame(rows, "code string, f0 double, f1 double, cluster int")

    def brute(row):
        distances: dict[int, list[float]] = {}
        for other in rows:
            if other[0] != row[0]:
                d = (row[1] - other[1]) ** 2 + (row[2] - other[2]) ** 2
                distances.setdefault(other[3], []).append(d)
        if row[3] not in distances:
            return 0.0
        own = sum(distances[row[3]]) / len(distances[row[3]])
        near = min(sum(d) / len(d) for c, d in distances.items() if c != row[3])
        return (near - own) / max(near, own)

    expected = {row[0]: brute(row) for row in rows}
    scored = silhouette_scores(frame, ["f0", "f1"])
    for row in scored.collect():
        assert row["silhouette"] == pytest.approx(expected[row["code"]], abs=1e-9)
    mean = mean_silhouette(frame, ["f0", "f1"]).first()["silhouette"]
    assert mean == pytest.approx(sum(expected.values()) / len(rows))
    assert mean == pytest.approx(evaluate_silhouette(assemble(frame, ["f0", "f1"])))


def test_silhouette_needs_two_clusters_and_few_enough(spark, points, monkeypatch):
    one = points.withColumn("cluster", F.lit(0))
    with pytest.raises(ValueError, match="at least two clusters"):
        mean_silhouette(one, ["f0", "f1"])
    many = points.withColumn("cluster", F.col("code").cast("int") % 3)
    def scores():
        return {row["code"]: row["silhouette"] for row in silhouette_scores(many, ["f0", "f1"]).collect()}

    unrolled = scores()
    monkeypatch.setattr(segment, "UNROLLED_TERMS", 4)
    assert scores() == pytest.approx(unrolled)


def test_many_clusters_of_many_columns_agree_with_the_evaluator(points):
    names = [f"x{i}" for i in range(64)]
    wide = points.select("*", *[(F.col("f0") * (i + 1) + F.col("f1") * (i % 3)).alias(n) for i, n in enumerate(names)])
    many = wide.withColumn("cluster", (F.col("code").cast("int") % 100).cast("int"))
    expected = segment.evaluate_silhouette(assemble(many, names))
    assert mean_silhouette(many, names).first()["silhouette"] == pytest.approx(expected, abs=1e-9)
    plan = silhouette_scores(many, names)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_separated_groups_score_near_one(points):
    grouped = points.withColumn("cluster", F.col("code").cast("int") % 4)
    assert mean_silhouette(grouped, ["f0", "f1"]).first()["silhouette"] > 0.9


def test_vectors_from_float_arrays(spark):
    frame = spark.createDataFrame([("a", [1.0, 2.0])], "code string, v array<float>")
    assert vectors_from_arrays(frame, "v").first()["features"].toArray().tolist() == [1.0, 2.0]


def test_seeds_are_the_same_rows_in_any_layout(points):
    vectors = assemble(points, ["f0", "f1"])
    estimator = kmeans(4, 7, 30)
    drawn = estimator.candidates(vectors)
    rows = {(r["f0"], r["f1"]) for r in points.collect()}
    assert 4 <= len(drawn) <= 60 and {tuple(x) for x in drawn.tolist()} <= rows
    for partitions in (1, 8, 64):
        again = vectors.repartition(partitions, "f1")
        assert (estimator.candidates(again) == drawn).all() and (estimator.seeds(again) == estimator.seeds(vectors)).all()
    other = kmeans(4, 8, 30).candidates(vectors)
    assert other.shape != drawn.shape or (other != drawn).any()


def test_fit_on_few_different_rows(spark):
    frame = spark.createDataFrame([(str(i), float(i % 2)) for i in range(9)], "code string, x double")
    vectors = assemble(frame, ["x"])
    assert sorted(c for _, (c,) in centre_rows(kmeans(4, 1, 5).fit(vectors))) == [0.0, 1.0]
    with pytest.raises(ValueError, match="2 different rows"):
        kmeans(3, 1, 5).fit(vectors.filter("x = 1"))


def test_fit_is_as_good_as_the_library_one(points):
    from pyspark.ml.clustering import KMeans

    vectors = assemble(points, ["f0", "f1"])

    def cost(model):
        centres = [centre for _, centre in centre_rows(model)]
        return assign_to_centres(points, ["f0", "f1"], centres).agg(F.sum("distance")).first()[0]

    assert cost(kmeans(4, 42, 30).fit(vectors)) <= 1.01 * cost(KMeans(k=4, seed=42, maxIter=30).fit(vectors))
