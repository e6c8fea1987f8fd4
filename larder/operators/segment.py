"""Clustering operators: fit, assignment, silhouette, sizes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.common import _py2java
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import quoted, squared_distance
from larder.operators.kmeans import KeyedKMeans

UNROLLED_TERMS = 512


def require_rows(rows: int, clusters: int, kind: str = "usable") -> None:
    if rows < clusters:
        raise ValueError(f"KMeans needs at least {clusters} {kind} rows, got {rows}")


def kmeans(clusters: int, seed: int, max_iterations: int, key: str = "code") -> KeyedKMeans:
    """KMeans with Spark's defaults otherwise; rows are told apart by their key."""
    return KeyedKMeans(k=clusters, seed=seed, maxIter=max_iterations, keyCol=key, predictionCol="cluster")


def vectors_from_arrays(frame: DataFrame, arrays: str, output: str = "features") -> DataFrame:
    """Dense vectors from an array column, without a Python worker."""
    return frame.withColumn(output, array_to_vector(quoted(arrays).cast("array<double>")))


def centre_rows(model: KMeansModel) -> list[tuple[int, list[float]]]:
    """Cluster id and centre coordinates of a fitted model."""
    return [(i, [float(x) for x in centre]) for i, centre in enumerate(model.clusterCenters())]


def _listed_distances(point: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """Array of squared distances to centres that stay one literal."""
    listed = F.lit([[float(x) for x in centre] for centre in centres])
    return F.transform(
        listed,
        lambda centre: F.aggregate(
            F.zip_with(F.array(*point), centre, lambda x, at: (x - at) * (x - at)),
            F.lit(0.0),
            lambda total, square: total + square,
        ),
    )


def assign_to_centres(
    frame: DataFrame, columns: Sequence[str], centres: Sequence[Sequence[float]]
) -> DataFrame:
    """Add ``cluster`` and ``distance`` (squared) of the nearest centre.

    Ties go to the lowest id. Few centres become plain arithmetic in generated
    code; a long list stays one literal, because generated code of thousands of
    terms would not be compiled.
    """
    point = [quoted(name) for name in columns]
    if len(centres) * len(columns) <= UNROLLED_TERMS:
        distances = F.array(*[squared_distance(point, centre) for centre in centres])
    else:
        distances = _listed_distances(point, centres)
    measured = frame.select("*", distances.alias("_distances"))
    nearest = measured.select("*", F.array_min("_distances").alias("distance"))
    return nearest.select(
        "*", (F.array_position("_distances", F.col("distance")) - 1).cast("int").alias("cluster")
    ).drop("_distances")


def lloyd_step(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """New centre of every non-empty cluster: the mean of its members."""
    return assigned.groupBy("cluster").agg(*[F.avg(quoted(n)).alias(n) for n in columns])


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    """Members per non-empty cluster."""
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("count"))


def with_linear_scores(
    frame: DataFrame, point: Sequence[Column], weights: Sequence[Sequence[float]], offsets: Sequence[float], name: str
) -> DataFrame:
    """Add an array with ``weights`` x point + ``offsets``, by the matrix product of Spark's linear classifier."""
    context = frame.sparkSession.sparkContext
    rows, columns = len(weights), len(weights[0])
    matrix = DenseMatrix(rows, columns, [x for row in weights for x in row], isTransposed=True)
    java = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"scores_{uuid.uuid4().hex[:12]}", _py2java(context, matrix), _py2java(context, DenseVector(offsets)), rows, True
    )
    model = LogisticRegressionModel(java).setFeaturesCol("_point").setRawPredictionCol("_raw")
    model = model.setProbabilityCol("").setPredictionCol("")
    scored = model.transform(frame.withColumn("_point", array_to_vector(F.array(*point))))
    return scored.withColumn(name, vector_to_array("_raw")).drop("_point", "_raw")


def silhouette_scores(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``silhouette`` of every row, squared Euclidean.

    Mean distances to a whole cluster follow from its row count, coordinate sums
    and sum of squared norms, so no pair of rows is formed. These k sums come to
    the driver; the scoring itself is a projection, as plain arithmetic for few
    clusters and as a matrix product for many.
    """
    point = [quoted(name) for name in columns]
    norm = reduce(lambda a, b: a + b, [x * x for x in point])
    totals = (
        assigned.groupBy("cluster")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.avg(norm).alias("norm"),
            *[F.avg(x).alias(f"mean{i}") for i, x in enumerate(point)],
        )
        .orderBy("cluster")
        .collect()
    )
    if len(totals) < 2:
        raise ValueError("silhouette needs at least two clusters")

    # The mean squared distance to a cluster is the one to its mean plus its spread.
    means = [[row[f"mean{i}"] for i in range(len(columns))] for row in totals]
    spreads = [row["norm"] - sum(x * x for x in mean) for row, mean in zip(totals, means, strict=True)]
    # A row is at distance 0 from itself, hence rows / (rows - 1); a singleton
    # has no other member and scores 0.
    corrections = F.array(
        *[F.lit(None if row["rows"] == 1 else row["rows"] / (row["rows"] - 1)).cast("double") for row in totals]
    )
    ids = F.array(*[F.lit(row["cluster"]) for row in totals])
    own = F.col("_own").cast("int")
    placed = assigned.select("*", F.array_position(ids, F.col("cluster")).alias("_own"))
    if len(totals) * len(columns) <= UNROLLED_TERMS:
        distances = F.array(
            *[squared_distance(point, mean) + F.lit(spread) for mean, spread in zip(means, spreads, strict=True)]
        )
        measured = placed.select("*", distances.alias("_distances"))
        to = [F.col("_distances").getItem(i) for i in range(len(totals))]
        within = F.element_at("_distances", own)
        others = F.least(*[F.when(own != i + 1, distance) for i, distance in enumerate(to)])
    else:
        # The distance is the row's squared norm less a linear function of the row: one matrix product for all clusters.
        offsets = [-(sum(x * x for x in mean) + spread) for mean, spread in zip(means, spreads, strict=True)]
        doubled = [[2 * x for x in mean] for mean in means]
        measured = with_linear_scores(placed, point, doubled, offsets, "_distances")
        rest = F.concat(F.slice("_distances", F.lit(1), own - 1), F.slice("_distances", own + 1, F.lit(len(totals))))
        within, others = norm - F.element_at("_distances", own), norm - F.array_max(rest)
    compared = measured.select("*", (within * F.element_at(corrections, own)).alias("_in"), others.alias("_out"))
    a, b = F.col("_in"), F.col("_out")
    score = F.when(a < b, 1 - a / b).when(a > b, b / a - 1).otherwise(0.0)
    return compared.select("*", score.alias("silhouette")).drop("_distances", "_own", "_in", "_out")


def mean_silhouette(assigned: DataFrame, columns: Sequence[str]) -> DataFrame:
    return silhouette_scores(assigned, columns).agg(F.avg("silhouette").alias("silhouette"))


def evaluate_silhouette(assigned: DataFrame) -> float:
    """The same mean over a vector column of any width, by Spark's evaluator."""
    return ClusteringEvaluator(
        featuresCol="features",
        predictionCol="cluster",
        metricName="silhouette",
        distanceMeasure="squaredEuclidean",
    ).evaluate(assigned)
