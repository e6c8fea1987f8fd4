"""KMeans whose result depends on rows and keys alone, not on how they are laid out (M4).

Spark's own k-means|| draws its candidates by partition and position, so the same rows in another layout give other
clusters. Here a row is drawn by comparing a hash of its key with its share of the cost. Seeding and iterations run
over whatever partitions the input has; sums differ in their last bits at most.

The passes are Spark's: a model made of the current centres assigns the rows, and a vector summary per cluster
gives the next ones. What reaches the driver is k means per pass and, once, the drawn candidates, 2 k a round
on average.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasMaxIter, HasPredictionCol, HasSeed, HasTol
from pyspark.ml.stat import Summarizer
from pyspark.mllib.common import _py2java
from pyspark.mllib.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions.columns import quoted

#: Rounds of drawing candidates, and how often a drawn candidate set is improved before k of it are chosen.
ROUNDS = 2
LOCAL_ITERATIONS = 30
_BITS = 1 << 52


def model_of(spark: SparkSession, centres: Sequence[Sequence[float]], features: str, prediction: str) -> KMeansModel:
    """A model with exactly these centres, in this order."""
    jvm = spark.sparkContext._jvm.org.apache.spark
    vectors = _py2java(spark.sparkContext, [Vectors.dense([float(x) for x in centre]) for centre in centres])
    java = jvm.ml.clustering.KMeansModel(f"kmeans_{uuid.uuid4().hex[:12]}", jvm.mllib.clustering.KMeansModel(vectors))
    return KMeansModel(java).setFeaturesCol(features).setPredictionCol(prediction)


def unit_hash(key: Column, seed: int, step: int) -> Column:
    """A number in [0, 1) that follows from key, seed and step."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(step)), F.lit(_BITS)) / F.lit(float(_BITS))


def _distance(features: Column, centre: Column) -> Column:
    """Squared distance of a vector to an array."""
    squares = F.zip_with(vector_to_array(features), centre, lambda x, at: (x - at) * (x - at))
    return F.aggregate(squares, F.lit(0.0), lambda total, square: total + square)


def chosen_seeds(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of the candidates by weighted k-means++, moved to the weighted means of what is nearest to them."""
    draws = np.random.default_rng(seed)

    def distances(centres: np.ndarray) -> np.ndarray:
        return ((candidates[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)

    chosen = [int(draws.choice(len(candidates), p=weights / weights.sum()))]
    nearest = distances(candidates[chosen])[:, 0]
    while len(chosen) < k and (weights * nearest).sum() > 0:
        chosen.append(int(draws.choice(len(candidates), p=weights * nearest / (weights * nearest).sum())))
        nearest = np.minimum(nearest, distances(candidates[chosen[-1:]])[:, 0])
    centres = candidates[chosen]
    for _ in range(LOCAL_ITERATIONS):
        nearest = distances(centres).argmin(axis=1)
        moved = centres.copy()
        for i in np.unique(nearest):
            own = nearest == i
            if weights[own].sum():
                moved[i] = np.average(candidates[own], axis=0, weights=weights[own])
        if (moved == centres).all():
            break
        centres = moved
    return np.unique(centres, axis=0)


class KeyedKMeans(Estimator, HasFeaturesCol, HasPredictionCol, HasSeed, HasMaxIter, HasTol):
    """Estimator of a ``KMeansModel``. Rows are told apart by ``keyCol``; the input is read once per pass."""

    k = Param(Params._dummy(), "k", "number of clusters, above 1", TypeConverters.toInt)
    keyCol = Param(Params._dummy(), "keyCol", "column of the unique key", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, k=2, seed=0, maxIter=20, tol=1e-4, keyCol="code", featuresCol="features", predictionCol="prediction"
    ):
        super().__init__()
        self._setDefault(k=2, seed=0, maxIter=20, tol=1e-4, keyCol="code")
        self._set(**self._input_kwargs)

    def _nearest(self, rows: DataFrame, centres: np.ndarray) -> DataFrame:
        """``rows`` with ``place`` of the nearest of the centres."""
        model = model_of(rows.sparkSession, centres.tolist(), self.getFeaturesCol(), "place")
        return model.transform(rows)

    def candidates(self, rows: DataFrame) -> np.ndarray:
        """Rows drawn by k-means||: the one of the least hash, then by their share of the cost, round by round."""
        key, features = quoted(self.getOrDefault(self.keyCol)).cast("string"), quoted(self.getFeaturesCol())
        own = F.struct(F.xxhash64(key, F.lit(self.getSeed())).alias("hash"), key.alias("key"))
        first = rows.agg(F.min_by(vector_to_array(features), own)).first()[0]
        drawn = np.array([first])
        for step in range(ROUNDS):
            listed = F.lit(drawn.tolist())
            costs = self._nearest(rows, drawn).select(
                key.alias("key"), features.alias("at"), _distance(features, F.get(listed, F.col("place"))).alias("cost")
            )
            total = costs.agg(F.sum("cost")).first()[0]
            if not total:
                break
            share = F.lit(2.0 * self.getOrDefault(self.k) / total) * F.col("cost")
            more = costs.filter(unit_hash(F.col("key"), self.getSeed(), step) < share).select(vector_to_array("at"))
            drawn = np.unique(np.array([*drawn.tolist(), *[row[0] for row in more.collect()]]), axis=0)
        return drawn

    def seeds(self, rows: DataFrame) -> np.ndarray:
        """The centres that iterations start from."""
        drawn, k = self.candidates(rows), self.getOrDefault(self.k)
        if len(drawn) <= k:
            return drawn
        counts = self._nearest(rows, drawn).groupBy("place").count().collect()
        weights = np.zeros(len(drawn))
        for row in counts:
            weights[row["place"]] = row["count"]
        return chosen_seeds(drawn, weights, k, self.getSeed() & 0xFFFFFFFF)

    def _fit(self, dataset: DataFrame) -> KMeansModel:
        rows = dataset.select(quoted(self.getOrDefault(self.keyCol)), quoted(self.getFeaturesCol()))
        centres = self.seeds(rows)
        mean = vector_to_array(Summarizer.mean(quoted(self.getFeaturesCol()))).alias("mean")
        for _ in range(self.getMaxIter()):
            moved = centres.copy()
            for row in self._nearest(rows, centres).groupBy("place").agg(mean).collect():
                moved[row["place"]] = row["mean"]
            shift = ((moved - centres) ** 2).sum(axis=1).max()
            centres = np.unique(moved, axis=0)
            if shift <= self.getTol() ** 2:
                break
        if len(centres) < 2:
            raise ValueError("KMeans needs at least 2 different rows")
        model = model_of(dataset.sparkSession, centres.tolist(), self.getFeaturesCol(), self.getPredictionCol())
        return model._set(k=len(centres), seed=self.getSeed(), maxIter=self.getMaxIter(), tol=self.getTol())
