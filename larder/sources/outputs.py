"""Training outputs: predictions, metrics, model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import quoted
from larder.schema import IDENTITY_COLUMNS, KEY, PREDICTION_RECORD_SCHEMA
from larder.sources.folders import file_scans
from larder.sources.scratch import stored

ALGORITHM = "pyspark.ml.clustering.KMeans"

METRICS_SCHEMA = T.StructType(
    [
        T.StructField("algorithm", T.StringType()),
        T.StructField("cluster_count", T.IntegerType()),
        T.StructField("cluster_sizes", T.MapType(T.IntegerType(), T.LongType())),
        T.StructField("input_rows", T.LongType()),
        T.StructField("max_iterations", T.IntegerType()),
        T.StructField("preprocessing_owner", T.StringType()),
        T.StructField("seed", T.LongType()),
        T.StructField("silhouette_squared_euclidean", T.DoubleType()),
        T.StructField("usable_rows", T.LongType()),
    ]
)


def assignments(predictions: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """Key, texts, requested features and cluster, in no order: a projection."""
    names = [*IDENTITY_COLUMNS, *features]
    return predictions.select(
        *[quoted(name) for name in names], F.col("cluster").cast("int").alias("cluster")
    )


def prediction_records(predictions: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """The same ordered by key."""
    return assignments(predictions, features).orderBy(KEY)


def record_schema(features: Sequence[str] = ()) -> T.StructType:
    identity, cluster = PREDICTION_RECORD_SCHEMA.fields[:-1], PREDICTION_RECORD_SCHEMA.fields[-1]
    return T.StructType([*identity, *[T.StructField(n, T.DoubleType()) for n in features], cluster])


def write_predictions(
    predictions: DataFrame, path: str, features: Sequence[str] = (), single_file: bool = False
) -> None:
    """Records as JSON lines in key order across the part files.

    ``single_file`` (O4): one task writes the file, which sets its time. The records are sorted and stored by all
    tasks before; that one passes them on, file by file, and holds none.
    """
    records = prediction_records(predictions, features)
    if not single_file:
        records.write.mode("overwrite").json(path)
        return
    with stored(records, "records") as ordered:
        in_one_task(ordered).write.mode("overwrite").json(path)


def in_one_task(ordered: DataFrame) -> DataFrame:
    """Rows of a table stored in order, in this order in one partition, without sorting them again.

    One scan takes large files before small ones, hence a scan for every file.
    """
    return file_scans(ordered, 1).coalesce(1)


def read_predictions(spark: SparkSession, path: str, features: Sequence[str] = ()) -> DataFrame:
    return spark.read.schema(record_schema(features)).json(path)


def metrics_row(spark: SparkSession, **found: object) -> DataFrame:
    """Parameters and measurements of one training; what is not given stays null."""
    row = tuple({"algorithm": ALGORITHM, **found}.get(name) for name in METRICS_SCHEMA.names)
    return spark.createDataFrame([row], METRICS_SCHEMA)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """One JSON object with its fields in alphabetical order."""
    columns = [quoted(name) for name in sorted(metrics.columns)]
    metrics.select(*columns).coalesce(1).write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    # JSON knows text keys only.
    stored = T.StructType(
        [
            T.StructField(f.name, T.MapType(T.StringType(), T.LongType()))
            if isinstance(f.dataType, T.MapType)
            else f
            for f in METRICS_SCHEMA
        ]
    )
    sizes = F.transform_keys("cluster_sizes", lambda cluster, _: cluster.cast("int"))
    return spark.read.schema(stored).json(path).withColumn("cluster_sizes", sizes)


def save_model(model: MLWritable, path: str) -> None:
    """Replace the saved model at the path."""
    model.write().overwrite().save(path)
