"""Validation and joining of predictions with products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import composite_key
from larder.schema import KEY, PREDICTION_SCHEMA

SHOWN_OFFENDERS = 5


def duplicate_codes(predictions: DataFrame) -> DataFrame:
    """Codes predicted more than once, with their number of predictions."""
    counted = predictions.groupBy(KEY).agg(F.count(F.lit(1)).alias("count"))
    return counted.filter(F.col("count") > 1)


def unknown_codes(predictions: DataFrame, products: DataFrame) -> DataFrame:
    """Codes predicted that no product has."""
    return predictions.select(KEY).distinct().join(products.select(KEY), KEY, "left_anti")


def prediction_counts(predictions: DataFrame, products: DataFrame) -> DataFrame:
    """One row: predictions, distinct codes, codes without a product.

    Only codes are shuffled, each once per task however often it repeats; the
    grouping also serves the join.
    """
    codes = predictions.groupBy(KEY).agg(F.count(F.lit(1)).alias("count"))
    known = products.select(KEY, F.lit(True).alias("known"))
    return codes.join(known, KEY, "left").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("predictions"),
        F.count(F.lit(1)).alias("codes"),
        F.count(F.when(F.col("known").isNull(), F.lit(1))).alias("unknown"),
    )


def joined_predictions(predictions: DataFrame, products: DataFrame) -> DataFrame:
    """Predictions in their stored types with the texts of their products; ``known`` is null without one.

    What does not fit a type, such as a text that is no whole number, becomes null.
    """
    typed = predictions.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in PREDICTION_SCHEMA])
    texts = products.select(KEY, "product_name", "categories", F.lit(True).alias("known"))
    return typed.join(texts, KEY, "left")


def check_joined(joined: DataFrame) -> int:
    """Number of predictions; an error that says how many are faulty, and names some of them."""
    per_code = joined.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("count"),
        F.count("cluster").alias("clusters"),
        F.count("known").alias("known"),
    )
    code = F.col(KEY)
    faults = {
        "rows without a product code or with a cluster that is no whole number": code.isNull()
        | (F.col("clusters") < F.col("count")),
        "duplicate product codes": F.col("count") > 1,
        "unknown product codes": code.isNotNull() & (F.col("known") == 0),
    }
    found = per_code.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        *[F.count_if(fault).alias(kind) for kind, fault in faults.items()],
    ).first()
    if found["total"] == 0:
        raise ValueError("nothing to publish: no predictions")
    for kind, fault in faults.items():
        if found[kind]:
            some = per_code.filter(fault).select(KEY).orderBy(KEY).limit(SHOWN_OFFENDERS).collect()
            named = ", ".join(str(row[KEY]) for row in some)
            more = " and more" if found[kind] > len(some) else ""
            raise ValueError(f"predictions have {found[kind]} {kind}: {named}{more}")
    return found["total"]


def check_predictions(predictions: DataFrame, products: DataFrame) -> int:
    """Number of predictions; an error if there are none or any is faulty."""
    return check_joined(joined_predictions(predictions, products))


def result_rows(joined: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Checked predictions tagged with the run."""
    return joined.select(
        composite_key(F.lit(run_id), F.col(KEY)).alias("result_key"),
        F.lit(run_id).alias("run_id"),
        F.col("cluster").cast("string").alias("cluster"),
        F.lit(created_at).alias("created_at"),
        "product_name",
        "categories",
    )
