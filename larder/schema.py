"""Column names, measurement bounds and explicit schemas of every table.

The two product layouts differ only in spelling and text handling: export files
use hyphens (``energy-kcal_100g``) and get their texts trimmed, the product
table uses underscores and keeps texts as stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KEY = "code"
TEXT_COLUMNS = ("product_name", "categories")
IDENTITY_COLUMNS = (KEY, *TEXT_COLUMNS)

# Measurement names with their closed valid intervals, in the
# order that also numbers the prepared columns f0..f7.
FILE_BOUNDS: dict[str, tuple[float, float]] = {
    "energy-kcal_100g": (0.0, 1000.0),
    "fat_100g": (0.0, 100.0),
    "saturated-fat_100g": (0.0, 100.0),
    "carbohydrates_100g": (0.0, 100.0),
    "sugars_100g": (0.0, 100.0),
    "fiber_100g": (0.0, 100.0),
    "proteins_100g": (0.0, 100.0),
    "salt_100g": (0.0, 100.0),
}


def qualifier(field: str) -> str:
    """Spelling of a product field as a cell qualifier."""
    return field.replace("-", "_")


@dataclass(frozen=True)
class ProductLayout:
    """Spelling and text handling of one raw product table."""

    bounds: dict[str, tuple[float, float]]
    trim_text: bool

    @property
    def features(self) -> list[str]:
        return list(self.bounds)

    @property
    def columns(self) -> list[str]:
        return [*IDENTITY_COLUMNS, *self.bounds]

    @property
    def raw_schema(self) -> T.StructType:
        return strings(*self.columns)


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


FILE_LAYOUT = ProductLayout(FILE_BOUNDS, trim_text=True)
TABLE_LAYOUT = ProductLayout(
    {qualifier(name): bounds for name, bounds in FILE_BOUNDS.items()}, trim_text=False
)

FEATURE_SLOTS = [f"f{i}" for i in range(len(FILE_BOUNDS))]

PREPARED_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in IDENTITY_COLUMNS]
    + [T.StructField(name, T.DoubleType()) for name in FEATURE_SLOTS]
)

PREDICTION_SCHEMA = T.StructType(
    [T.StructField(KEY, T.StringType(), False), T.StructField("cluster", T.IntegerType(), False)]
)

PREDICTION_RECORD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in IDENTITY_COLUMNS]
    + [T.StructField("cluster", T.IntegerType())]
)

CELL_SCHEMA = T.StructType(
    [
        T.StructField("row_key", T.StringType()),
        T.StructField("family", T.StringType()),
        T.StructField("qualifier", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("put_seq", T.LongType()),
    ]
)

POINTER_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("created_at", T.StringType()),
    ]
)

RUN_FIELDS = (
    "status",
    "started_at",
    "completed_at",
    "failed_at",
    "published_rows",
    "silhouette",
    "source",
)

RUN_EVENT_SCHEMA = T.StructType(
    [T.StructField("run_id", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in RUN_FIELDS]
    + [T.StructField("put_seq", T.LongType())]
)
