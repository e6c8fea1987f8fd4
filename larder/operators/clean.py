"""Raw text products to typed, bounded, one-row-per-key products."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import (
    any_present,
    evaluated_once,
    locale_number,
    not_blank,
    quoted,
    within_bounds,
)
from larder.schema import FILE_LAYOUT, IDENTITY_COLUMNS, KEY, TEXT_COLUMNS, ProductLayout


def validate_columns(frame: DataFrame, layout: ProductLayout = FILE_LAYOUT) -> None:
    """Raise if a product column is missing, naming the missing ones in order."""
    missing = sorted(set(layout.columns) - set(frame.columns))
    if missing:
        raise ValueError(f"Input dataset is missing columns: {', '.join(missing)}")


def parse_measurements(frame: DataFrame, layout: ProductLayout = FILE_LAYOUT) -> DataFrame:
    """Read every measurement column as a number, unreadable text as null."""
    return frame.withColumns({name: locale_number(quoted(name)) for name in layout.features})


def bound_measurements(frame: DataFrame, layout: ProductLayout = FILE_LAYOUT) -> DataFrame:
    """Null out numbers that are NaN or outside their closed interval (P5)."""
    return frame.withColumns(
        {name: within_bounds(quoted(name), *limits) for name, limits in layout.bounds.items()}
    )


def dedupe_by_key(frame: DataFrame, key: str = KEY, order: Sequence[str] | None = None) -> DataFrame:
    """Keep the smallest row of every key, by ``order`` and then the other columns.

    Nulls sort first. As an aggregate the choice is made once per map task
    before the shuffle, so a key holding a third of all rows still sends only
    one row per task; a ranking window would ship and sort that key whole.
    """
    order = list(order or [])
    rest = [name for name in frame.columns if name != key]
    ranked = order + [name for name in rest if name not in order]
    survivor = F.min(F.struct(*[quoted(name) for name in ranked])).alias("survivor")
    return (
        frame.groupBy(quoted(key))
        .agg(survivor)
        .select(
            *[
                quoted(name) if name == key else F.col("survivor").getField(name).alias(name)
                for name in frame.columns
            ]
        )
    )


def usable_products(frame: DataFrame, layout: ProductLayout = FILE_LAYOUT) -> DataFrame:
    """Typed products that have a key and at least one valid measurement."""
    validate_columns(frame, layout)
    texts = [
        F.trim(quoted(name)).alias(name) if layout.trim_text else quoted(name)
        for name in TEXT_COLUMNS
    ]
    parsed = frame.filter(not_blank(quoted(KEY))).select(
        F.trim(quoted(KEY)).alias(KEY),
        *texts,
        *[locale_number(quoted(name)).alias(name) for name in layout.features],
    )
    bounded = {
        name: within_bounds(quoted(name), *limits) for name, limits in layout.bounds.items()
    }
    return parsed.select(*IDENTITY_COLUMNS, evaluated_once(bounded)).filter(
        any_present(quoted(name) for name in layout.features)
    )


def clean_products(frame: DataFrame, layout: ProductLayout = FILE_LAYOUT) -> DataFrame:
    """One typed row per product key.

    Rows are filtered before the key is made unique, so an unmeasured row never
    hides a measured one of the same key.
    """
    return dedupe_by_key(usable_products(frame, layout))
