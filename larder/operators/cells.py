"""Wide-column tables as long-form cells.

A cell is ``(row_key, family, qualifier, value, put_seq)``. Writing appends;
reading resolves every ``(row_key, family, qualifier)`` to its last put.
``put_seq`` may be of any type that Spark can order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larder.functions.columns import composite_key, has_content, quoted, stripped
from larder.schema import FILE_LAYOUT, KEY, TEXT_COLUMNS, ProductLayout, qualifier

Cell = tuple[str, str]  # family, qualifier

# Cells of a published prediction, by result column.
RESULT_CELLS: dict[str, Cell] = {
    "run_id": ("model", "run_id"),
    "cluster": ("model", "cluster"),
    "created_at": ("model", "created_at"),
    "product_name": ("info", "product_name"),
    "categories": ("info", "categories"),
}


def product_cells(layout: ProductLayout = FILE_LAYOUT) -> dict[str, Cell]:
    """Cell of every product field but the key: texts in info, measurements in nutrition."""
    texts = {name: ("info", name) for name in TEXT_COLUMNS}
    return texts | {name: ("nutrition", qualifier(name)) for name in layout.features}


def _last(value: Column, put_seq: Column | Sequence[Column], present: Column | None = None) -> Column:
    """The value put last, by one or several columns; of equal puts the greatest value, so that a retry agrees."""
    order = [put_seq] if isinstance(put_seq, Column) else put_seq
    put = F.struct(*[column.alias(f"put_seq{i}") for i, column in enumerate(order)], value.alias("value"))
    # max passes over nulls, so absent cells never win.
    return F.max(put if present is None else F.when(present, put)).getField("value")


def latest_cells(cells: DataFrame) -> DataFrame:
    """The last put of every cell.

    An aggregate, so a hot row key or cell is reduced before the shuffle.
    """
    return cells.groupBy("row_key", "family", "qualifier").agg(
        _last(F.col("value"), F.col("put_seq")).alias("value")
    )


def latest_of_kinds(cells: DataFrame, kinds: Sequence[tuple[str | None, str | None]]) -> DataFrame:
    """``latest_cells`` of cells that are all of the given kinds (family, qualifier).

    A row's cells travel as one record, so that key, family and qualifier are not shuffled for each.
    """
    if not kinds:
        return latest_cells(cells)
    # The kind is found once for each cell, not once for each cell and kind.
    kind = F.when(F.lit(False), -1)
    for i, (family, name) in enumerate(kinds):
        kind = kind.when(F.col("family").eqNullSafe(F.lit(family)) & F.col("qualifier").eqNullSafe(F.lit(name)), i)
    put = F.struct("put_seq", "value")
    merged = (
        cells.select("row_key", kind.alias("kind"), put.alias("put"))
        .groupBy("row_key")
        .agg(*[F.max(F.when(F.col("kind") == i, F.col("put"))).alias(f"put{i}") for i in range(len(kinds))])
    )
    entries = [
        F.struct(
            F.lit(family).cast("string").alias("family"),
            F.lit(name).cast("string").alias("qualifier"),
            F.col(f"put{i}.value").alias("value"),
            F.col(f"put{i}").isNotNull().alias("found"),
        )
        for i, (family, name) in enumerate(kinds)
    ]
    return merged.select("row_key", F.inline(F.array(*entries))).filter("found").drop("found")


def latest_fields(rows: DataFrame, key: str, fields: Sequence[str], put_seq: str) -> DataFrame:
    """The same merge on rows that carry several cells: per key, the last non-null of each field."""
    seq = quoted(put_seq)
    return rows.groupBy(quoted(key)).agg(
        *[_last(quoted(name), seq, quoted(name).isNotNull()).alias(name) for name in fields]
    )


def to_cells(
    rows: DataFrame, key: str, mapping: Mapping[str, Cell], put_seq: Column | None = None
) -> DataFrame:
    """One cell per mapped column that is neither null nor white space.

    Values keep their blanks. A projection: no shuffle.
    """
    entries = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(name).alias("qualifier"),
            quoted(column).cast("string").alias("value"),
        )
        for column, (family, name) in mapping.items()
    ]
    sequence = [] if put_seq is None else [put_seq.alias("put_seq")]
    return rows.select(
        quoted(key).alias("row_key"), F.inline(F.array(*entries)), *sequence
    ).filter(has_content(F.col("value")))


def from_cells(cells: DataFrame, key: str, mapping: Mapping[str, Cell]) -> DataFrame:
    """Flat rows from cells: last put of each mapped cell, null where there is none.

    Merge and pivot are one aggregation over one shuffle by row key.
    """
    wanted = {
        column: (F.col("family") == family) & (F.col("qualifier") == name)
        for column, (family, name) in mapping.items()
    }
    merged = cells.groupBy("row_key").agg(
        *[
            _last(F.col("value"), F.col("put_seq"), here).alias(column)
            for column, here in wanted.items()
        ]
    )
    return merged.withColumnRenamed("row_key", key)


def products_to_cells(
    products: DataFrame, layout: ProductLayout = FILE_LAYOUT, put_seq: Column | None = None
) -> DataFrame:
    return to_cells(products, KEY, product_cells(layout), put_seq)


def cells_to_products(cells: DataFrame, layout: ProductLayout = FILE_LAYOUT) -> DataFrame:
    return from_cells(cells, KEY, product_cells(layout))


def seed_products(
    raw: DataFrame, layout: ProductLayout = FILE_LAYOUT, put_seq: str = "put_seq"
) -> DataFrame:
    """Raw rows of a file as the table holds them after loading in put order.

    Rows without a key are skipped and keys trimmed; of several rows with one key each
    field keeps its last non-blank value. A row of nothing but a key leaves no
    cell and therefore no product.
    """
    mapping = product_cells(layout)
    kind = raw.schema[put_seq].dataType
    # An order of several parts lies beside the value, not in a record of its own.
    seq = [quoted(put_seq).getField(part) for part in kind.names] if isinstance(kind, StructType) else quoted(put_seq)
    keyed = raw.filter(has_content(quoted(KEY))).withColumn(KEY, stripped(quoted(KEY)))
    merged = keyed.groupBy(KEY).agg(
        *[_last(quoted(name), seq, has_content(quoted(name))).alias(name) for name in mapping]
    )
    return merged.filter(F.coalesce(*[quoted(name) for name in mapping]).isNotNull())


def seed_counts(layout: ProductLayout = FILE_LAYOUT) -> dict[str, Column]:
    """Aggregates over raw rows: those a load puts, and keyed rows it rejects for having no cell to put."""
    keyed = has_content(quoted(KEY))
    filled = reduce(or_, [has_content(quoted(name)) for name in product_cells(layout)])
    return {"seeded": F.count_if(keyed & filled), "rejected": F.count_if(keyed & ~filled)}


def last_of_first_keys(cells: DataFrame, limit: int) -> str | None:
    """The greatest of the ``limit`` smallest row keys, or none without cells; reads the keys alone."""
    keys = cells.select("row_key").filter(F.col("row_key").isNotNull()).distinct()
    return keys.orderBy("row_key").limit(limit).agg(F.max("row_key")).first()[0]


def first_rows(cells: DataFrame, limit: int) -> DataFrame:
    """All cells, as last put, of the ``limit`` smallest row keys (S4), of cells in no order.

    A stored table finds the last key from notes on its files: ``CellTable.scan``.
    """
    if limit <= 0:
        raise ValueError(f"a scan wants a positive limit, got {limit}")
    return latest_cells(cells.filter(F.col("row_key") <= F.lit(last_of_first_keys(cells, limit))))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct row keys per table (S17). Every row is counted, without a scan cap."""
    counts = [
        cells.agg(F.countDistinct("row_key").alias("rows")).select(
            F.lit(name).alias("table_name"), "rows"
        )
        for name, cells in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def run_statuses(run_cells: DataFrame) -> DataFrame:
    """Status per run, ``unknown`` where none was put."""
    rows = from_cells(run_cells, "run_id", {"status": ("run", "status")})
    return rows.select("run_id", F.coalesce("status", F.lit("unknown")).alias("status"))


def result_cells(predictions: DataFrame, run_id: str, created_at: str) -> DataFrame:
    """Cells of published predictions, keyed ``run_id:code``.

    Unlike products, empty texts are kept as cells.
    """
    text = {name: F.coalesce(quoted(name), F.lit("")) for name in TEXT_COLUMNS}
    values = {
        "run_id": F.lit(run_id),
        "cluster": F.col("cluster").cast("string"),
        "created_at": F.lit(created_at),
        **text,
    }
    entries = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(name).alias("qualifier"),
            values[column].alias("value"),
        )
        for column, (family, name) in RESULT_CELLS.items()
    ]
    return predictions.select(
        composite_key(F.lit(run_id), F.col(KEY)).alias("row_key"), F.inline(F.array(*entries))
    )
