"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Each product column as an expression over ``lineitem``. Both engines read the
# same text; {text} is the engine's name for its text type.
RAW_PRODUCT_COLUMNS = {
    "code": (
        "case when l_orderkey % 97 = 0 then '' when l_orderkey % 89 = 0 then null "
        "else ' ' || cast(l_orderkey * 10 + l_linenumber as {text}) || ' ' end"
    ),
    "product_name": "' ' || l_returnflag || ' item '",
    "categories": (
        "case when l_suppkey % 13 = 0 then null else l_linestatus || ',' || l_returnflag end"
    ),
    "energy_kcal_100g": (
        "case when l_partkey % 17 = 0 then 'NaN' else cast(l_partkey % 1100 as {text}) end"
    ),
    "fat_100g": "cast(l_suppkey as {text}) || ',' || cast(l_partkey % 10 as {text})",
    "saturated_fat_100g": (
        "case when l_linenumber = 3 then '' else cast(l_suppkey % 60 as {text}) || '.5' end"
    ),
    "carbohydrates_100g": "cast(cast(l_quantity as int) * 3 - 10 as {text})",
    "sugars_100g": (
        "case when l_linenumber = 2 then 'n/a' else cast(cast(l_quantity as int) as {text}) end"
    ),
    "fiber_100g": (
        "case when l_suppkey % 7 = 0 then '1,234,5' "
        "else '0,' || cast(l_partkey % 10 as {text}) end"
    ),
    "proteins_100g": "cast(cast(round(l_discount * 100) as int) as {text})",
    "salt_100g": "'0.0' || cast(cast(round(l_tax * 100) as int) as {text})",
}


RAW_PRODUCT_SOURCES = (
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


def raw_product_select(text: str) -> str:
    return ", ".join(
        f"{expression.format(text=text)} as {name}"
        for name, expression in RAW_PRODUCT_COLUMNS.items()
    )


def separated_points(text: str) -> list[str]:
    """Eight-dimensional points in four far groups, one point per ``lineitem`` row, as expressions."""
    group = "l_linenumber % 4"
    slots = [
        f"((({group}) * 7 + {i * 3}) % 5) * 20.0 + ((l_partkey * {i + 3} + l_suppkey) % 101 - 50) / 100.0"
        for i in range(8)
    ]
    return [
        f"cast(l_orderkey * 10 + l_linenumber as {text}) as code",
        *[f"cast({slot} as double) as f{i}" for i, slot in enumerate(slots)],
    ]


#: The given files hold one row group each, which one task would read and work on alone.
UNIQUE_KEYS = {
    "lineitem": ("l_orderkey", "l_linenumber"),
    "documents": ("doc_id",),
    "events": ("event_id",),
    "embeddings": ("vec_id",),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, its rows dealt to tasks by their unique key."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(*UNIQUE_KEYS[name])


def raw_products(spark: SparkSession, sf_dir: str, dealt: bool = True) -> DataFrame:
    """Dirty all-text products, one per ``lineitem`` row, in table spelling.

    Not ``dealt``, the rows lie as in the file, for work that begins with a shuffle of its own.
    """
    columns = [
        f"{expression.format(text='string')} as {name}"
        for name, expression in RAW_PRODUCT_COLUMNS.items()
    ]
    lineitem = table(spark, sf_dir, "lineitem") if dealt else spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lineitem.select(*RAW_PRODUCT_SOURCES).selectExpr(*columns)


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("text")
