"""Operator 5: exact deduplication by skew-safe combining, with DataFrame functions only.

Equal texts meet in three steps, and every step groups by digest *and* full content, so a digest
collision can never merge two texts:

1. each task deduplicates what it reads (the partial aggregate; the salt is constant in a task),
2. salted digest groups merge: at most ``salts`` rows are left of a text, however often it occurs,
3. the salt winners combine into one row per text.

A hot text therefore sends one row per task to step 2 and one per salt to step 3. The decisions go
back to the rows by digest, without text; where step 3 has shown that a digest has several contents,
its rows are matched by content instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.tables import id_and_text
from larder.sources.scratch import materialize


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def text_groups(rows: DataFrame, salts: int) -> DataFrame:
    """One row per text of ``rows`` (id, text, digest): digest, text, keep_id, group_size."""
    salted = rows.withColumn("salt", F.spark_partition_id() % salts)
    merged = salted.groupBy("digest", "salt", "text").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n"))
    return merged.groupBy("digest", "text").agg(F.max("top").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """Per row: id column, ``keep_id``, ``group_size``, ``kept``, ``digest`` (binary).

    Texts are compared as they are. The row with the largest id of a group stays. Defined results:
    a null text counts as empty; a null id is below every id, and a group with null ids only has a
    null ``keep_id`` and keeps those rows; rows repeating an id with the same text count one by one
    in ``group_size`` and are all kept or all dropped, since nothing tells them apart; an empty table
    gives no rows. Further columns of ``documents`` are not read.
    """
    rows = id_and_text(documents, id_column, text_column).withColumn("digest", digest(F.col("text")))
    groups = text_groups(rows, salts)
    sizes = materialize(groups.select("digest", "keep_id", "group_size"), "exact-groups")
    collided = sizes.groupBy("digest").count().filter("count > 1").select("digest")

    bare = rows.select("id", "digest")
    if collided.isEmpty():
        decided = bare.join(sizes, "digest")
    else:
        collided = materialize(collided, "exact-collisions")
        plain = bare.join(collided, "digest", "left_anti").join(sizes, "digest")
        contents = groups.join(collided, "digest", "left_semi")
        compared = rows.join(collided, "digest", "left_semi").join(contents, ["digest", "text"])
        decided = plain.unionByName(compared.select(*plain.columns))
    return decided.select(
        F.col("id").alias(id_column),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def drop_exact_duplicates(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns."""
    kept = (
        exact_duplicates(documents, id_column, text_column)
        .filter("kept")
        .select(F.col(id_column).alias("__kept_id"), F.col("digest").alias("__kept_digest"))
        .distinct()
    )
    own = sha256(F.coalesce(documents[text_column], F.lit("")))
    same = documents[id_column].eqNullSafe(kept["__kept_id"]) & (own == kept["__kept_digest"])
    return documents.join(kept, same, "left_semi")
