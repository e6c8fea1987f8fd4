"""Helpers the operators share: reading tables, null-safe columns, code for the executors."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words as the mixing and scoring contracts define them.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string")) % modulus


def id_and_text(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns an operator needs, as ``id`` and ``text``, a null text being empty.

    Other columns, whatever their names, never enter an operator.
    """
    return documents.select(
        F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def all_equal(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality of equally named columns of two frames."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


_shared_with: set[str] = set()


def share_code(spark: SparkSession) -> None:
    """Send this package to the executors once, unless their Python finds it already."""
    root = Path(__file__).resolve().parents[2]
    found = [Path(p or ".").resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    context = spark.sparkContext
    if root in [*found, Path.cwd()] or context.applicationId in _shared_with:
        return
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="larder-code-"), "larder"), "zip", root, "larder"
    )
    context.addPyFile(archive)
    _shared_with.add(context.applicationId)
