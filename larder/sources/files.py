"""Text file scans (S1, S2) and the non-empty probe."""

from __future__ import annotations

from os.path import commonprefix

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TSV_OPTIONS = {
    "header": "true",
    "sep": "\t",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_products_tsv(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Tab-separated export: every field text, an empty field null.

    Records are single lines, so files split. Without a schema the column
    names come from the header line.
    """
    reader = spark.read.options(**TSV_OPTIONS, multiLine="false")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def write_products_tsv(frame: DataFrame, path: str) -> None:
    """Counterpart of the scan; keeps leading and trailing blanks."""
    frame.write.mode("overwrite").options(**TSV_OPTIONS, emptyValue="").csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per text line, column ``value``."""
    return spark.read.text(path)


#: Bits of an offset in a file, below those of the file's number.
OFFSET_BITS = 43


def _file_place(frame: DataFrame) -> tuple[Column, bool]:
    """The path of a row's file, or as little of it as orders the files alike: it travels with every value of a merge.

    Names of one folder that are equally long differ between their common beginning and their common end. Also says
    whether that is a number of six digits at most, or nothing.
    """
    path, paths = F.col("_metadata.file_path"), set(frame.inputFiles())
    names = sorted(at.rpartition("/")[2] for at in paths)
    if len({at.rpartition("/")[0] for at in paths}) != 1 or len({len(name) for name in names}) != 1:
        return path, False
    start = len(commonprefix(names))
    end = len(commonprefix([name[start:][::-1] for name in names]))
    differing = [name[start : len(name) - end] for name in names]
    numbers = all(len(part) <= 6 and set(part) <= set("0123456789") for part in differing)
    return F.substring(F.substring_index(path, "/", -1), start + 1, len(names[0]) - start - end), numbers


def with_file_order(frame: DataFrame, name: str = "put_seq", packed: bool = False) -> DataFrame:
    """Tag the rows of a file scan with their order of appearance.

    Files go by name, splits of a file by offset, rows of a split by the
    ascending row id Spark gives within a task. Must directly follow the scan.
    ``packed``: the file and the offset as one number where files are told apart by numbers.
    """
    (file, numbers), offset, row = _file_place(frame), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("row")
    if packed and numbers:
        number = F.coalesce(file.try_cast("long"), F.lit(0))  # a single file has no number
        order = F.struct((F.shiftleft(number, OFFSET_BITS) + offset).alias("at"), row)
    else:
        order = F.struct(file.alias("file"), offset.alias("offset"), row)
    return frame.withColumn(name, order)


def has_rows(frame: DataFrame) -> bool:
    return not frame.isEmpty()
