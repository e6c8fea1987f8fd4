"""A cell table stored as an append-only Parquet log of puts, a folder for each."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions.columns import quoted
from larder.operators.cells import from_cells, last_of_first_keys, latest_cells, latest_of_kinds, to_cells
from larder.schema import CELL_SCHEMA
from larder.sources.folders import file_scans, subfolders

ORDERED, UNORDERED = "ordered-", "plain-"
#: Added to a table's path: where the key ranges of its files are noted.
RANGES = ".ranges"
#: Cells a file holds at most. Some ten cells of a row are merged before the shuffle by sorting what a task reads.
FILE_CELLS = 1 << 20
#: Kinds of cells up to which a table's rows are merged whole.
MERGED_KINDS = 24
#: Files a task reads of a table that has more files than that for every task.
TASK_FILES = 2
FILE_RANGE_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("put", "file", "first_key", "last_key")]
    + [T.StructField("keys", T.LongType())]
)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table below a path; without rows if there is none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


@dataclass(frozen=True)
class CellTable:
    spark: SparkSession
    path: str

    def log(self) -> DataFrame:
        """Every put; empty if the table was never written. A task reads a few files, however large the table."""
        return self._by_few_files(read_or_empty(self.spark, self.path, CELL_SCHEMA))

    def _by_few_files(self, cells: DataFrame) -> DataFrame:
        # Spark deals the files of a scan to as many tasks as run at once, and to more only by their bytes.
        return file_scans(cells.select(*CELL_SCHEMA.names), TASK_FILES * self.spark.sparkContext.defaultParallelism)

    def _ranges(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}{RANGES}", FILE_RANGE_SCHEMA)

    def put(self, cells: DataFrame, ordered: bool = False) -> None:
        """Append cells; ``put_seq`` decides between puts of one cell.

        ``ordered`` says that the rows come in ascending, disjoint ranges of their row key, partition by partition. The
        range of every file is then noted beside the table, which spares key-limited scans most files; files
        without a note are read, so an attempt that fails in between costs no row.
        """
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in CELL_SCHEMA]
        name = f"{ORDERED if ordered else UNORDERED}{uuid.uuid4().hex}"
        folder = f"{self.path}/put={name}"
        cells.select(*columns).write.option("maxRecordsPerFile", FILE_CELLS).parquet(folder)
        if ordered:
            # A file's distinct keys are found by hashing, where it is read; only these are sorted, a few files' in a task.
            written = self._by_few_files(self.spark.read.schema(CELL_SCHEMA).parquet(folder))
            tasks = -(-max(1, len(written.inputFiles())) // TASK_FILES)
            placed = written.select(F.substring_index(F.input_file_name(), "/", -1).alias("file"), "row_key").distinct()
            ends = placed.repartition(tasks, "file").groupBy("file").agg(
                F.min("row_key").alias("first_key"), F.max("row_key").alias("last_key"), F.count("row_key").alias("keys")
            )
            noted = ends.select(F.lit(name).alias("put"), "file", "first_key", "last_key", "keys")
            noted.repartition(1).write.mode("append").parquet(f"{self.path}{RANGES}")  # a row a file

    def put_ordered(
        self, rows: DataFrame, key: str, mapping: dict, put_seq: Column, files: int | None = None
    ) -> None:
        """Put rows in ranges of their key, by default as many as their size asks for; meant for bulk loads.

        ``rows`` should be a stored table: finding the ranges reads it once more.
        """
        dealt = rows.repartitionByRange(quoted(key)) if files is None else rows.repartitionByRange(files, quoted(key))
        placed = dealt.sortWithinPartitions(quoted(key))
        self.put(to_cells(placed, key, mapping, put_seq), ordered=True)

    def put_rows(self, rows: DataFrame, key: str, mapping: dict, put_seq: Column) -> None:
        self.put(to_cells(rows, key, mapping, put_seq))

    def cells(self) -> DataFrame:
        """The last put of every cell (S5); with few kinds of cells a row's are merged and shuffled as one record."""
        log = self.log()
        kinds = [tuple(row) for row in log.select("family", "qualifier").distinct().limit(MERGED_KINDS + 1).collect()]
        return latest_cells(log) if len(kinds) > MERGED_KINDS else latest_of_kinds(log, kinds)

    def rows(self, key: str, mapping: dict) -> DataFrame:
        return from_cells(self.log(), key, mapping)

    def below(self, key: str) -> DataFrame:
        """The log up to a row key, from the files that can hold such keys."""
        noted = self._ranges()
        paths = [f"put={row['put']}/{row['file']}" for row in noted.filter(F.col("first_key") <= key).select("put", "file").collect()]
        # Plain puts, and an ordered one that lacks its notes, are read whole.
        known = {row["put"] for row in noted.select("put").distinct().collect()}
        paths += [name for name in subfolders(self.spark, self.path) if name.removeprefix("put=") not in known]
        if not paths:
            return self.spark.createDataFrame([], CELL_SCHEMA)
        rows = self.spark.read.schema(CELL_SCHEMA).parquet(*[f"{self.path}/{path}" for path in paths])
        return rows.filter(F.col("row_key") <= key)

    def _key_bound(self, limit: int) -> str | None:
        """A key that has ``limit`` keys up to it at least, by the notes alone; none if they don't tell.

        Of a put only files count that begin where the ones before end, or later; a key may span two of them.
        """
        files = Window.partitionBy("put").orderBy("last_key", "first_key", "file")
        before = F.max("last_key").over(files.rowsBetween(Window.unboundedPreceding, -1))
        own = F.when(before.isNull() | (F.col("first_key") >= before), F.col("keys") - 1).otherwise(0)
        reached = self._ranges().withColumn("own", own).withColumn("so_far", F.sum("own").over(files) + 1)
        return reached.filter(F.col("so_far") >= limit).agg(F.min("last_key")).first()[0]

    def scan(self, limit: int) -> DataFrame:
        """All cells, as last put, of the ``limit`` smallest row keys.

        The notes of ordered puts bound the last key wanted, a pass over the keys of the files up to that bound
        finds it, and only files that begin at or below it are read.
        """
        if limit <= 0:
            raise ValueError(f"a scan wants a positive limit, got {limit}")
        bound = self._key_bound(limit)
        last = last_of_first_keys(self.log() if bound is None else self.below(bound), limit)
        return latest_cells(self.log().limit(0) if last is None else self.below(last))
