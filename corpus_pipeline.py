"""The corpus pipeline: five operators of ``larder.llm`` in a row over ``documents``.

Every stage takes all rows its predecessor kept; the rows are written as Parquet and read again between
stages. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import bpe, exact, langid, minhash, mixing
from larder.llm.queries import BYTE_BPE
from larder.llm.tables import crc_remainder, read, share_code
from larder.sources.scratch import materialize


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents without a determined language, or with a score below one half, go."""
    share_code(spark)
    model = langid.train_languages(docs, crc_remainder("doc_id", 5) != 0)
    return langid.keep_identified(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of equal texts the row with the largest id stays."""
    return exact.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near copies the row with the smallest id stays."""
    share_code(spark)
    return minhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: every row as often as the mix takes it."""
    return mixing.mixed_rows(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the token ids of every whole text, with the columns a loader needs."""
    share_code(spark)
    return bpe.encode_documents(docs, BYTE_BPE).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", keep_identified),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("mix", mix),
    ("tokens", tokenize),
]

#: Language identification, near copies and tokens are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
