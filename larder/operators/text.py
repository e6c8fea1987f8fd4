"""Word frequency (A3, O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import quoted


def word_count(lines: DataFrame, column: str = "value") -> DataFrame:
    r"""Occurrences of each lower-cased word, most frequent first, then by word.

    Words are what ``\W+`` separates, with the ASCII word class: an accented
    letter is a separator.
    """
    words = lines.select(F.explode(F.split(F.lower(quoted(column)), r"\W+")).alias("word"))
    counted = words.filter(F.length("word") > 0).groupBy("word").agg(
        F.count(F.lit(1)).alias("count")
    )
    return counted.orderBy(F.desc("count"), "word")
