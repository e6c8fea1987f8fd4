"""Column statistics that stay exact and bounded at any row count."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.columns import quoted

HISTOGRAM_BUCKETS = 1024


@dataclass(frozen=True)
class ColumnSummary:
    """Moments of the usable (non-null, non-NaN) values of a column, and their lower median."""

    rows: int
    present: int
    mean: float
    variance: float
    median: float | None = None

    def filled_with(self, value: float) -> tuple[float, float]:
        """Mean and sample deviation once every missing row holds ``value``.

        The missing rows are one group of equal values, so the two groups merge
        in closed form and the filled column needs no further pass.
        """
        missing = self.rows - self.present
        mean = self.mean + (value - self.mean) * missing / self.rows
        spread = self.variance * (self.present - 1) if self.present > 1 else 0.0
        spread += (value - self.mean) ** 2 * missing * self.present / self.rows
        return mean, math.sqrt(spread / (self.rows - 1)) if self.rows > 1 else 0.0


@dataclass(frozen=True)
class _Interval:
    """Where a column's median is: in [low, high], as the rank-th value of those."""

    low: float
    high: float
    rank: int


def _usable(name: str) -> Column:
    return F.nanvl(quoted(name).cast("double"), F.lit(None).cast("double"))


def _summary_aggregates(columns: Sequence[str]) -> list[Column]:
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(columns):
        value = _usable(name)
        aggregates += [
            F.count(value).alias(f"present{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.var_samp(value).alias(f"variance{i}"),
            F.min(value).alias(f"low{i}"),
            F.max(value).alias(f"high{i}"),
        ]
    return aggregates


def summarise(
    frame: DataFrame, columns: Sequence[str], medians: bool = False
) -> dict[str, ColumnSummary]:
    """Row counts, mean and variance of every column, in one pass; with medians in a few.

    Medians are exact. After the first pass each further one counts the values
    of every column's interval in equal-width buckets and narrows the interval
    to the bucket that holds the middle rank, until one distinct value is left.
    Tasks and driver hold at most ``HISTOGRAM_BUCKETS`` counters per column,
    however many distinct values there are, and a hot value is one counter.
    Measurements with few decimals need two such passes.
    """
    row = frame.agg(*_summary_aggregates(columns)).first()
    found = {
        name: ColumnSummary(
            row["rows"], row[f"present{i}"], row[f"mean{i}"], row[f"variance{i}"] or 0.0
        )
        for i, name in enumerate(columns)
    }
    if not medians:
        return found
    empty = [name for name in columns if found[name].present == 0]
    if empty:
        raise ValueError(f"no values to take a median of in: {', '.join(empty)}")
    intervals = {
        name: _Interval(row[f"low{i}"], row[f"high{i}"], (found[name].present + 1) // 2)
        for i, name in enumerate(columns)
    }
    endless = [n for n, at in intervals.items() if not math.isfinite(at.high - at.low)]
    if endless:
        raise ValueError(f"median needs a finite value range in: {', '.join(endless)}")
    while wide := {name: at for name, at in intervals.items() if at.low < at.high}:
        intervals |= _narrow(frame, wide)
    return {
        name: replace(summary, median=intervals[name].low + 0.0)
        for name, summary in found.items()
    }


def lower_medians(frame: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact lower median of every column, nulls and NaN left out."""
    return {name: at.median for name, at in summarise(frame, columns, medians=True).items()}


def _narrow(frame: DataFrame, intervals: dict[str, _Interval]) -> dict[str, _Interval]:
    entries = []
    for i, (name, at) in enumerate(intervals.items()):
        value = _usable(name)
        share = (value - F.lit(at.low)) / F.lit(at.high - at.low)
        bucket = F.least(
            F.floor(share * F.lit(float(HISTOGRAM_BUCKETS))), F.lit(HISTOGRAM_BUCKETS - 1)
        ).cast("int")
        slot = F.when(value.between(at.low, at.high), bucket + F.lit(i * HISTOGRAM_BUCKETS))
        entries.append(F.struct(slot.alias("slot"), value.alias("value")))
    counted = (
        frame.select(F.inline(F.array(*entries)))
        .filter(F.col("slot").isNotNull())
        .groupBy("slot")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
    )
    # At most HISTOGRAM_BUCKETS rows per column reach the driver.
    buckets = sorted(counted.collect(), key=lambda row: row["slot"])
    narrowed = {}
    for i, (name, at) in enumerate(intervals.items()):
        rank = at.rank
        for row in buckets:
            if row["slot"] // HISTOGRAM_BUCKETS != i:
                continue
            if rank <= row["rows"]:
                narrowed[name] = _Interval(row["low"], row["high"], rank)
                break
            rank -= row["rows"]
    return narrowed
