"""Operator 11: hard negatives of anchor vectors by segment summary filtering.

Every vector is cut into segments, and the mean and deviation of each are stored with it. For two segments of n
components, the product of the means times n, plus or minus the product of the deviations times n, bounds their
inner product (Cauchy-Schwarz on what the means leave over); the sums over the segments bound the score. Bounds
start from one segment, the whole vector; pairs they cannot decide are refined on segments a quarter as long,
and what is left at the finest level is scored exactly.

The work is a grid: vectors are packed into blocks, and each cell of the grid, a block of anchors against a block of
all vectors, is one group of a shuffled cogroup. A cell keeps the best of its block per anchor, and what it has
found raises the bar for the rest of the block; a window ranks the few rows of all cells. Two passes: the positives
first, then the negatives, whose allowed scores follow from the positives.

Scores are inner products of whole numbers and exact: in doubles as long as they stay below 2**53, else in 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.sources.scratch import materialize

FINEST = 16  # segments of the finest level
LEVELS = (1, 4, FINEST)
BLOCK = 8192
TILE = 1024
DENSE = 1 / 16  # above this share of open pairs, bounds and scores come from matrix products
SCALE = 256

_NONE = np.iinfo(np.int64).min


def summaries(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each of ``FINEST`` segments per vector; the width is a multiple of ``FINEST``."""
    parts = vectors.astype(np.float64).reshape(len(vectors), FINEST, -1)
    mean = parts.mean(axis=2)
    return mean.astype(np.float32), parts.std(axis=2).astype(np.float32)


class Block:
    """Vectors of one block with the bounds of every level, as tasks work on them."""

    def __init__(self, blob: bytes, width: int):
        self.count = len(blob) // (16 + 8 * width + 8 * FINEST)
        n, at = self.count, 0

        def take(dtype: str, *shape: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(blob, dtype, math.prod(shape), at).reshape(shape)
            at += part.nbytes
            return part

        self.ids, self.labels = take("<i8", n), take("<i8", n)
        self.vectors = take("<i8", n, width)
        mean, deviation = take("<f4", n, FINEST), take("<f4", n, FINEST)
        self.reals = self.vectors.astype(np.float64)
        self.norms = np.sqrt((self.reals**2).sum(axis=1))
        self.levels = [self._level(mean.astype(np.float64), deviation.astype(np.float64), level, width) for level in LEVELS]

    def _level(self, mean: np.ndarray, deviation: np.ndarray, segments: int, width: int) -> np.ndarray:
        """Means and deviations of ``segments`` segments, scaled so that products need no further factor."""
        parts = mean.reshape(self.count, segments, -1)
        means = parts.mean(axis=2)
        spread = (deviation.reshape(parts.shape) ** 2 + (parts - means[:, :, None]) ** 2).mean(axis=2)
        return np.concatenate([means, np.sqrt(spread)], axis=1) * math.sqrt(width // segments)


def packed_block(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> bytes:
    mean, deviation = summaries(vectors)
    return b"".join(np.ascontiguousarray(x).tobytes() for x in (ids, labels, vectors.astype("<i8"), mean, deviation))


def _bounds(a: np.ndarray, b: np.ndarray, pairs: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
    """Middle and radius of the possible scores: of all pairs of rows, or of the given ones."""
    half = a.shape[1] // 2
    if pairs is None:
        return a[:, :half] @ b[:, :half].T, a[:, half:] @ b[:, half:].T
    left, right = a[pairs[0]], b[pairs[1]]
    return (left[:, :half] * right[:, :half]).sum(axis=1), (left[:, half:] * right[:, half:]).sum(axis=1)


def scored_pairs(
    anchors: Block, some: np.ndarray, rows: Block, others: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of ``some`` anchors and ``other`` rows whose score may lie in [low, high] of the anchor, with the score.

    ``allowed`` masks the pairs that count at all. Returns places in ``some`` and ``others`` and exact scores.
    """
    # What rounding can add to a bound, in proportion to the largest score the two norms admit.
    slack = 1e-5 * anchors.norms[some][:, None] * rows.norms[others][None, :] + 1e-3
    open_pairs, pairs = allowed, None
    for level in range(len(LEVELS)):
        middle, radius = _bounds(anchors.levels[level][some], rows.levels[level][others], pairs)
        if pairs is None:
            radius += slack
            open_pairs = open_pairs & (middle + radius >= low[:, None]) & (middle - radius <= high[:, None])
            if np.count_nonzero(open_pairs) <= DENSE * open_pairs.size:
                pairs = np.nonzero(open_pairs)
        else:
            radius += slack[pairs]
            stay = (middle + radius >= low[pairs[0]]) & (middle - radius <= high[pairs[0]])
            pairs = pairs[0][stay], pairs[1][stay]
    exact_in_doubles = anchors.norms[some].max(initial=0) * rows.norms[others].max(initial=0) < 2.0**52
    a, b = (x.reals if exact_in_doubles else x.vectors for x in (anchors, rows))
    if pairs is None:
        pairs = np.nonzero(open_pairs)
        scores = (a[some] @ b[others].T)[pairs]
    else:
        scores = np.concatenate(
            [
                np.einsum("ij,ij->i", a[some[pairs[0][at : at + TILE]]], b[others[pairs[1][at : at + TILE]]])
                for at in range(0, len(pairs[0]), TILE)
            ]
            or [np.empty(0)]
        )
    return pairs[0], pairs[1], scores.astype(np.int64)


class Best:
    """The ``k`` best rows so far of every query: the greatest scores, of equal ones the smaller ids."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.bar = np.full(queries, _NONE, np.int64)

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        enough = score >= self.bar[query]
        query = np.concatenate([self.query, query[enough]])
        score = np.concatenate([self.score, score[enough]])
        ids = np.concatenate([self.id, ids[enough]])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.empty(0, np.int64)
        place = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        stay = place < self.k
        self.query, self.score, self.id = query[stay], score[stay], ids[stay]
        last = place == self.k - 1
        self.bar[query[last]] = score[last]


def best_positives(anchors: Block, rows: Block, k: int) -> Best:
    """Per anchor the best rows of its own label, without rows of its own id."""
    best = Best(anchors.count, k)
    by_label = np.argsort(rows.labels, kind="stable")
    labels, first = np.unique(rows.labels[by_label], return_index=True)
    members = dict(zip(labels.tolist(), np.split(by_label, first[1:]), strict=True))
    unlimited = np.full(TILE, np.inf)
    for label in np.unique(anchors.labels).tolist():
        mine, own = np.flatnonzero(anchors.labels == label), members.get(label, by_label[:0])
        for i in range(0, len(mine), TILE):
            some = mine[i : i + TILE]
            for j in range(0, len(own), TILE):
                others = own[j : j + TILE]
                allowed = anchors.ids[some][:, None] != rows.ids[others][None, :]
                low = best.bar[some].astype(np.float64)
                at, to, score = scored_pairs(anchors, some, rows, others, allowed, low, unlimited[: len(some)])
                best.add(some[at], score, rows.ids[others[to]])
    return best


def best_negatives(anchors: Block, rows: Block, positives: np.ndarray, k: int, least: int, most: int, share: int) -> Best:
    """Per anchor and positive (rows of ``positives``: place, rank from 0, score) the best rows of other labels.

    A negative's score times ``share`` lies between the positive's times ``least`` and times ``most``.
    """
    ranks = int(positives[:, 1].max()) + 1 if len(positives) else 0
    best = Best(anchors.count * ranks, k)
    # Whole-number limits: the least score that is not too low, and the greatest that is not too high.
    low, high = (np.full((anchors.count, ranks), fill, np.int64) for fill in (1, 0))
    place, rank, score = positives.T
    low[place, rank] = [-(-least * s // share) for s in score.tolist()]
    high[place, rank] = [most * s // share for s in score.tolist()]
    wanted = low <= high
    for i in range(0, anchors.count, TILE):
        some = np.arange(i, min(i + TILE, anchors.count))
        for j in range(0, rows.count, TILE):
            others = np.arange(j, min(j + TILE, rows.count))
            allowed = (anchors.labels[some][:, None] != rows.labels[others][None, :]) & wanted[some].any(axis=1)[:, None]
            bars = np.maximum(low[some], best.bar.reshape(anchors.count, ranks)[some])
            floor = np.where(wanted[some], bars, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
            ceiling = np.where(wanted[some], high[some], _NONE).max(axis=1, initial=_NONE)
            at, to, found = scored_pairs(anchors, some, rows, others, allowed, floor.astype(float), ceiling.astype(float))
            for r in range(ranks):
                fits = wanted[some[at], r] & (found >= bars[at, r]) & (found <= high[some[at], r])
                best.add(some[at[fits]] * ranks + r, found[fits], rows.ids[others[to[fits]]])
    return best


def usable_vectors(vectors: DataFrame, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """Rows that take part: ``id``, ``label``, ``vector`` (whole numbers, floor of ``SCALE`` times the component)."""
    named = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    broken = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform("vector", lambda x: F.floor(x * float(SCALE)))
    return named.dropna(subset=["id", "label", "vector"]).filter(~broken).select("id", "label", whole.alias("vector"))


def _blocks(rows: DataFrame, blocks: int, width: int, label: str) -> DataFrame:
    """Rows dealt evenly to numbered blocks, one packed row per block that has any: block, data."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False))
            labels.append(batch.column(1).to_numpy(zero_copy_only=False))
            lists = batch.column(2)
            sizes = np.diff(lists.offsets.to_numpy())
            table = np.zeros((len(sizes), width), np.int64)
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            table[np.repeat(np.arange(len(sizes)), sizes), place] = lists.flatten().to_numpy(zero_copy_only=False)
            vectors.append(table)
        if not ids:
            return
        table = np.concatenate(vectors)
        if ((table.astype(np.float64) ** 2).sum(axis=1) >= 2.0**62).any():
            raise OverflowError("components too large: scores need more than 64 bits")
        blob = packed_block(np.concatenate(ids), np.concatenate(labels), table)
        number = pa.array([TaskContext.get().partitionId()], pa.int32())
        yield pa.RecordBatch.from_arrays([number, pa.array([blob], pa.binary())], ["block", "data"])

    return materialize(rows.repartition(blocks).mapInArrow(pack, "block int, data binary"), label)


def _grid(anchors: DataFrame, rows: DataFrame, across: int, down: int, cell: Callable, schema: str) -> DataFrame:
    """``cell`` of every block of anchors (``down`` of them) and block of rows (``across``)."""
    left = anchors.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = rows.select(F.col("block").alias("other"), "data", F.explode(F.sequence(F.lit(0), F.lit(down - 1))).alias("block"))

    names = [field.split()[0] for field in schema.split(", ")]

    def run(table: pa.Table, against: pa.Table) -> pa.Table:
        if table.num_rows and against.num_rows:
            return cell(table, against)
        return pa.table({name: pa.array([], pa.int64()) for name in names})

    return left.groupBy("block", "other").cogroup(right.groupBy("block", "other")).applyInArrow(run, schema)


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The best ``k`` of the cells' rows, with ``place`` from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("other_id"))
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    most: int = 100,
    share: int = 100,
    block: int = BLOCK,
) -> DataFrame:
    """Per anchor and positive the hardest negatives: ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``,
    ``positive_score``, ``negative_score``, ``positive_rank``.

    ``is_anchor`` is a condition on ``id`` and ``label``. An anchor's positives are its ``positives`` best rows of the same label,
    their negatives the ``negatives`` best rows of another label with ``least`` x positive score <= ``share`` x
    negative score <= ``most`` x positive score. Best is the greatest score, of equal scores the smallest id.

    Ids and labels are whole numbers. Defined results: rows with a null id, label or vector, or a null or
    non-finite component, take no part; shorter vectors count as filled up with zeros; rows that repeat an id are
    rows of their own, but no partners of an anchor of that id; an anchor without positives, or a positive
    without negatives, gives no rows; an empty table gives no rows. Scores that need more than 64 bits are an
    error. Other columns are not read.
    """
    usable = usable_vectors(vectors, id_column, label_column, vector_column)
    counts = usable.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(is_anchor).alias("anchors"), F.max(F.size("vector")).alias("width")
    ).first()
    width = FINEST * max(1, math.ceil((counts["width"] or 0) / FINEST))
    across, down = (max(1, math.ceil(counts[name] / block)) for name in ("rows", "anchors"))
    rows = _blocks(usable, across, width, "vector-blocks")
    anchors = _blocks(usable.filter(is_anchor), down, width, "anchor-blocks")

    def blocks_of(table: pa.Table, against: pa.Table) -> tuple[int, Block, Block]:
        return (table["block"][0].as_py(), *(Block(x["data"][0].as_py(), width) for x in (table, against)))

    def positive_cell(table: pa.Table, against: pa.Table) -> pa.Table:
        number, own, others = blocks_of(table, against)
        best = best_positives(own, others, positives)
        columns = np.full(len(best.query), number), best.query, own.ids[best.query], best.score, best.id
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["block", "at", "anchor_id", "score", "other_id"])

    found = _grid(anchors, rows, across, down, positive_cell, "block long, at long, anchor_id long, score long, other_id long")
    chosen = materialize(_ranked(found, ["block", "at"], positives), "positives")

    # At most ``positives`` entries per anchor of a block go to its cells.
    entries = chosen.groupBy(F.col("block").cast("int").alias("block")).agg(
        F.collect_list(F.struct("at", (F.col("place") - 1).cast("long").alias("rank"), "score")).alias("entries")
    )

    def negative_cell(table: pa.Table, against: pa.Table) -> pa.Table:
        number, own, others = blocks_of(table, against)
        listed = table["entries"].combine_chunks().flatten()
        wanted = np.stack([listed.field(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
        best = best_negatives(own, others, wanted, negatives, least, most, share)
        ranks = int(wanted[:, 1].max()) + 1
        columns = np.full(len(best.query), number), best.query // ranks, best.query % ranks + 1, best.score, best.id
        return pa.table([pa.array(c, pa.int64()) for c in columns], ["block", "at", "place", "score", "other_id"])

    asked = anchors.join(entries, "block")
    found = _grid(asked, rows, across, down, negative_cell, "block long, at long, place long, score long, other_id long")
    hardest = _ranked(found.withColumnRenamed("place", "positive"), ["block", "at", "positive"], negatives)
    named = chosen.select(
        "block", "at", F.col("place").cast("long").alias("positive"), "anchor_id",
        F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    return hardest.join(named, ["block", "at", "positive"]).select(
        "anchor_id",
        "positive_id",
        F.col("place").cast("int").alias("rank"),
        F.col("other_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
        F.col("positive").cast("int").alias("positive_rank"),
    )
