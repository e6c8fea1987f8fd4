"""Operator 6: near-duplicate embeddings by E8 lattice hashing.

In each table two random projections take the unit vectors to eight dimensions each, where the nearest points
of the scaled E8 lattice are a vector's own cell. It also probes the cells that differ by the lattice step in one of
the projections that lies most towards the vector. Two projections to a cell keep unrelated vectors apart: with the
defaults fewer than one in a thousand such pairs of 64 dimensions share a bucket. Two vectors of one label are candidates where the own cell of one is among the cells of the
other, and candidates are decided by their cosine in double precision.

Equal vectors are one row with a multiplicity. A bucket is compared as a matrix product inside a task,
and only sums and spanning edges leave it, never its pairs. Buckets of more than ``block`` rows are cut into
blocks, and each pair of blocks is a task's work of its own, so no task ever holds a large bucket. A pair
that meets in several buckets counts in the one with the smallest key only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import connected_components
from larder.llm.minhash import mix
from larder.sources.scratch import materialize

_U = np.uint64


def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    found = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            root = np.zeros(8)
            root[i], root[j] = a, b
            found.append(root)
    found += [np.array(signs) for signs in product((0.5, -0.5), repeat=8) if sum(s < 0 for s in signs) % 2 == 0]
    return np.array(found)


ROOTS = _roots()
#: The steps to a neighbouring cell: one of the two projections moves.
_STEPS = np.kron(np.eye(2), ROOTS)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and turn the worst coordinate if the sum is odd."""
    rounded = np.rint(x)
    error = x - rounded
    rows = np.arange(len(x))
    worst = np.argmax(np.abs(error), axis=1)
    odd = rounded.sum(axis=1) % 2 != 0
    rounded[rows[odd], worst[odd]] += np.where(error[rows[odd], worst[odd]] >= 0, 1.0, -1.0)
    return rounded


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """E8 is D8 and D8 moved by one half in every coordinate; the nearer of both candidates wins."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def cell_keys(unit: np.ndarray, labels: np.ndarray, tables: int, scale: float, probes: int) -> np.ndarray:
    """Keys (row, table, 1 + probes) of each vector's own cell and its nearest neighbours."""
    n, dimensions = unit.shape
    keys = np.empty((n, tables, 1 + probes), np.int64)
    for table in range(tables):
        projection = np.random.default_rng([dimensions, table]).normal(size=(dimensions, 16))
        x = unit @ projection / scale
        own = np.concatenate([nearest_e8(x[:, :8]), nearest_e8(x[:, 8:])], axis=1)
        order = np.argpartition(-((x - own) @ _STEPS.T), max(probes - 1, 0), axis=1)[:, :probes]
        for k in range(1 + probes):
            cell = own if k == 0 else own + _STEPS[order[:, k - 1]]
            key = np.full(n, _U(table * 1000 + dimensions)) + labels.astype(np.int64).view(_U) * _U(0x9E3779B97F4A7C15)
            for column in np.ascontiguousarray((cell * 2).astype(np.int64).T).view(_U):
                key = mix(key * _U(0xD6E8FEB86659FD93) + column)
            keys[:, table, k] = key.view(np.int64)
    return keys


def _units(vectors: pa.Array, size: int) -> np.ndarray:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _cells(reps: DataFrame, tables: int, scale: float, probes: int) -> DataFrame:
    """rep, keys (all of its cells, own cell first in each table)."""

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column(2)])
            for size in np.unique(sizes):
                part = batch.filter(pa.array(sizes == size))
                labels = part.column(1).to_numpy(zero_copy_only=False)
                keys = cell_keys(_units(part.column(2), size), labels, tables, scale, probes)
                width = keys.shape[1] * keys.shape[2]
                offsets = np.arange(len(keys) + 1, dtype=np.int32) * width
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1)))], ["rep", "keys"])

    return reps.select("rep", "label", "vector").mapInArrow(hash_rows, "rep long, keys array<long>")


def _least_reachable(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest row reachable by the links, per row."""
    least = np.arange(n)
    while True:
        before = least.copy()
        low = np.minimum(least[left], least[right])
        np.minimum.at(least, left, low)
        np.minimum.at(least, right, low)
        least = least[least]
        if (least == before).all():
            return least


def _bucket_links(rows: dict, threshold: float, cells_per_table: int, block_a: int, block_b: int) -> Iterator[tuple]:
    """Counted links of one bucket, or of one pair of its blocks: (rep, links, smallest rep reachable)."""
    key, reps, weights, labels, block = (rows[c] for c in ("key", "rep", "weight", "label", "block"))
    unit, cells = rows["unit"], rows["cells"].reshape(len(reps), -1, cells_per_table)
    near = np.triu(unit @ unit.T >= threshold, 1) & (labels[:, None] == labels[None, :])
    if block_a != block_b:
        near &= block[:, None] != block[None, :]
    left, right = np.nonzero(near)
    counted = np.zeros(len(left), bool)
    for start in range(0, len(left), 65_536):
        i, j = left[start : start + 65_536], right[start : start + 65_536]
        least = np.full(len(i), np.iinfo(np.int64).max)
        for x, y in ((i, j), (j, i)):
            own = cells[x, :, 0]
            for k in range(cells_per_table):
                met = np.where(own == cells[y, :, k], own, np.iinfo(np.int64).max).min(axis=1)
                least = np.minimum(least, met)
        counted[start : start + 65_536] = least == key
    left, right = left[counted], right[counted]
    if not len(left):
        return
    links = np.bincount(left, weights[right], len(reps)) + np.bincount(right, weights[left], len(reps))
    least = _least_reachable(len(reps), left, right)
    for i in np.flatnonzero(links):
        yield int(reps[i]), int(links[i]), int(reps[least[i]])


def near_embeddings(
    embeddings: DataFrame,
    threshold: float = 0.93,
    tables: int = 18,
    scale: float = 1.9,
    probes: int = 2,
    block: int = 1024,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """Per row: id, ``n_links``, ``component_id`` (smallest id reachable), ``kept`` (id is that one).

    Links join rows of one label with a cosine of ``threshold`` or more; copies of a vector count one by one.
    At a cosine of 0.93 the defaults find a pair with a probability of about 0.998, at 0.95 of more. Defined results: rows with a
    null label, with a null, empty or zero vector or with null or non-finite components, and rows with a null
    id link with nothing and are kept; vectors of different lengths never link; rows that repeat an id are
    vectors of their own and share a component; an empty table gives no rows. Other columns are not read.
    """
    rows = embeddings.select(
        F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")
    )
    bad = F.exists("vector", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    nothing = F.forall("vector", lambda v: v == 0)
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad & ~nothing
    sound = rows.filter(F.coalesce(usable, F.lit(False)))
    reps = materialize(
        sound.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")), "vectors"
    )
    # A repeated id can stand for several vectors, so the vectors get numbers of their own for the links.
    reps = materialize(reps.withColumn("number", F.monotonically_increasing_id()), "numbered-vectors")
    numbered = reps.select(F.col("number").alias("rep"), "label", "vector", "weight")

    cells = materialize(_cells(numbered, tables, scale, probes), "cells")
    per_table = 1 + probes
    entries = cells.select("rep", F.posexplode("keys").alias("place", "key")).select(
        "rep", "key", (F.col("place") % per_table == 0).alias("own")
    )
    crowds = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("any_own")).filter("n > 1 and any_own")
    crowded = entries.join(crowds.select("key", "n"), "key").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    # Each row goes to every pair of blocks that its own block is part of.
    dealt = crowded.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "rep", "key", "block", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b")
    )
    full = dealt.join(numbered, "rep").join(cells, "rep")
    partitions = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    group = ["key", "block_a", "block_b"]
    ordered = full.select(*group, "block", "rep", "weight", "label", "vector", "keys").repartition(partitions, *group).sortWithinPartitions(*group, "rep")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            rest = batch
            ends = _group_ends(rest)
            if held and len(ends) and not _same_group(held[0], rest):
                yield _links(pa.Table.from_batches(held), threshold, per_table)
                held = []
            if len(ends) > 1:
                whole = ends[-2]
                yield _links(pa.Table.from_batches([*held, rest.slice(0, whole)]), threshold, per_table)
                held, rest = [], rest.slice(whole)
            if rest.num_rows:
                held.append(rest)
        if held:
            yield _links(pa.Table.from_batches(held), threshold, per_table)

    found = materialize(ordered.mapInArrow(link, "rep long, links long, least long"), "embedding-links")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    by_id = reps.select("number", F.col("rep").alias("rep_id"))
    edges = found.select("rep", "least").distinct().join(by_id.toDF("rep", "a"), "rep").join(by_id.toDF("least", "b"), "least")
    # Every row of an id is tied to the smallest id of its vector; links between vectors come on top.
    copies = sound.join(reps, ["label", "vector"]).select("id", F.col("number").alias("rep"), "weight", F.col("rep").alias("rep_id"))
    copies = materialize(copies, "vector-copies")
    ties = copies.select(F.col("id").alias("a"), F.col("rep_id").alias("b")).filter("a != b")
    components = materialize(connected_components(edges.select("a", "b").union(ties).distinct(), "a", "b"), "embedding-components")
    linked = (
        copies.join(counts, "rep", "left")
        .join(components, F.col("id") == F.col("node"), "left")
        .select(
            "id",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).cast("long").alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    alone = rows.filter(~F.coalesce(usable, F.lit(False))).select("id", F.lit(0).cast("long").alias("n_links"))
    alone = alone.join(components, F.col("id") == F.col("node"), "left").select("id", "n_links", F.coalesce("component", "id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _group_columns(batch) -> np.ndarray:
    return np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)], axis=1)


def _group_ends(batch: pa.RecordBatch) -> np.ndarray:
    groups = _group_columns(batch)
    if not len(groups):
        return np.empty(0, np.int64)
    return np.append(np.flatnonzero((groups[1:] != groups[:-1]).any(axis=1)) + 1, len(groups))


def _same_group(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
    return bool((_group_columns(a.slice(0, 1)) == _group_columns(b.slice(0, 1))).all())


def _links(table: pa.Table, threshold: float, cells_per_table: int) -> pa.RecordBatch:
    """Counted links of all groups of ``table``, which holds whole groups."""
    batch = table.combine_chunks().to_batches()[0] if table.num_rows else None
    out: list[tuple] = []
    start = 0
    for end in _group_ends(batch) if batch is not None else ():
        part = batch.slice(start, end - start)
        start = end
        if part.num_rows < 2:
            continue
        sizes = np.array([len(v) for v in part.column(7)])
        for size in np.unique(sizes):
            same = part.filter(pa.array(sizes == size))
            columns = {name: same.column(i).to_numpy(zero_copy_only=False) for i, name in ((3, "block"), (4, "rep"), (5, "weight"), (6, "label"))}
            columns |= {"key": same.column(0)[0].as_py(), "unit": _units(same.column(7), size)}
            columns["cells"] = same.column(8).flatten().to_numpy().reshape(same.num_rows, -1)
            out.extend(_bucket_links(columns, threshold, cells_per_table, same.column(1)[0].as_py(), same.column(2)[0].as_py()))
    columns = list(zip(*out, strict=True)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["rep", "links", "least"])
