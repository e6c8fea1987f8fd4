"""Operator 10: near-duplicate documents by DartMinHash.

A document is the weighted set of its five-word shingles, a shingle's weight being how often it occurs.
Each unit of weight is a strip along the rank axis, and hashing throws darts onto it as a Poisson process:
the gaps between a strip's darts are exponential, from hashes of shingle, unit and dart number, so every
document that has the strip has the same darts. A document looks at ranks up to a bound that lets about
``k (ln k + 3)`` darts fall on it, whatever its length. A dart also hashes to one of ``k`` coordinates;
each keeps its earliest dart. Two documents agree in a coordinate with the probability of their weighted
Jaccard similarity.

Coordinates in bands of ``rows`` give candidate buckets. Documents with equal weighted sets are one class
from the start. In every bucket each class is compared with its leader first, the one that meets most others; then, over the components
found so far, all pairs of a bucket that are still in different components, inside a task: by a byte of each
coordinate, then by a bound on their common weight from counts of their units in bins. A pair leaves the task of
the first bucket it shares only, and only if the bound allows the similarity; its exact weighted similarity decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.components import connected_components
from larder.llm.tables import id_and_text
from larder.sources.scratch import materialize, release

_U = np.uint64
_SYMBOLS = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_STEP = _U(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of a 64-bit integer over all others."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def word_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of the words of a text given as bytes."""
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, _U)
    # Position in its word weighs each byte; sums over a word come from one running sum.
    place = np.arange(len(data), dtype=np.int64)
    place -= np.repeat(starts, np.diff(np.append(starts, len(data)))) if starts[0] == 0 else np.concatenate(
        [np.zeros(starts[0], np.int64), np.repeat(starts, np.diff(np.append(starts, len(data))))]
    )
    values = mix(_SYMBOLS[data] + place.astype(_U) * _STEP)
    values[~inside] = 0
    running = np.concatenate([np.zeros(1, _U), np.cumsum(values, dtype=_U)])
    return mix(running[ends] - running[starts] + (ends - starts).astype(_U))


def strips(text: str, shingle: int) -> np.ndarray:
    """Sorted hashes of a text's units of weight: shingle and how often it occurred before.

    A text of fewer words than a shingle has, but at least one, is one shingle.
    """
    words = word_hashes(np.frombuffer(text.encode(), np.uint8))
    if not len(words):
        return words
    width = min(shingle, len(words))
    n = len(words) - width + 1
    hashed = np.full(n, _U(width))
    for k in range(width):
        hashed = mix(hashed * _STEP + words[k : k + n])
    hashed.sort()
    if n > 1 and (hashed[1:] == hashed[:-1]).any():
        first = np.flatnonzero(np.concatenate([[True], hashed[1:] != hashed[:-1]]))
        unit = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        hashed = np.where(unit > 0, mix(hashed + unit.astype(_U) * _STEP), hashed)
        hashed.sort()
    return hashed


BINS, FULL = 1024, 255


def unit_bins(units: np.ndarray) -> np.ndarray:
    """How many units fall into each of ``BINS`` bins, ``FULL`` standing for that many or more."""
    return np.minimum(np.bincount((mix(units) >> _U(54)).astype(np.int64), minlength=BINS), FULL).astype(np.uint8)


def may_be_similar(bins: np.ndarray, weights: np.ndarray, own: np.ndarray, weight: int, percent: int) -> np.ndarray:
    """Which rows can be similar to ``own``: the lesser counts of the bins sum to no less than the common weight.

    Never false for a similar pair; a bin that is full on both sides bounds nothing.
    """
    least = np.minimum(bins, own)
    enough = (100 + percent) * least.sum(axis=1, dtype=np.int64) >= percent * (weights + weight)
    return enough | (least == FULL).any(axis=1)


def signature(units: np.ndarray, k: int) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates, as the darts' hashes."""
    bound = k * (np.log(k) + 3) / len(units)
    while True:
        ranks, darts = [], []
        alive, at, throw = units, np.zeros(len(units)), 0
        while len(alive):
            throw += 1
            dart = mix(alive + _U(throw * 0xD6E8FEB86659FD93 % (1 << 64)))
            at = at - np.log(((dart >> _U(11)).astype(np.float64) + 0.5) / 2.0**53)
            near = at <= bound
            alive, at = alive[near], at[near]
            ranks.append(at)
            darts.append(dart[near])
        rank, dart = np.concatenate(ranks), np.concatenate(darts)
        dart = mix(dart ^ _STEP)
        late_first = np.lexsort((dart, rank))[::-1]
        kept = np.zeros(k, _U)
        hit = np.zeros(k, bool)
        place = (dart % _U(k)).astype(np.int64)
        kept[place[late_first]] = dart[late_first]
        hit[place] = True
        if hit.all():
            return kept
        bound *= 2


def set_digest(units: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two hashes of a weighted set that don't depend on an order."""
    return np.bitwise_xor.reduce(mix(units + _STEP)), np.add.reduce(mix(units ^ _U(0x5851F42D4C957F2D)))


def _signed(rows: DataFrame, shingle: int, bands: int, band_rows: int) -> DataFrame:
    """id, weight, set_a, set_b (a digest of the weighted set), bands, marks (a byte of each coordinate)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes = mix(np.arange(bands * band_rows, dtype=_U) + _STEP)
        for batch in batches:
            ids, weights, first, second, keys, marks = [], [], [], [], [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                units = strips(text.as_py(), shingle)
                if not len(units):
                    continue
                ids.append(i)
                weights.append(len(units))
                for column, half in zip((first, second), set_digest(units), strict=True):
                    column.append(half)
                darts = mix(signature(units, bands * band_rows) ^ lanes)
                marks.append((darts >> _U(56)).astype(np.uint8).tobytes())
                folded = np.add.reduce(darts.reshape(bands, band_rows), axis=1)
                keys.append(mix(folded + np.arange(bands, dtype=_U)))
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
            listed = pa.ListArray.from_arrays(np.arange(len(ids) + 1, dtype=np.int32) * bands, pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field(0).type), pa.array(weights, pa.int64()), *[pa.array(np.array(c, _U).view(np.int64)) for c in (first, second)], listed, pa.array(marks, pa.binary())],
                ["id", "weight", "set_a", "set_b", "bands", "marks"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(sign, f"id {kind}, weight long, set_a long, set_b long, bands array<long>, marks binary")


def _binned(rows: DataFrame, shingle: int) -> DataFrame:
    """id, set_a, set_b, bins: the bins of the weighted sets of a few rows, found from their texts again."""

    def bin_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [strips(text.as_py(), shingle) for text in batch.column(1)]
            digests = np.array([set_digest(u) for u in units], _U).reshape(-1, 2).view(np.int64)
            bins = pa.array([unit_bins(u).tobytes() for u in units], pa.binary())
            halves = [pa.array(np.ascontiguousarray(digests[:, i])) for i in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *halves, bins], ["id", "set_a", "set_b", "bins"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(bin_units, f"id {kind}, set_a long, set_b long, bins binary")


def _similar(pairs: DataFrame, rows: DataFrame, shingle: int, percent: int, label: str) -> DataFrame:
    """Those of ``pairs`` (a, b) whose exact weighted similarity is ``percent`` or more, stored."""
    # Stored first, so that its size is known: few ids are sent to the texts, not the texts to them.
    wanted = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [strips(text.as_py(), shingle).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.binary())], ["id", "units"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_()))

    kind = rows.schema["id"].dataType.simpleString()
    sets = materialize(rows.join(wanted, "id", "left_semi").mapInArrow(pack, f"id {kind}, units binary"), "shingles")
    joined = pairs.join(sets.toDF("a", "units_a"), "a").join(sets.toDF("b", "units_b"), "b")
    similar = materialize(joined.select("a", "b", "units_a", "units_b").mapInArrow(decide, f"a {kind}, b {kind}"), label)
    release(wanted, sets)
    return similar


BLOCK = 1024


def _unlinked_pairs(rows: DataFrame, percent: int, coordinates: int) -> DataFrame:
    """Pairs (a, b) of a bucket in different components that agree in enough coordinates to be similar.

    ``rows``: key, id, weight, comp, marks, bins, bands. Buckets are compared inside tasks, large ones block by
    block. The threshold is four standard deviations below what a pair at ``percent`` agrees in; of what
    passes, the bins leave only pairs that can be similar. A pair that shares an earlier band is left to that.
    """
    share = percent / 100
    least = int(coordinates * share - 4 * (coordinates * share * (1 - share)) ** 0.5)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches):
            ids, blocks, weights, comps = (bucket.column(i).to_numpy() for i in (3, 4, 5, 6))
            marks = np.frombuffer(b"".join(bucket.column(7).to_pylist()), np.uint8).reshape(len(ids), -1)
            bins = np.frombuffer(b"".join(bucket.column(8).to_pylist()), np.uint8).reshape(len(ids), -1)
            keys = bucket.column(9).combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            earlier = keys[:, : int(np.argmax(keys[0] == bucket.column(0)[0].as_py()))]
            across = bucket.column(1)[0].as_py() != bucket.column(2)[0].as_py()
            left, right = [], []
            for i in range(len(ids) - 1):
                other = np.flatnonzero(
                    (comps[i + 1 :] != comps[i])
                    & (100 * np.minimum(weights[i + 1 :], weights[i]) >= percent * np.maximum(weights[i + 1 :], weights[i]))
                    & (not across or blocks[i + 1 :] != blocks[i])
                )
                near = other[(marks[i + 1 + other] == marks[i]).sum(axis=1) >= least] + i + 1
                near = near[may_be_similar(bins[near], weights[near], bins[i], weights[i], percent)]
                near = near[~(earlier[near] == earlier[i]).any(axis=1)]
                left.append(np.minimum(ids[near], ids[i]))
                right.append(np.maximum(ids[near], ids[i]))
            flat = [np.concatenate(side) if side else ids[:0] for side in (left, right)]
            yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()) for side in flat], ["a", "b"])

    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = ["key", "block_a", "block_b"]
    dealt = dealt.select(
        "key", F.least("block", "other").alias("block_a"), F.greatest("block", "other").alias("block_b"),
        F.col("id").cast("long").alias("id"), "block", "weight", F.col("comp").cast("long").alias("comp"), "marks", "bins", "bands",
    )
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(partitions, *group).sortWithinPartitions(*group).mapInArrow(compare, "a long, b long")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows with equal first three columns, of batches in order of these."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
        if held and len(keys):
            last = held[-1].slice(len(held[-1]) - 1, 1)
            if any(last.column(i)[0].as_py() != keys[0, i] for i in range(3)):
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if low and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            if high > low:
                held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_duplicates(
    documents: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 30,
    band_rows: int = 6,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per id: id column, ``class_id`` (smallest id of the group), ``kept`` (it is that id).

    A group is connected by pairs with a weighted Jaccard similarity of ``percent`` or more. With the
    defaults a pair at exactly 0.8 shares a bucket with probability 0.9999. Ids are whole numbers. Defined results: rows that repeat
    an id are one document, linked by any of its texts; a null id is compared with nothing and kept, with a
    null class; a text without words (null, empty, blank) is a class of its own; an empty table gives no rows.
    """
    rows = id_and_text(documents, id_column, text_column)
    known = rows.filter("id is not null")
    signed = materialize(_signed(known, shingle, bands, band_rows), "signatures")

    sets = signed.groupBy("set_a", "set_b", "weight").agg(F.min("id").alias("rep"))
    sets = materialize(sets, "weighted-sets")
    same = ["set_a", "set_b", "weight"]
    members = signed.select("id", *same).join(sets, same).filter("id != rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    members = materialize(members.distinct(), "equal-sets")

    one_each = signed.join(sets.withColumnRenamed("rep", "id"), [*same, "id"], "left_semi").dropDuplicates([*same, "id"])
    placed = one_each.select("id", "weight", F.explode("bands").alias("key"))
    counts = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(placed.join(counts, "key"), "shared-buckets")
    # The class that meets most others leads: copies of one original differ from each other more than from it.
    met = shared.groupBy("id").agg(F.sum("n").alias("met"))
    ranked = shared.join(met, "id").withColumn("rank", F.struct(-F.col("met"), F.xxhash64("id"), "id", "weight"))
    leaders = ranked.groupBy("key").agg(F.min("rank").alias("first"))
    leaders = leaders.select("key", F.struct("first.id", "first.weight").alias("leader"))
    crowded = materialize(shared.select("key", "id", "weight").join(leaders, "key"), "buckets")
    release(shared)

    comparable = F.lit(100) * F.least("w_a", "w_b") >= F.lit(percent) * F.greatest("w_a", "w_b")
    starred = crowded.filter(F.col("id") != F.col("leader.id")).select(
        F.least("id", "leader.id").alias("a"),
        F.greatest("id", "leader.id").alias("b"),
        F.col("weight").alias("w_a"),
        F.col("leader.weight").alias("w_b"),
    )
    pairs = materialize(starred.filter(comparable).select("a", "b").distinct(), "leader-pairs")
    linked = _similar(pairs, known, shingle, percent, "leader-links").unionByName(members)
    found = materialize(connected_components(linked, "a", "b"), "leader-components")

    own = F.coalesce("component", "id")
    grouped = materialize(
        crowded.select("key", "id", "weight").join(found, F.col("id") == F.col("node"), "left").select("key", "id", "weight", own.alias("comp")),
        "bucket-components",
    )
    release(crowded)
    mixed = grouped.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low != high")
    opened = materialize(grouped.join(mixed.select("key"), "key", "left_semi"), "open-buckets")
    release(grouped)
    wanted = materialize(opened.select("id").distinct(), "open-ids")
    named = ["id", "set_a", "set_b"]
    bins = _binned(known.join(wanted, "id", "left_semi"), shingle).dropDuplicates(named)
    entries = one_each.select(*named, "marks", "bands").join(wanted, "id", "left_semi").join(bins, named)
    open_rows = opened.join(entries.drop("set_a", "set_b"), "id").filter(F.array_contains("bands", F.col("key")))
    rest = _unlinked_pairs(open_rows, percent, bands * band_rows)
    rest = materialize(rest.select("a", "b").distinct().join(pairs, ["a", "b"], "left_anti"), "open-pairs")
    release(signed, sets, pairs, opened, wanted)
    if not rest.isEmpty():
        more = _similar(rest, known, shingle, percent, "open-links")
        if not more.isEmpty():
            found = connected_components(linked.unionByName(more), "a", "b")

    ids = rows.select("id").distinct()
    classed = ids.join(found, F.col("id") == F.col("node"), "left")
    return classed.select(
        F.col("id").alias(id_column),
        F.coalesce("component", "id").alias("class_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(documents: DataFrame, id_column: str = "doc_id", **settings) -> DataFrame:
    """The rows of ``documents`` that stay, with all their columns: those of the smallest id of each group."""
    gone = near_duplicates(documents, id_column=id_column, **settings).filter("not kept").select(F.col(id_column).alias("__gone"))
    return documents.join(gone, documents[id_column] == gone["__gone"], "left_anti")
