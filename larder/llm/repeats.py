"""Operator 2: removal of repeated byte strings by distributed prefix doubling.

A position's rank names the string of some length that starts there. Ranks of twice the length are pairs
of ranks at an offset, so equal ranks mean equal strings. The first rounds (1, 2, 4, 8, 16, 25 bytes) need
no exchange, since ranks are hashes that every machine computes alike; round by round, Spark then brings
equal ranks together, tasks sort the (rank, position) pairs, and what is unique drops out:

* Round 25. Not every position is sent, but runs: the 26 ranks of 25 bytes inside a position's ``span``
  bytes (50 by default) have a least one, and neighbouring positions with the same least rank form a run.
  Equal strings of 50 bytes lie in runs of the same least rank, so runs whose rank occurs in one document
  only drop out. That is one row for about 13 bytes, and most of them end here.
* Round of the runs. Runs of one rank are sorted by the rank of everything they cover. A run that an
  earlier document has as well is settled, past the threshold, without a look at its positions.
* Round 50. Runs of one rank that differ as a whole, but agree with another in the 13 bytes left or right
  of the common 25 (two strings of 50 bytes cannot agree otherwise), are opened: the pairs of
  ranks at p and p + 25 of their positions are sorted, and a position whose pair occurs in an
  earlier document starts a repeated string. Where the least rank recurs inside 50 bytes (periodic text),
  documents can differ in which occurrence is the common one, so such runs of a shared rank are all opened.

Pairs travel packed, one row per batch of documents and bucket of ranks, and only the smallest document of a
batch sends a string that several have; the others of the batch know already that they are not first. So
a string that every document contains costs one entry per batch, in whichever bucket it falls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.sources.scratch import materialize

HALF = 25
SPAN = 2 * HALF
WINDOW = HALF + 1
SIDE = 13
CHUNK = 128 * 1024

_U = np.uint64
_BYTES = np.random.default_rng(3).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_ROW = np.dtype([("rank", "<u8"), ("whole", "<u4"), ("left", "<u2"), ("right", "<u2"), ("again", "u1")])
_NO_ID = -(1 << 63)


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of two ranks next to each other."""
    h = a * _U(0x9E3779B97F4A7C15)
    h ^= b
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(32)
    return h


def _ranks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of 8 and of 25 bytes of every position that has so many after it."""
    rank = _BYTES[data]
    for length in (1, 2, 4):
        rank = _pair(rank[:-length], rank[length:])
    eight = rank
    sixteen = _pair(rank[:-8], rank[8:])
    return eight, _pair(sixteen[: -(HALF - 16)], sixteen[HALF - 16 :])


def _least(ranks: np.ndarray) -> np.ndarray:
    """The least of each 26 neighbours."""
    for step in (1, 2, 4, 8):
        ranks = np.minimum(ranks[:-step], ranks[step:])
    return np.minimum(ranks[: -(WINDOW - 16)], ranks[WINDOW - 16 :])


def _stretches(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in pieces of about ``CHUNK`` bytes: data, document, start and end of the document per byte.

    Short texts are put together, long ones cut with an overlap, so memory does not grow with a text. Start
    and end are relative to the piece; a cut document starts before or ends after it.
    """
    held: list[tuple[int, int, bytes, int]] = []
    size = 0

    def packed() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lengths = np.array([len(part) for _, _, part, _ in held])
        first = np.cumsum(lengths) - lengths
        data = np.frombuffer(b"".join(part for _, _, part, _ in held), np.uint8)
        number = np.repeat([i for i, _, _, _ in held], lengths)
        start = np.repeat(first - [offset for _, offset, _, _ in held], lengths)
        end = np.repeat(first - [offset for _, offset, _, _ in held] + [whole for _, _, _, whole in held], lengths)
        return data, number, start, end

    for i, text in enumerate(texts):
        if len(text) < SPAN:
            continue
        # A piece repeats the bytes around its cuts that ranks of its positions look at.
        for offset in range(0, max(1, len(text) - SPAN + 1), CHUNK):
            low, high = max(0, offset - 2 * SPAN), offset + CHUNK + 2 * SPAN
            part = text[low:high]
            held.append((i, low, part, len(text)))
            size += len(part)
            if size >= CHUNK:
                yield packed()
                held, size = [], 0
    if held:
        yield packed()


def _runs(texts: list[bytes]) -> dict[str, np.ndarray]:
    """All runs of the texts: row (ranks), document number, first position, number of positions."""
    found: dict[str, list[np.ndarray]] = {"row": [], "doc": [], "at": [], "n": []}
    for data, number, start, end in _stretches(texts):
        if len(data) < SPAN:
            continue
        eight, half = _ranks(data)
        least = _least(half)
        count = len(least)
        place = np.arange(count)
        inside = (place + SPAN <= end[:count]) & (number[:count] == number[SPAN - 1 : count + SPAN - 1])
        begins = np.ones(count, bool)
        begins[1:] = (least[1:] != least[:-1]) | (number[1:count] != number[: count - 1]) | ~inside[:-1]
        begins |= (place - start[:count]) % CHUNK == 0  # a cut text is cut here in either piece
        first = np.flatnonzero(begins & inside)
        if not len(first):
            continue
        stops = np.flatnonzero(np.append(begins | ~inside, True))
        last = stops[np.searchsorted(stops, first, side="right")] - 1
        # Runs longer than a window (periodic texts) are cut at multiples of its size.
        pieces = (last - first) // WINDOW + 1
        if (pieces > 1).any():
            again = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first, last = np.repeat(first, pieces) + again * WINDOW, np.repeat(last, pieces)
            last = np.minimum(last, first + WINDOW - 1)
        whole = _pair(_pair(_pair(half[first], half[first + HALF]), _pair(half[last], half[last + HALF])), (last - first).astype(_U))
        anchor = last + np.argmin(np.stack([half[np.minimum(last + k, len(half) - 1)] for k in range(WINDOW)]), axis=0)
        thirteen = lambda p: _pair(eight[p], eight[p + SIDE - 8]) >> _U(48) | _U(1)
        row = np.empty(len(first), _ROW)
        row["rank"], row["whole"] = least[first], whole >> _U(32)
        occurs = np.zeros(len(first), np.uint8)
        for k in range(2 * WINDOW - 1):
            place = np.minimum(first + k, last + WINDOW - 1)
            occurs += (half[place] == row["rank"]) & (first + k <= last + WINDOW - 1)
        row["again"] = occurs > 1
        for name, side, fits in (
            ("left", anchor - SIDE, anchor - SIDE >= start[first]),
            ("right", anchor + HALF, anchor + HALF + SIDE <= end[first]),
        ):
            seen = (side >= 0) & (side + SIDE <= len(data)) & fits
            row[name] = np.where(seen, thirteen(np.where(seen, side, 0)), 0)
        # Positions in the overlap belong to the other piece of a cut text.
        own = first - start[first]
        found["row"].append(row)
        found["doc"].append(number[first])
        found["at"].append(own)
        found["n"].append(last - first + 1)
    return {k: np.concatenate(v) if v else np.empty(0, _ROW if k == "row" else np.int64) for k, v in found.items()}


def _pack(row: np.ndarray, doc: np.ndarray, at: np.ndarray, n: np.ndarray, ids: np.ndarray, ties: np.ndarray) -> bytes:
    """One bucket of a batch; positions as differences, which compress."""
    used, number = np.unique(doc, return_inverse=True)
    order = np.lexsort((at, number))
    row, number, at, n = row[order], number[order], at[order], n[order]
    tail = [
        np.diff(number, prepend=0).astype("<u4"),
        np.diff(at, prepend=0).astype("<i8"),
        n.astype("<u1"),
        ids[used].astype("<i8"),
        ties[used].astype("<i8"),
    ]
    packed = zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in tail))
    return np.array([len(row), len(used)], "<u4").tobytes() + row.tobytes() + packed


def _unpack(blob: bytes, kind: np.dtype) -> dict[str, np.ndarray]:
    count, docs = np.frombuffer(blob, "<u4", 2).tolist()
    row = np.frombuffer(blob, kind, count, 8)
    tail = zstandard.ZstdDecompressor().decompress(blob[8 + count * kind.itemsize :])
    take, at = [], 0
    for dtype, size in (("<u4", count), ("<i8", count), ("<u1", count), ("<i8", docs), ("<i8", docs)):
        take.append(np.frombuffer(tail, dtype, size, at))
        at += size * np.dtype(dtype).itemsize
    number = np.cumsum(take[0], dtype=np.int64)
    return {"row": row, "id": take[3][number], "tie": take[4][number], "at": np.cumsum(take[1]), "n": take[2].astype(np.int64)}


def _first_of(groups: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id of each row's group; equal groups are neighbours."""
    if not len(groups):
        return ids
    first = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
    return np.repeat(np.minimum.reduceat(ids, first), np.diff(np.append(first, len(groups))))


def _merged(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Maximal spans (rows of start and end) of spans in order of their start."""
    reach = np.maximum.accumulate(end)
    fresh = np.append(True, start[1:] > reach[:-1])
    return np.stack([start[fresh], reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(reach) - 1)]], axis=1)


def _merged_by_document(ids: np.ndarray, ties: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """The same for the spans of many documents: ids, ties, starts, ends, in order of documents and starts."""
    if not len(ids):
        return ids, ties, start, end
    order = np.lexsort((start, ties, ids))
    ids, ties, start, end = (x[order] for x in (ids, ties, start, end))
    new = np.append(True, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]))
    base = (np.cumsum(new) - 1) << 40
    merged = _merged(start + base, end + base)
    document = merged[:, 0] >> 40
    first = np.flatnonzero(new)[document]
    return ids[first], ties[first], merged[:, 0] - (document << 40), merged[:, 1] - (document << 40)


#: Rows of all exchanges: packed (rank, position) pairs for a bucket of ranks, or for a bucket of documents
#: spans to remove or runs to open, each as columns id, tie, first position and end or number.
PACKED = "kind int, bucket int, blob binary"
_SPANS, _OPEN, _RANKS = 0, 1, 2


def _rows(kind: int, found: dict[int, bytes]) -> pa.RecordBatch:
    arrays = [
        pa.array([kind] * len(found), pa.int32()),
        pa.array(list(found.keys()), pa.int32()),
        pa.array(list(found.values()), pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["kind", "bucket", "blob"])


def _addressed(kind: int, columns: tuple[np.ndarray, ...], buckets: int) -> pa.RecordBatch:
    """Columns (id, tie, ...) packed for the buckets of their documents."""
    bucket = (_pair(columns[0].astype(np.int64).view(_U), columns[1].astype(np.int64).view(_U)) % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    compress = zstandard.ZstdCompressor(level=1).compress
    found = {}
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        part = order[cuts[b] : cuts[b + 1]]
        found[b] = compress(b"".join(c[part].astype("<i8").tobytes() for c in columns))
    return _rows(kind, found)


def _late_spans(ids: np.ndarray, ties: np.ndarray, at: np.ndarray, n: np.ndarray, buckets: int) -> pa.RecordBatch:
    return _addressed(_SPANS, _merged_by_document(ids, ties, at, at + n + SPAN - 1), buckets)


def _send(row: np.ndarray, doc, at, n, group: np.ndarray, ids, ties, buckets: int) -> Iterator[pa.RecordBatch]:
    """A batch's rows by bucket, and the spans that the batch itself shows not to be first.

    ``group`` numbers equal rows; only those of its smallest id are sent.
    """
    if not len(row):
        return
    order = np.argsort(group, kind="stable")
    row, doc, at, n, group = row[order], doc[order], at[order], n[order], group[order]
    late = ids[doc] > _first_of(group, ids[doc])
    yield _late_spans(ids[doc[late]], ties[doc[late]], at[late], n[late], buckets)
    row, doc, at, n = (x[~late] for x in (row, doc, at, n))
    bucket = (row[row.dtype.names[0]] % _U(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    found = {}
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        part = order[cuts[b] : cuts[b + 1]]
        found[b] = _pack(row[part], doc[part], at[part], n[part], ids, ties)
    yield _rows(_RANKS, found)


def _gathered(packed: DataFrame, buckets: int, merge: bool) -> DataFrame:
    """One row per document of packed columns: id, tie, pairs (packed); spans are merged."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _by_bucket(batches, None):
            ids, ties, a, b = (held[k] for k in ("id", "tie", "at", "n"))
            if merge:
                ids, ties, a, b = _merged_by_document(ids, ties, a, b)
            else:
                order = np.lexsort((a, ties, ids))
                ids, ties, a, b = (x[order] for x in (ids, ties, a, b))
            first = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1])))
            pairs = np.stack([a, b], axis=1)
            packs = [part.tobytes() for part in np.split(pairs, first[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(ids[first]), pa.array(ties[first]), pa.array(packs, pa.binary())], ["id", "tie", "pairs"])

    dealt = packed.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return dealt.select("bucket", "blob").mapInArrow(gather, "id long, tie long, pairs binary")


def _documents(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    ties = batch.column(1).to_numpy(zero_copy_only=False)
    return ids, ties, batch.column(2).cast(pa.binary()).to_pylist()


def _equal_rows(row: np.ndarray, names: list[str]) -> np.ndarray:
    order = np.lexsort([row[name] for name in reversed(names)])
    new = np.ones(len(row), bool)
    new[1:] = np.logical_or.reduce([row[name][order][1:] != row[name][order][:-1] for name in names])
    group = np.empty(len(row), np.int64)
    group[order] = np.cumsum(new)
    return group


def _columns(blob: bytes) -> dict[str, np.ndarray]:
    columns = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), "<i8").reshape(4, -1)
    return dict(zip(("id", "tie", "at", "n"), columns, strict=True))


def _by_bucket(batches: Iterator[pa.RecordBatch], kind: np.dtype | None) -> Iterator[dict[str, np.ndarray]]:
    """All rows of one bucket at a time: packed pairs of ``kind``, or columns. The batches are in order of bucket."""
    held, current = [], None
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != current and held:
                yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}
                held = []
            current = bucket
            held.append(_unpack(blob.as_py(), kind) if kind else _columns(blob.as_py()))
    if held:
        yield {k: np.concatenate([h[k] for h in held]) for k in held[0]}


def _round(sent: DataFrame, kind: np.dtype, buckets: int, settle) -> DataFrame:
    """Bring equal ranks together and settle each bucket; what has been found already passes through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def ranked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ranks = pa.compute.equal(batch.column(0), _RANKS)
                waiting.append(batch.filter(pa.compute.invert(ranks)))
                yield batch.filter(ranks).select([1, 2])

        for held in _by_bucket(ranked(), kind):
            yield from settle(held)
            while waiting:
                yield waiting.pop()
        yield from waiting

    dealt = sent.repartition(buckets, "bucket").sortWithinPartitions("kind", "bucket")
    return dealt.mapInArrow(run, PACKED)


def removable_spans(rows: DataFrame, buckets: int) -> DataFrame:
    """Spans of ``rows`` (id, tie, text) that repeat an earlier document: id, tie, pairs (packed), one row each."""

    def send_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, texts = _documents(batch)
            runs = _runs(texts)
            group = _equal_rows(runs["row"], ["rank", "whole"])
            yield from _send(runs["row"], runs["doc"], runs["at"], runs["n"], group, ids, ties, buckets)

    def settle_runs(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((held["id"], held["row"]["whole"], held["row"]["rank"]))
        row, ids, ties, at, n = (held[k][order] for k in ("row", "id", "tie", "at", "n"))
        rank, whole = row["rank"], row["whole"]
        new = np.append(True, rank[1:] != rank[:-1])
        differs = new | np.append(True, whole[1:] != whole[:-1])
        variant = np.cumsum(differs)
        late = ids > _first_of(variant, ids)
        yield _late_spans(ids[late], ties[late], at[late], n[late], buckets)
        # Runs of a rank that several documents have, and that agree with another beside the common part.
        first = np.flatnonzero(new)
        shared = (np.maximum.reduceat(ids, first) != np.minimum.reduceat(ids, first))[np.cumsum(new) - 1]
        agrees = np.zeros(len(row), bool)
        for side in ("left", "right"):
            value = row[side]
            by = np.lexsort((variant, value, rank))
            fresh = np.append(True, (rank[by][1:] != rank[by][:-1]) | (value[by][1:] != value[by][:-1]))
            low, high = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            several = np.maximum.reduceat(variant[by], low) != np.minimum.reduceat(variant[by], low)
            agrees[by] |= several[high] & (value[by] != 0)
        # The common part can be another occurrence of the least rank in each document: sides say nothing then.
        again = np.maximum.reduceat(row["again"], first)[np.cumsum(new) - 1] > 0
        opened = shared & (agrees | again) & ~late
        yield _addressed(_OPEN, tuple(x[opened] for x in (ids, ties, at, n)), buckets)

    settled = materialize(_round(rows.mapInArrow(send_runs, PACKED), _ROW, buckets, settle_runs), "settled-runs")
    opened = _gathered(settled.filter(F.col("kind") == _OPEN), buckets, merge=False)
    pair = np.dtype([("rank", "<u8"), ("pair", "<u4")])

    def send_positions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, texts = _documents(batch)
            row, doc, at = [np.empty(0, pair)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for i, (text, runs) in enumerate(zip(texts, batch.column(3), strict=True)):
                starts, counts = np.frombuffer(runs.as_buffer(), "<i8").reshape(-1, 2).T
                place = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
                place = np.unique(place)
                data = np.frombuffer(text, np.uint8)
                for low in range(0, len(data), CHUNK):
                    some = place[(place >= low) & (place < low + CHUNK)]
                    if len(some):
                        _, half = _ranks(data[low : low + CHUNK + SPAN])
                        a, b = half[some - low], half[some - low + HALF]
                        found = np.empty(len(some), pair)
                        found["rank"], found["pair"] = _pair(a, b), _pair(b, a) >> _U(32)
                        row.append(found)
                        doc.append(np.full(len(some), i))
                        at.append(some)
            row, doc, at = np.concatenate(row), np.concatenate(doc), np.concatenate(at)
            group = _equal_rows(row, ["rank", "pair"])
            yield from _send(row, doc, at, np.ones(len(row), np.int64), group, ids, ties, buckets)

    def settle_positions(held: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((held["id"], held["row"]["pair"], held["row"]["rank"]))
        row, ids, ties, at, n = (held[k][order] for k in ("row", "id", "tie", "at", "n"))
        differs = np.append(True, (row["rank"][1:] != row["rank"][:-1]) | (row["pair"][1:] != row["pair"][:-1]))
        late = ids > _first_of(np.cumsum(differs), ids)
        yield _late_spans(ids[late], ties[late], at[late], n[late], buckets)

    candidates = rows.join(opened, ["id", "tie"]).select("id", "tie", "text", "pairs")
    more = _round(candidates.mapInArrow(send_positions, PACKED), pair, buckets, settle_positions)
    return _gathered(settled.filter(F.col("kind") == _SPANS).unionByName(more), buckets, merge=True)


def without_repeats(
    documents: DataFrame, buckets: int | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary, the bytes that stay).

    Removes every byte covered by a 50-byte string that also starts in a row with a smaller id; strings may
    overlap and are judged on the input. ``buckets`` is the number of tasks that equal ranks meet in (by
    default the number of shuffle partitions); a task holds its bucket, about 40 bytes for 13 of text.
    Ids are whole numbers. Defined results: null and short texts keep everything; a null id is smaller than any
    other; rows that repeat an id never remove each other's bytes; an empty table gives no rows. Further
    columns are not read.
    """
    spark = documents.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("tie"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    spans = removable_spans(rows, buckets)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, packed in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                text = text.as_py()
                if not packed:
                    out.append((len(text), 0, 0, text))
                    continue
                gone = np.frombuffer(packed, "<i8").reshape(-1, 2).tolist()
                ends = [0, *[end for _, end in gone]]
                starts = [*[start for start, _ in gone], len(text)]
                kept = b"".join(text[a:b] for a, b in zip(ends, starts, strict=True))
                out.append((len(text), len(text) - len(kept), len(gone), kept))
            sizes = [pa.array([row[i] for row in out], pa.int64()) for i in range(3)]
            kept = pa.array([row[3] for row in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *sizes, kept], ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(spans, ["id", "tie"], "left").select("id", "text", "pairs")
    done = joined.mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary")
    own = F.when(F.col("id") != _NO_ID, F.col("id")).alias(id_column)
    return done.select(own, "n_bytes", "n_removed", "n_spans", "kept")

