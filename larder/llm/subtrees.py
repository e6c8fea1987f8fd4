"""Operator 13: removal of repeated word windows by prefix-partitioned suffix trees.

The suffixes of all documents, cut off after ``span`` words, are split by prefixes into groups that fit in memory, and
each group becomes one subtree of the suffix tree. Below an internal node of depth ``span`` are the occurrences of one
window; all but the first are repeats, and neighbouring ones add up to the maximal repeats, the spans removed.

* Pruning. A suffix whose window holds a 10-gram that occurs nowhere else is a leaf by itself and needs no tree.
  Not every 10-gram has to be counted: each window is represented by the least (by hash) of its eleven, which equal
  windows choose alike. One row for about six windows travels, packed by hash; runs of windows whose representative
  occurs once end here.
* Partition. Neighbouring suffixes with one representative travel as a piece, which has their words once. Pieces
  are dealt by the first two words of the suffix that starts at the representative; equal suffixes share all ten. A
  group that turns out too large for a task is dealt again by 4, then 8 and 10 words, so prefixes are only as
  long as memory asks.
* Subtree. A group's suffixes are sorted by their words; neighbours' common prefixes are the depths of the internal
  nodes. Groups come in chunks, and what is known to repeat leaves before the next chunk is added. So a passage
  in a third of all documents takes the room of one occurrence; a task holds distinct suffixes only.

Tasks also settle repeats inside their own batch of documents and send first occurrences only. Words travel as 64-bit
hashes with a dictionary per packed row; windows are equal if all their words are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.repeats import _NO_ID, PACKED, _addressed, _documents, _gathered, _merged_by_document, _pair, _rows
from larder.sources.scratch import materialize

SPAN = 20
GRAM = 10
PREFIXES = (2, 4, 8, GRAM)
BUCKET_BYTES = 16 << 20
#: Bytes of a 10-gram's hash that travel, besides its bucket; a collision only opens a run in vain.
NAME = 6
#: Distinct suffixes that one subtree may hold, and how many more are added at a time.
GROUP = 1 << 19
CHUNK = 1 << 17

_U = np.uint64
_SPANS, _RUNS, _GRAMS, _SUFFIXES = 0, 1, 2, 3


class Words:
    """The words of a batch of texts, one text after another: codes into a dictionary of 64-bit hashes."""

    def __init__(self, texts: list[bytes]):
        lists = [text.split() for text in texts]
        self.sizes = np.array([len(words) for words in lists], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        encoded = pa.array([word for words in lists for word in words], pa.binary()).dictionary_encode()
        hashes = [xxhash.xxh3_64_intdigest(word) for word in encoded.dictionary.to_pylist()]
        self.dictionary = np.array(hashes, _U)
        self.codes = encoded.indices.to_numpy(zero_copy_only=False)

    def names(self, length: int) -> np.ndarray:
        """A hash of the ``length`` words from every position on, across the ends of texts."""
        names = self.dictionary[self.codes]
        done = 1
        while 2 * done <= length:
            names = _pair(names[:-done], names[done:])
            done *= 2
        rest = length - done
        return _pair(names[:-rest], names[rest:]) if rest and len(names) > rest else names[: max(0, len(names) - rest)]


def _least_of(names: np.ndarray, count: int) -> np.ndarray:
    """Position of the least of the ``count`` names from every position on, the first of equal ones."""
    place, done = np.arange(len(names), dtype=np.int64), 1
    while done < count:
        step = min(done, count - done)
        left, right = place[:-step], place[step:]
        place = np.where(names[right] < names[left], right, left)
        done += step
    return place


def representative_runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one representative 10-gram: its hash, document, first window, number of windows."""
    empty = np.empty(0, np.int64)
    if len(words.codes) < SPAN:
        return empty.astype(_U), empty, empty, empty
    names = words.names(GRAM)
    chosen = _least_of(names, SPAN - GRAM + 1)
    doc = np.repeat(np.arange(len(words.sizes)), words.sizes)[: len(chosen)]
    inside = np.arange(len(chosen)) + SPAN <= (words.starts + words.sizes)[doc]
    begins = inside.copy()
    begins[1:] &= (chosen[1:] != chosen[:-1]) | ~inside[:-1] | (doc[1:] != doc[:-1])
    first = np.flatnonzero(begins)
    stops = np.flatnonzero(np.append(begins | ~inside, True))
    count = stops[np.searchsorted(stops, first, side="right")] - first
    return names[chosen[first]], doc[first], first - words.starts[doc[first]], count


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of one length, compressed."""
    head = "".join(f"{c.dtype.str}{c.shape[1] if c.ndim > 1 else 0};" for c in columns).encode()
    body = zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))
    return np.array([len(columns[0]), len(head)], "<u4").tobytes() + head + body


def _unpacked(blob: bytes) -> list[np.ndarray]:
    count, head = np.frombuffer(blob, "<u4", 2).tolist()
    body, at, columns = zstandard.ZstdDecompressor().decompress(blob[8 + head :]), 0, []
    for kind in blob[8 : 8 + head].decode().split(";")[:-1]:
        dtype, width = np.dtype(kind[:3]), int(kind[3:])
        column = np.frombuffer(body, dtype, count * max(1, width), at)
        at += column.nbytes
        columns.append(column.reshape(count, width) if width else column)
    return columns


def _dealt(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each bucket's entries."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    numbers, first = np.unique(bucket[order], return_index=True)
    yield from zip(numbers.tolist(), np.split(order, first[1:]), strict=True)


def _late(kind: np.ndarray, ids: np.ndarray, ties: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether an equal window starts earlier: in a smaller id, or before it in the same row."""
    order = np.lexsort((at, ties, ids, kind))
    kind, ids, ties, at = (x[order] for x in (kind, ids, ties, at))
    new = np.append(True, kind[1:] != kind[:-1])[: len(kind)]
    own = new | np.append(True, (ids[1:] != ids[:-1]) | (ties[1:] != ties[:-1]))[: len(kind)]
    late = np.empty(len(kind), bool)
    first, mine = np.flatnonzero(new)[np.cumsum(new) - 1], np.flatnonzero(own)[np.cumsum(own) - 1]
    late[order] = (ids != ids[first]) | (at != at[mine])
    return late


def _numbered(*keys: np.ndarray) -> np.ndarray:
    """Equal combinations of the keys get equal numbers."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new)
    return number


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from every start on, ``length`` of them, one stretch after another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


class Pieces:
    """Stretches of neighbouring suffixes that share their representative, each with its words once.

    A piece of n suffixes has n + ``SPAN`` - 1 words: ``codes`` into a dictionary of word hashes, one piece after
    another. ``anchor`` is the place of the representative in the piece, ``ids``, ``ties`` and ``at`` are the
    document and the place of the first word there.
    """

    def __init__(self, dictionary, codes, counts, anchor, ids, ties, at):
        self.dictionary, self.codes, self.counts, self.anchor = dictionary, codes, counts, anchor
        self.ids, self.ties, self.at = ids, ties, at
        self.lengths = counts + SPAN - 1
        self.firsts = np.cumsum(self.lengths) - self.lengths

    @classmethod
    def joined(cls, parts: list[Pieces]) -> Pieces:
        """All pieces over one sorted dictionary."""
        dictionary, number = np.unique(np.concatenate([p.dictionary for p in parts]), return_inverse=True)
        cuts = np.cumsum([0, *[len(p.dictionary) for p in parts]])
        codes = [number[low:high][p.codes] for p, low, high in zip(parts, cuts[:-1], cuts[1:], strict=True)]
        names = ("counts", "anchor", "ids", "ties", "at")
        return cls(dictionary, np.concatenate(codes), *[np.concatenate([getattr(p, name) for p in parts]) for name in names])

    @classmethod
    def unpacked(cls, blob: bytes) -> Pieces:
        parts, at = [], 0
        for _ in range(3):
            size = int(np.frombuffer(blob, "<u4", 1, at)[0])
            parts.append(_unpacked(blob[at + 4 : at + 4 + size]))
            at += 4 + size
        counts, anchor, doc, place = (x.astype(np.int64) for x in _unpacked(blob[at:]))
        return cls(parts[0][0], parts[1][0], counts, anchor, parts[2][0][doc], parts[2][1][doc], place)

    def packed(self) -> bytes:
        used = np.zeros(len(self.dictionary), bool)
        used[self.codes] = True
        small = "<u2" if np.count_nonzero(used) <= 1 << 16 else "<u4"
        codes = (np.cumsum(used) - 1).astype(small)[self.codes]
        number = _numbered(self.ties, self.ids)
        _, first, doc = np.unique(number, return_index=True, return_inverse=True)
        heads = _packed(self.dictionary[used]), _packed(codes), _packed(self.ids[first], self.ties[first])
        places = _packed(self.counts.astype("<u4"), self.anchor.astype("u1"), doc.astype("<u4"), self.at.astype("<i8"))
        return b"".join(np.array([len(x)], "<u4").tobytes() + x for x in heads) + places

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Piece of every suffix, and its place in the piece."""
        piece = np.repeat(np.arange(len(self.counts)), self.counts)
        return piece, _ragged(np.zeros(len(self.counts), np.int64), self.counts)

    def kept(self, stay: np.ndarray) -> Pieces:
        """The pieces of the suffixes that stay; a gap ends a piece."""
        piece, offset = self.windows()
        begins = stay.copy()
        begins[1:] &= ~stay[:-1] | (piece[1:] != piece[:-1])
        first = np.flatnonzero(begins)
        stops = np.flatnonzero(np.append(begins | ~stay, True))
        counts = stops[np.searchsorted(stops, first, side="right")] - first
        own, offset = piece[first], offset[first]
        codes = self.codes[_ragged(self.firsts[own] + offset, counts + SPAN - 1)]
        return Pieces(self.dictionary, codes, counts, self.anchor[own] - offset, self.ids[own], self.ties[own], self.at[own] + offset)

    def taken(self, places: np.ndarray) -> Pieces:
        codes = self.codes[_ragged(self.firsts[places], self.lengths[places])]
        columns = (getattr(self, name)[places] for name in ("counts", "anchor", "ids", "ties", "at"))
        return Pieces(self.dictionary, codes, *columns)

    def dealt(self, prefix: int, buckets: int) -> Iterator[tuple[int, Pieces]]:
        """Groups by the first ``prefix`` words of the suffix at the representative, which equal suffixes share."""
        name = np.zeros(len(self.counts), _U)
        for i in range(prefix):
            name = _pair(name, self.dictionary[self.codes[self.firsts + self.anchor + i]])
        for bucket, places in _dealt(((name >> _U(20)) % _U(buckets)).astype(np.int64)):
            yield bucket, self.taken(places)

    def subtree(self) -> tuple[np.ndarray, np.ndarray]:
        """The suffix tree of the group: order of its leaves, and depth in words of the node between neighbours."""
        piece, offset = self.windows()
        codes = self.codes[(self.firsts[piece] + offset)[:, None] + np.arange(SPAN)].astype(">u4")
        order = np.argsort((codes + np.array(1, ">u4")).astype(">u4").view(f"S{4 * SPAN}").ravel(), kind="stable")
        codes = codes[order]
        differs = codes[1:] != codes[:-1]
        depth = np.where(differs.any(axis=1), differs.argmax(axis=1), SPAN)
        return order, depth

    def repeated(self) -> np.ndarray:
        """Leaves below a node of full depth that are not its first occurrence."""
        order, depth = self.subtree()
        node = np.empty(len(order), np.int64)
        node[order] = np.cumsum(np.append(0, depth < SPAN))[: len(order)]
        piece, offset = self.windows()
        return _late(node, self.ids[piece], self.ties[piece], self.at[piece] + offset)

    def spans(self, some: np.ndarray, buckets: int) -> pa.RecordBatch:
        """The words of some suffixes as spans, addressed to their documents."""
        piece, offset = (x[some] for x in self.windows())
        start = self.at[piece] + offset
        return _addressed(_SPANS, _merged_by_document(self.ids[piece], self.ties[piece], start, start + SPAN), buckets)


def _suffix_rows(found: Pieces, prefix: int, buckets: int) -> pa.RecordBatch:
    return _rows(_SUFFIXES, {bucket: group.packed() for bucket, group in found.dealt(prefix, buckets)})


def _met(sent: DataFrame, buckets: int) -> DataFrame:
    """Packed rows of a bucket next to each other in one task, after those that only pass through."""
    return sent.repartition(buckets, "bucket").sortWithinPartitions("kind", "bucket")


def _split(batches: Iterator[pa.RecordBatch], kind: int, passed: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket and blob of the rows of one kind; the others are put aside."""
    for batch in batches:
        own = pa.compute.equal(batch.column(0), kind)
        rest = batch.filter(pa.compute.invert(own))
        passed.append(pa.RecordBatch.from_arrays(rest.columns, ["kind", "bucket", "blob"]))
        yield batch.filter(own).select([1, 2])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield bucket, blob.as_py()


def shared_runs(rows: DataFrame, buckets: int) -> DataFrame:
    """Runs of windows whose representative occurs more than once, per document: id, tie, pairs (first, number)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, texts = _documents(batch)
            gram, doc, at, count = representative_runs(Words(texts))
            _, first, number, times = np.unique(gram, return_index=True, return_inverse=True, return_counts=True)
            known = times[number] > 1
            yield _addressed(_RUNS, (ids[doc[known]], ties[doc[known]], at[known], count[known]), buckets)
            # One entry per 10-gram; one that this batch has twice asks for no answer.
            kept = np.where(times > 1, 0, count[first])
            order = np.lexsort((at[first], doc[first]))
            first, kept = first[order], kept[order]
            found = {}
            for bucket, places in _dealt((gram[first] % _U(buckets)).astype(np.int64)):
                own = first[places]
                used, number = np.unique(doc[own], return_inverse=True)
                name = (gram[own] // _U(buckets)).astype("<u8").view("u1").reshape(-1, 8)[:, :NAME]
                entries = _packed(name, kept[places].astype("<u1"), number.astype("<u4"), np.diff(at[own], prepend=0))
                head = _packed(ids[used], ties[used])
                found[bucket] = np.array([len(head)], "<u4").tobytes() + head + entries
            yield _rows(_GRAMS, found)

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed: list[pa.RecordBatch] = []
        held, current = [], None

        def answers() -> pa.RecordBatch:
            name, count, ids, ties, at = (np.concatenate(c) for c in zip(*held, strict=True))
            whole = np.zeros((len(name), 8), np.uint8)
            whole[:, :NAME] = name
            _, number, times = np.unique(whole.view("<u8").ravel(), return_inverse=True, return_counts=True)
            asked = (count > 0) & (times[number] > 1)
            return _addressed(_RUNS, (ids[asked], ties[asked], at[asked], count[asked].astype(np.int64)), buckets)

        for bucket, blob in _groups(_split(batches, _GRAMS, passed)):
            while passed:
                yield passed.pop()
            if bucket != current and held:
                yield answers()
                held = []
            current = bucket
            size = int(np.frombuffer(blob, "<u4", 1)[0])
            ids, ties = _unpacked(blob[4 : 4 + size])
            name, count, doc, steps = _unpacked(blob[4 + size :])
            held.append((name, count, ids[doc], ties[doc], np.cumsum(steps)))
        if held:
            yield answers()
        yield from passed

    met = _met(rows.mapInArrow(send, PACKED), buckets).mapInArrow(settle, PACKED)
    return _gathered(met, buckets, merge=False)


def repeated_spans(candidates: DataFrame, buckets: int) -> list[DataFrame]:
    """Spans of repeated windows (packed, by document bucket) among the runs of ``candidates`` (id, tie, text, pairs)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties, texts = _documents(batch)
            words = Words(texts)
            lists = [np.frombuffer(runs.as_buffer(), "<i8").reshape(-1, 2) for runs in batch.column(3)]
            if not lists:
                continue
            doc = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            at, counts = np.concatenate(lists).T
            start = words.starts[doc] + at
            grams = words.names(GRAM)[start[:, None] + np.arange(SPAN - GRAM + 1)]
            codes = words.codes[_ragged(start, counts + SPAN - 1)]
            pieces = Pieces(words.dictionary, codes, counts, grams.argmin(axis=1), ids[doc], ties[doc], at)
            piece, offset = pieces.windows()
            place = start[piece] + offset
            check = _pair(words.names(SPAN - 1)[place], words.dictionary[words.codes[place + SPAN - 1]])
            equal = _numbered(words.names(SPAN)[place], check)
            late = _late(equal, pieces.ids[piece], pieces.ties[piece], at[piece] + offset)
            yield pieces.spans(late, buckets)
            yield _suffix_rows(pieces.kept(~late), PREFIXES[0], buckets)

    def grown(longer: int | None):
        """Builds the subtree of every group; one that holds too much goes on, dealt by a longer prefix."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            passed: list[pa.RecordBatch] = []
            current, held, pending, size, over = None, [], 0, 0, False

            def settle() -> Iterator[pa.RecordBatch]:
                nonlocal held, pending, size
                group = Pieces.joined(held)
                late = group.repeated()
                yield group.spans(late, buckets)
                held, pending = [group.kept(~late)], 0
                size = int(held[0].counts.sum())

            for bucket, blob in _groups(_split(batches, _SUFFIXES, passed)):
                while passed:
                    yield passed.pop()
                if bucket != current:
                    if pending:
                        yield from settle()
                    current, held, pending, size, over = bucket, [], 0, 0, False
                part = Pieces.unpacked(blob)
                if over:
                    yield _suffix_rows(part, longer, buckets)
                    continue
                held.append(part)
                pending += int(part.counts.sum())
                if pending >= max(CHUNK, size):
                    yield from settle()
                    if longer and size > GROUP:
                        yield _suffix_rows(held[0], longer, buckets)
                        held, over = [], True
            if pending:
                yield from settle()
            yield from passed

        return run

    sent, found = candidates.mapInArrow(send, PACKED), []
    for longer in [*PREFIXES[1:], None]:
        done = materialize(_met(sent, buckets).mapInArrow(grown(longer), PACKED), "subtrees")
        found.append(done.filter(F.col("kind") == _SPANS))
        sent = done.filter(F.col("kind") == _SUFFIXES)
        if sent.isEmpty():
            break
    return found


def task_buckets(rows: DataFrame) -> int:
    """Tasks that equal keys meet in: the number of shuffle partitions, and at least one for ``BUCKET_BYTES`` of text."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / BUCKET_BYTES))


def without_repeated_windows(
    documents: DataFrame, buckets: int | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``spans`` (first word and end of what is removed), ``kept`` (text).

    Removes every word covered by a window of ``SPAN`` words that also starts earlier, in a row with a smaller id
    or before it in the same row; windows are judged on the input. ``kept`` joins the words that stay by one space.

    Ids are whole numbers. Defined results: null and short texts keep everything; a null id is smaller than any
    other; rows that repeat an id never remove each other's words; an empty table gives no rows. Other columns
    are not read. ``buckets`` is the number of tasks that equal keys meet in, by default from the size of the texts.
    """
    rows = documents.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_NO_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_column), F.lit(""))).alias("tie"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    buckets = buckets or task_buckets(rows)
    opened = shared_runs(rows, buckets)
    candidates = rows.join(opened, ["id", "tie"]).select("id", "tie", "text", "pairs")
    found = repeated_spans(candidates, buckets)
    spans = _gathered(reduce(DataFrame.unionByName, found), buckets, merge=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept = [], [], []
            for text, packed in zip(batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
                words = text.as_py().split()
                pairs = np.frombuffer(packed or b"", "<i8").reshape(-1, 2).tolist()
                counts.append(len(words))
                gone.append([{"start": a, "end": b} for a, b in pairs])
                for a, b in reversed(pairs):
                    del words[a:b]
                kept.append(b" ".join(words).decode())
            removed = [sum(span["end"] - span["start"] for span in spans) for spans in gone]
            spans = pa.array(gone, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), spans, pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "spans", "kept"])

    joined = rows.join(spans, ["id", "tie"], "left").select("id", "text", "pairs")
    schema = "id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"
    own = F.when(F.col("id") != _NO_ID, F.col("id")).alias(id_column)
    return joined.mapInArrow(cut, schema).select(own, "n_words", "n_removed", "spans", "kept")
