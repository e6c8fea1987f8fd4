"""Operator 3: language-model scoring with a causal self-attention model on subword ids.

1. Documents are dealt into chunks, which keep them as the places of their words among the chunk's distinct words. These
   words go to buckets by their hash with their training counts, packed; a bucket's task sums the counts of equal words,
   spells each by subwords once, and sends counts and subword ids back to the chunks. There they meet the documents,
   which are stored with the counts of their words, their base score and their subword ids: no text is read again.
2. Neighbouring subwords of all training documents are counted, within words over the distinct words and across
   words over the documents. They give the classes of subwords, which of them get embeddings, and the tables.
3. One task trains the attention on a few training documents, as a start. Each task then goes on training
   with all windows of its training documents, and the tasks' parameters are averaged, weighted by windows. Documents
   are dealt to these tasks by their ids, in groups whose number follows that of the documents, and are read in order.
4. The model scores the subword ids of all documents in overlapping windows. A word's probability is that of its
   spelling by subwords, which includes that the word ends there, mixed half and half with its share of the training
   words, which knows whole words that subwords have to spell.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm import attention
from larder.llm.bpe import TreeEncoder, encoder
from larder.sources.scratch import materialize, release, shuffles_dropped

LEAF = 256
GROUP_WORDS = 1 << 15
GROUP_SUBWORDS = 1 << 20
#: Training documents whose windows the attention sees one after another, before the mean with others.
GROUP_ROWS = 4_096
#: Weight of a word's share of the training words beside its spelling by subwords.
MIXED = 0.5


def words_of(text: str) -> list[bytes]:
    """Words of a text, A-Z in lower case; bytes split at the ASCII white space, as the contract does."""
    return text.encode().lower().split()


def subwords(tree: TreeEncoder, word: bytes) -> bytes:
    """Ids of a word and the space before it, as 32-bit integers."""
    return tree.pieces[word.decode()]


def mixed_log10(shares: np.ndarray, spelled: np.ndarray) -> np.ndarray:
    """log10 of words' probabilities from their shares of the training words and the natural logs of their spellings."""
    with np.errstate(divide="ignore"):  # a share of 0 adds nothing
        return np.logaddexp(np.log(MIXED * shares), np.log(1 - MIXED) + spelled) / np.log(10)


def spelled_logs(subword_logs: np.ndarray, opening: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Natural logs of words' spellings, for words in order, each text closed by its end (``ends``).

    A word is spelled by a first subword out of those that open a word or end the text, its further ones, and the
    chance that an opening one follows. The end needs nothing to follow. These sum to 1 over all spellings.
    """
    follows = np.append(opening[1:], 0.0)
    return subword_logs - opening + np.where(ends, 0.0, follows)


def _sequence(tree: TreeEncoder, words: list[bytes], end: bool) -> np.ndarray:
    texts = b" ".join(words).decode().split(" ") if words else []
    ids = np.frombuffer(b"".join(map(tree.pieces.__getitem__, texts)), "<u4").astype(np.int64)
    return np.append(ids, len(tree.token_bytes) - 1) if end else ids


def _kind_of(size: int) -> np.dtype:
    return np.min_scalar_type(size).newbyteorder("<")


def _id_type(tree: TreeEncoder) -> np.dtype:
    return _kind_of(len(tree.token_bytes))


def encoded(training: DataFrame, tokenizer: str) -> DataFrame:
    """``ids`` of training documents: the subwords of the whole text and the end, packed. They may be encoded already."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(tokenizer, LEAF)
        kind = _id_type(tree)
        for batch in batches:
            ids = [_sequence(tree, words_of(text.as_py()), True).astype(kind).tobytes() for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    return training.select("ids") if "ids" in training.columns else training.select("text").mapInArrow(encode, "ids binary")


def _groups(batches: Iterator[pa.RecordBatch], kind: np.dtype, most: int) -> Iterator[list[np.ndarray]]:
    """Subword ids of whole texts, in groups of about ``most`` ids."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for ids in batch.column(0):
            held.append(np.frombuffer(ids.as_py(), kind))
            size += len(held[-1])
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


def _windows(sequences: list[np.ndarray], end: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All windows of the sequences, a long one's in parts of ``most`` ids (a multiple of the stride)."""
    stride = attention.STRIDE
    yield attention.windows([ids[:most] for ids in sequences], end)[:2]
    for ids in sequences:
        for low in range(most, len(ids), most):
            # Two blocks ahead are seen, not learned from again.
            seen, wanted, _ = attention.windows([ids[low - 2 * stride : low + most]], end)
            yield seen[2:], wanted[2:]


def attention_parameters(
    training: DataFrame, tokenizer: str, tables: attention.Tables, start: attention.Parameters, rounds: int, rate: float
) -> attention.Parameters:
    """Each task trains from ``start`` with every window of its texts; the mean of the tasks, weighted by their windows."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, mine, weight = encoder(tokenizer, LEAF), start, 0
        to_head, to_class = np.append(tables.heads, -1).astype(np.int16), np.append(tables.classes, -1).astype(np.int16)
        for sequences in _groups(batches, _id_type(tree), GROUP_SUBWORDS):
            for seen, wanted in _windows(sequences, len(tables.classes) - 1, GROUP_SUBWORDS):
                mine = attention.train(mine, tables.before, to_head[seen], to_class[wanted], rounds, rate)
                weight += len(seen)
        if weight:
            arrays = [pa.array([weight], pa.int64()), pa.array([attention.flatten(mine).tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["weight", "parameters"])

    trained = encoded(training, tokenizer).mapInArrow(learn, "weight long, parameters array<double>")
    each = trained.select("weight", F.posexplode("parameters").alias("place", "value"))
    means = each.groupBy("place").agg((F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).alias("mean"))
    found = sorted((row["place"], row["mean"]) for row in means.collect())  # as many as the model has parameters
    return attention.unflatten(np.array([mean for _, mean in found])) if found else start


def _order(training: DataFrame) -> str:
    """What orders the texts of one id: the text, or its place among those of the chunk."""
    return "place" if "place" in training.columns else "text"


def in_groups(training: DataFrame, rows: int) -> DataFrame:
    """Training documents in as many ordered partitions as ``rows`` asks for, so that the layout of the input is no matter."""
    return training.repartition(-(-max(1, rows) // GROUP_ROWS), F.hash("id")).sortWithinPartitions("id", _order(training))


def started_parameters(training: DataFrame, tokenizer: str, tables: attention.Tables, sample: int, rounds: int) -> attention.Parameters:
    """Where all tasks start: one task's training with at most ``sample`` ids (repeated rows: twice as many rows)."""
    chosen = materialize(training.select("id").orderBy(F.xxhash64("id"), "id").limit(sample).distinct(), "lm-sample-ids")
    texts = training.join(chosen, "id", "left_semi").orderBy("id", _order(training)).limit(2 * sample)
    return attention_parameters(texts, tokenizer, tables, attention.start_parameters(), rounds, 0.01)


def neighbours(training: DataFrame, words: DataFrame, tokenizer: str) -> DataFrame:
    """How often a subword follows another in all training documents: left, right, crosses (words), n.

    A text follows the end id, and the end id follows it.
    """

    def summed(keys: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
        coded = pa.array(keys).dictionary_encode()
        found, place = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        total = np.bincount(place, n, len(found))
        arrays = [pa.array((found >> 32).astype(np.int32)), pa.array((found & 0xFFFFFFFF).astype(np.int32))]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(total.astype(np.int64))], ["left", "right", "n"])

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(tokenizer, LEAF)
        # A word's first subword alone holds the space before it.
        opens = np.append([token.startswith(b" ") for token in tree.token_bytes[:-1]], True)
        for sequences in _groups(batches, _id_type(tree), GROUP_SUBWORDS):
            flat = np.concatenate(sequences)
            at = np.flatnonzero(opens[flat])
            before = flat[at - 1].astype(np.int64)
            before[at == 0] = len(opens) - 1
            yield summed(before << 32 | flat[at])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, lengths, flat in _unpacked(batches, _id_type(encoder(tokenizer, LEAF))):
            last = np.zeros(len(flat), bool)
            last[np.cumsum(lengths) - 1] = True
            inner = np.flatnonzero(~last)
            yield summed(flat[inner] << 32 | flat[inner + 1], np.repeat(n, lengths)[inner])

    schema = "left int, right int, n long"
    crossing = encoded(training, tokenizer).mapInArrow(across, schema).withColumn("crosses", F.lit(True))
    inside = _training_words(words).mapInArrow(within, schema).withColumn("crosses", F.lit(False))
    pairs = crossing.unionByName(inside).groupBy("left", "right", "crosses").agg(F.sum("n").alias("n"))
    return materialize(pairs, "lm-neighbours")


def subword_counts(pairs: DataFrame, size: int) -> np.ndarray:
    """How often each of ``size`` ids occurs: it always follows another."""
    found = pairs.groupBy("right").agg(F.sum("n").alias("n")).toArrow()  # bounded: the vocabulary
    counts = np.zeros(size, np.int64)
    counts[found.column("right").to_numpy()] = found.column("n").to_numpy()
    return counts


def subword_company(pairs: DataFrame, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left, right and number of the pairs with a common subword."""
    common = attention.common_subwords(counts).tolist()
    with_common = pairs.filter(F.col("left").isin(common) | F.col("right").isin(common))
    found = with_common.groupBy("left", "right").agg(F.sum("n").alias("n")).toArrow()  # bounded: the vocabulary times common ids
    return tuple(found.column(name).to_numpy() for name in ("left", "right", "n"))


def class_pairs(pairs: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts (class, class) of what follows the end of a word: a word's start or the end of the text."""
    wide = attention.CLASSES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(wide * wide)
        for batch in batches:
            left, right, n = (column.to_numpy() for column in batch.columns)
            total += np.bincount(classes[left] * wide + classes[right], n, wide * wide)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen].astype(np.int64))], ["key", "n"])

    parts = pairs.filter("crosses").select("left", "right", "n").mapInArrow(count, "key long, n long")
    found = parts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(wide * wide)
    total[found.column("key").to_numpy()] = found.column("n").to_numpy()
    return total.reshape(wide, wide)


def _stored(frame: DataFrame, label: str, **options: str) -> DataFrame:
    """The frame from a scratch table, without the shuffles that it took."""
    with shuffles_dropped(frame.sparkSession):
        return materialize(frame, label, **options)


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as ``words_of`` finds them, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    real = pc.binary_length(flat).to_numpy() > 0  # white space at either end leaves an empty word
    so_far = np.append(0, np.cumsum(real))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return flat.filter(pa.array(real)).cast(pa.binary()), np.diff(so_far[offsets - offsets[0]])


def _blobs(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Stretches of an array, of the given lengths, as binary values."""
    ends = np.append(0, np.cumsum(lengths)).astype(np.int64) * flat.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(flat)]).cast(pa.binary())


def _planes(values: np.ndarray, width: int) -> bytes:
    """Whole numbers as all their lowest bytes, then the next ones, ``width`` in all: the upper ones compress well."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T[:width]).tobytes()


def _from_planes(packed: bytes, size: int) -> np.ndarray:
    found = np.zeros((size, 8), np.uint8)
    if size:
        planes = np.frombuffer(packed, np.uint8).reshape(-1, size)
        found[:, : len(planes)] = planes.T
    return found.view("<i8").ravel()


def _width(values: np.ndarray) -> int:
    return max(1, -(-int(values.max(initial=0)).bit_length() // 8))


def dealt_documents(rows: DataFrame, chunks: int) -> DataFrame:
    """Documents dealt to ``chunks`` chunks by their ids: rows of words with a ``bucket``, rows of documents without one.

    A chunk's distinct words lie in buckets by their hash. A row holds those of one bucket: ``spelled``, the ``sizes``
    of each and ``n``, how often it occurs in the chunk's training documents, packed. A document is ``at``, the places of
    its words among those of its chunk, bucket after bucket; ``place`` is the order of its text in the chunk. Rows may be dealt already.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        chunk, texts = TaskContext.get().partitionId(), pa.Table.from_batches(held)
        parts = [words_in(part) for part in texts.column("text").chunks]
        lengths = np.concatenate([own for _, own in parts])
        coded = pa.chunked_array([part for part, _ in parts], pa.binary()).dictionary_encode()
        del parts
        words = coded.chunk(0).dictionary
        at = np.concatenate([part.indices.to_numpy() for part in coded.chunks])
        del coded
        n = np.bincount(at, np.repeat(texts.column("train").to_numpy(), lengths), len(words)).astype(np.int64)
        bucket = np.fromiter(map(zlib.crc32, words.to_pylist()), np.int64, len(words)) % chunks
        order = np.argsort(bucket, kind="stable")
        words, n, place = words.take(pa.array(order)), n[order], np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        at = place[at]
        buckets, sizes = np.unique(bucket, return_counts=True)
        offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1) if len(words) else np.zeros(1, np.int32)
        letters = np.frombuffer(words.buffers()[2], np.uint8, offsets[-1]) if offsets[-1] else np.empty(0, np.uint8)
        cuts = offsets[np.append(0, np.cumsum(sizes))]
        some = len(buckets)
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.array(np.full(some, chunk, np.int32)), pa.array(buckets.astype(np.int32))),
                *(_blobs(np.diff(offsets).astype("<u4"), sizes), _blobs(letters, np.diff(cuts)), _blobs(n.astype("<i8"), sizes)),
                *(pa.nulls(some, kind) for kind in (held[0].schema.field("id").type, pa.bool_(), pa.int32(), pa.int32(), pa.binary())),
            ],
            names,
        )
        ranked = np.empty(len(texts), np.int32)
        ranked[pc.sort_indices(texts.column("text")).to_numpy()] = np.arange(len(texts), dtype=np.int32)
        width, low = _width(at), 0
        for batch in held:
            own = lengths[low : low + len(batch)]
            ends = np.cumsum(own) + lengths[:low].sum()
            packed = [_planes(at[end - size : end], width) for size, end in zip(own.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(np.full(len(batch), chunk, np.int32)), pa.nulls(len(batch), pa.int32()), *(pa.nulls(len(batch), pa.binary()) for _ in range(3))),
                    *(batch.column("id"), batch.column("train"), pa.array(ranked[low : low + len(batch)])),
                    *(pa.array(own.astype(np.int32)), pa.array(packed, pa.binary())),
                ],
                names,
            )
            low += len(batch)
        pa.default_memory_pool().release_unused()

    names = ["chunk", "bucket", "sizes", "spelled", "n", "id", "train", "place", "words", "at"]
    if set(names) <= set(rows.columns):
        return rows
    schema = f"chunk int, bucket int, sizes binary, spelled binary, n binary, id {kind}, train boolean, place int, words int, at binary"
    return _stored(rows.select("id", "train", "text").repartition(chunks, "id").mapInArrow(deal, schema), "lm-dealt", compression="zstd")


def counted_words(rows: DataFrame, tokenizer: str, chunks: int) -> DataFrame:
    """Words of documents (``dealt_documents``) with their counts over all training documents and their subword ids.

    A row without ``chunk`` holds every word of a task once, with the sum of its counts (``total``) and how many
    are of training documents (``known``). One with ``chunk`` holds the words that a chunk has in a bucket, in the same order.
    ``n``, ``lengths`` and ``ids`` are packed.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        tree = encoder(tokenizer, LEAF)
        kind = _id_type(tree)
        rows = pa.Table.from_batches(held)
        sizes, n = (np.frombuffer(b"".join(rows.column(name).to_pylist()), to) for name, to in (("sizes", "<u4"), ("n", "<i8")))
        letters = pa.py_buffer(b"".join(rows.column("spelled").to_pylist()))
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), letters]).dictionary_encode()
        at = coded.indices.to_numpy()
        # Each word comes once here, so its ids need no cache.
        spelled = [tree.spaced(word.decode()) for word in coded.dictionary.to_pylist()]
        lengths = np.fromiter(map(len, spelled), np.int64, len(spelled)) // 4
        flat = np.frombuffer(b"".join(spelled), "<u4").astype(kind)
        total = np.zeros(len(spelled), np.int64)
        np.add.at(total, at, n)
        words = np.array([len(own) // 4 for own in rows.column("sizes").to_pylist()])
        yield pa.RecordBatch.from_arrays(
            [
                *(pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.array([int(total.sum())]), pa.array([int((total > 0).sum())])),
                *(pa.array([values.tobytes()], pa.binary()) for values in (total.astype("<i8"), lengths.astype("<u4"), flat)),
            ],
            names,
        )
        cuts, low = np.append(0, np.cumsum(words)), 0
        for batch in held:
            part = at[cuts[low] : cuts[low + len(batch)]]
            own = words[low : low + len(batch)]
            so_far = np.append(0, np.cumsum(lengths[part]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column("chunk"), batch.column("bucket"), pa.nulls(len(batch), pa.int64()), pa.nulls(len(batch), pa.int64())),
                    *(_blobs(total[part].astype("<i8"), own), _blobs(lengths[part].astype("<u4"), own)),
                    _blobs(_stretches(flat, np.cumsum(lengths) - lengths, lengths, part), np.diff(so_far[np.append(0, np.cumsum(own))])),
                ],
                names,
            )
            low += len(batch)
        pa.default_memory_pool().release_unused()

    names = ["chunk", "bucket", "total", "known", "n", "lengths", "ids"]
    packed = dealt_documents(rows, chunks).filter("bucket is not null").select("chunk", "bucket", "sizes", "spelled", "n")
    schema = "chunk int, bucket int, total long, known long, n binary, lengths binary, ids binary"
    return _stored(packed.repartition(chunks, "bucket").mapInArrow(count, schema), "lm-words", compression="zstd")


def _stretches(flat: np.ndarray, first: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The stretches numbered ``which`` of an array, one after another."""
    own = lengths[which]
    return flat[np.repeat(first[which] - (np.cumsum(own) - own), own) + np.arange(own.sum())]


def _training_words(words: DataFrame) -> DataFrame:
    """Rows that hold every word once: of use where it occurs in training documents."""
    return words.filter("chunk is null and known > 0").select("n", "lengths", "ids")


def _unpacked(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of the training words: counts, numbers of subwords, and the subword ids one after another."""
    for batch in batches:
        for n, lengths, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            n, lengths = np.frombuffer(n, "<i8"), np.frombuffer(lengths, "<u4").astype(np.int64)
            seen = n > 0
            flat = np.frombuffer(ids, kind)[np.repeat(seen, lengths)].astype(np.int64)
            yield n[seen], lengths[seen], flat


def spelled_documents(dealt: DataFrame, words: DataFrame, tokenizer: str, ends: int, n_train: int, distinct: int) -> DataFrame:
    """Per document: id, train, place, n_tokens, n_known, base_score, ``n`` of its words and ``ids`` of the text and its end."""
    source = dealt.schema["id"].dataType.simpleString()

    def base(n: np.ndarray) -> np.ndarray:
        return np.log10((n + 1) / (n_train + distinct + 1))

    def spell(_: tuple, documents: pa.Table, known: pa.Table) -> pa.Table:
        tree = encoder(tokenizer, LEAF)
        kind = _id_type(tree)
        known = known.sort_by("bucket")
        n, lengths, flat = (
            np.frombuffer(b"".join(known.column(name).to_pylist()), to) for name, to in (("n", "<i8"), ("lengths", "<u4"), ("ids", kind))
        )
        # The end is one word more.
        lengths = np.append(lengths, 1).astype(np.int64)
        flat = np.append(flat, len(tree.token_bytes) - 1).astype(kind)
        first, of_word = np.cumsum(lengths) - lengths, base(n)
        of_end, width = float(base(np.array([ends]))[0]), _width(n)
        n_known, bases, counts, ids = [], [], [], []
        for size, at in zip(documents.column("words").to_pylist(), documents.column("at").to_pylist(), strict=True):
            index = _from_planes(at, size)
            own = n[index]
            n_known.append(int((own > 0).sum()) + (ends > 0))
            bases.append(float(of_word[index].sum()) + of_end)
            counts.append(_planes(own, width))
            ids.append(_stretches(flat, first, lengths, np.append(index, len(n))).tobytes())
        n_tokens = pc.add(documents.column("words").cast(pa.int64()), 1)
        return pa.Table.from_arrays(
            [
                *(documents.column(name) for name in ("id", "train", "place")),
                *(n_tokens, pa.array(n_known, pa.int64()), pa.array(bases, pa.float64()), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())),
            ],
            ["id", "train", "place", "n_tokens", "n_known", "base_score", "n", "ids"],
        )

    left = dealt.filter("bucket is null").select("chunk", "id", "train", "place", "words", "at").groupBy("chunk")
    right = words.filter("chunk is not null").select("chunk", "bucket", "n", "lengths", "ids").groupBy("chunk")
    schema = f"id {source}, train boolean, place int, n_tokens long, n_known long, base_score double, n binary, ids binary"
    return _stored(left.cogroup(right).applyInArrow(spell, schema), "lm-spelled")


def subword_tables(words: DataFrame, classes: np.ndarray, heads: np.ndarray, crossing: np.ndarray, texts: int) -> attention.Tables:
    """Tables from the counts of subwords, and of pairs of heads within words, in ``texts`` training documents."""
    size, width = len(classes), attention.HEADS
    pairs_from, ends_from = size, size + width * width
    kind = _kind_of(size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(ends_from + width)
        for n, lengths, flat in _unpacked(batches, kind):
            weight = np.repeat(n, lengths)
            last = np.zeros(len(flat), bool)
            last[np.cumsum(lengths) - 1] = True
            head = heads[flat]
            inner = np.flatnonzero(~last)
            for key, held in (
                (flat, weight),
                (pairs_from + head[inner] * width + head[inner + 1], weight[inner]),
                (ends_from + head[last], weight[last]),
            ):
                np.add.at(total, key, held)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen].astype(np.int64))], ["key", "n"])

    parts = _training_words(words).mapInArrow(count, "key long, n long")
    found = parts.groupBy("key").agg(F.sum("n").alias("n")).toArrow()  # bounded: the vocabulary and pairs of heads
    total = np.zeros(ends_from + width)
    total[found.column("key").to_numpy()] = found.column("n").to_numpy()
    total[size - 1] = total[ends_from + heads[size - 1]] = texts
    inside = total[pairs_from:ends_from].reshape(width, width)
    return attention.Tables.counted(classes, heads, total[:size], inside, total[ends_from:], crossing)


def score_documents(
    documents: DataFrame,
    training: Column,
    tokenizer: str,
    chunks: int | None = None,
    sample: int = 600,
    rounds: int = 4,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: id, ``train`` (it was learned from), ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    ``training`` says which rows are learned from. ``chunks`` is the number of tasks that documents are dealt to
    (by default the number of shuffle partitions); a task holds the text of its chunk and its distinct words. All
    training rows are counted and trained on; ``sample`` and ``rounds`` are for the start of the attention only.
    Defined results: a null or empty text is the end token alone; a null id is not learned from unless
    ``training`` says so, and scored like others; repeated rows count as often as they occur; without training
    rows all counts are 0 and the model is its random start; an empty table gives no rows. Further columns are not read.
    """
    chunks = chunks or int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.coalesce(training, F.lit(False)).alias("train"),
    )
    dealt = dealt_documents(rows, chunks)
    words = counted_words(dealt, tokenizer, chunks)
    ends = dealt.filter("bucket is null and train").count()
    totals = words.filter("chunk is null").agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("total", "known")]).first()
    n_train, distinct = totals["total"] + ends, totals["known"] + (ends > 0)
    spelled = spelled_documents(dealt, words, tokenizer, ends, n_train, distinct)
    release(dealt)
    learned = spelled.filter("train").select("id", "place", "ids")
    pairs = neighbours(learned, words, tokenizer)
    spaced = np.array([token.startswith(b" ") for token in encoder(tokenizer, LEAF).token_bytes])
    counts = subword_counts(pairs, len(spaced))
    classes = attention.subword_classes(counts, *subword_company(pairs, counts), spaced)
    heads = attention.head_subwords(counts)
    tables = subword_tables(words, classes, heads, class_pairs(pairs, classes), ends)
    release(words, pairs)
    start = started_parameters(learned, tokenizer, tables, sample, rounds)
    opens = np.append(spaced[:-1], True)
    parameters = attention_parameters(in_groups(learned, ends), tokenizer, tables, start, 1, 0.001)
    model = attention.LanguageModel(parameters, tables, tables.openings(opens))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # bounded by the vocabulary and pairs of heads
    kind = _kind_of(len(spaced))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value

        def scored(held: list[np.ndarray], n: list[np.ndarray]) -> np.ndarray:
            """log10 probability of texts, from their subword ids and the counts of their words and last that of the end."""
            logs, opening = scorer.id_and_opening_logs(held)
            # A word's first subword alone holds the space before it.
            begins = np.flatnonzero(opens[np.concatenate(held)])
            lengths = np.cumsum([*map(len, n)])
            ends_here = np.zeros(len(begins), bool)
            ends_here[lengths - 1] = True
            mixed = spelled_logs(np.add.reduceat(logs, begins), opening[begins], ends_here)
            return np.add.reduceat(mixed_log10(np.concatenate(n) / max(1, n_train), mixed), np.append(0, lengths[:-1]))

        for batch in batches:
            scores, held, n, size = [], [], [], 0
            for n_tokens, packed, ids in zip(*(batch.column(name).to_pylist() for name in ("n_tokens", "n", "ids")), strict=True):
                held.append(np.frombuffer(ids, kind))
                n.append(np.append(_from_planes(packed, n_tokens - 1), ends))
                size += n_tokens
                if size > GROUP_WORDS:
                    scores.append(scored(held, n))
                    held, n, size = [], [], 0
            if held:
                scores.append(scored(held, n))
            own = [batch.column(name) for name in ("id", "train", "n_tokens", "n_known", "base_score")]
            flat = np.concatenate(scores) if scores else np.empty(0)
            yield pa.RecordBatch.from_arrays([*own, pa.array(flat)], ["id", "train", "n_tokens", "n_known", "base_score", "score"])

    source = rows.schema["id"].dataType.simpleString()
    schema = f"id {source}, train boolean, n_tokens long, n_known long, base_score double, score double"
    read = spelled.select("id", "train", "n_tokens", "n_known", "base_score", "n", "ids")
    return read.mapInArrow(score, schema).select(
        F.col("id").alias(id_column), "train", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score"
    )
