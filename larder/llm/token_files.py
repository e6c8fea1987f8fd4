"""Operator 9: token ids as files of bit or byte planes.

A file is::

    magic "PLN1", plane width in bits (1 or 8) as one byte, ids per block as uint32
    per block: its planes, each compressed with zstandard
    index: per block its number of ids and the compressed length of each plane, as uint32
    documents: their ids as int64, which of them are null as bytes, their token counts as int64, compressed
    lengths of index and documents as uint64, number of blocks and documents as uint64, magic

A plane holds one bit or byte of every id of a block: plane k of the byte form is byte k (little endian)
of each id, so the high planes are constant and nearly vanish. All integers are little endian.

Documents are dealt to files by ranges of their id and sorted within, so files in order of their part
number hold all ids in ascending order. Files are written by the tasks to the shared folder under names
of their own per attempt; the manifest, itself a table, names those of the attempts that succeeded.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm.bpe import PieceCache, byte_symbols, packed
from larder.llm.tables import id_and_text
from larder.sources.scratch import materialize, scratch_path

MAGIC = b"PLN1"
MANIFEST = "path string, part int, n_docs long, n_ids long, n_bytes long"
_FOOTER = struct.Struct("<QQQQ4s")
#: Documents whose words are looked up together.
ROWS = 4_000

# Words of these signs only are split here: every Unicode version agrees on them.
_COMMON = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PRE_TOKEN = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+|[0-9]|[^A-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff]+"
)


class WordMerges:
    """The merges of a word tokenizer on lower-case words of common signs, run by tiktoken as ranks.

    An id is the rank of the merge that makes the token. A byte that ends a word is a symbol of its own, so the
    bytes of the common signs are numbered twice: inside words, and at their end. tiktoken's time is quadratic
    in a word's length, so the library takes words above ``longest`` bytes.
    """

    def __init__(self, tokenizer: Tokenizer, longest: int = 256):
        self.model, self.longest, symbols = tokenizer.model, longest, byte_symbols()
        self.symbols = "".join(symbols[byte] for byte in range(256))
        used = sorted({byte for sign in map(chr, range(0x21, 0x100)) if _COMMON.fullmatch(sign) for byte in sign.lower().encode()})
        self.inside = bytes(used.index(byte) if byte in used else 0xFF for byte in range(256))
        self.ending = {byte: bytes([len(used) + i]) for i, byte in enumerate(used)}
        byte_of, ending = {symbol: byte for byte, symbol in symbols.items()}, self.model.end_of_word_suffix
        ranks = {}
        for token, i in tokenizer.get_vocab(with_added_tokens=False).items():
            data = bytes(byte_of[symbol] for symbol in token.removesuffix(ending))
            if data and self.ending.keys() >= set(data):
                ranks[self.numbered(data) if token.endswith(ending) else data.translate(self.inside)] = i
        self.merged = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def numbered(self, data: bytes) -> bytes:
        return data[:-1].translate(self.inside) + self.ending[data[-1]]

    def __call__(self, word: str) -> bytes:
        data = word.encode()
        if len(data) > self.longest:
            return packed([token.id for token in self.model.tokenize(data.decode("latin-1").translate(self.symbols))])
        return packed(self.merged(self.numbered(data)))


class WordEncoder:
    """Ids of words as the tokenizers library gives them: white space separates words, so they repeat and are cached.

    New words of common signs go through the merges alone, which is several times faster than the library on
    single words; all others go through the library.
    """

    def __init__(self, path: str, cached_words: int = 400_000):
        self.tokenizer = Tokenizer.from_file(path)
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        self.merges = WordMerges(self.tokenizer)
        self.pre_tokens = PieceCache(self.merges, cached_words)
        self.words = PieceCache(self.word, cached_words)

    def word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self.merges(word.lower())
        if _COMMON.fullmatch(word) and not self.special.search(word):
            return b"".join(map(self.pre_tokens.__getitem__, _PRE_TOKEN.findall(word.lower())))
        return packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of texts: Arrow splits them and finds their distinct words, whose ids are laid out again by number."""
        words = pc.ascii_split_whitespace(texts)
        found = words.flatten().dictionary_encode()
        of_word = list(map(self.words.__getitem__, found.dictionary.to_pylist()))
        lengths = np.fromiter(map(len, of_word), np.int64, len(of_word)) // 4
        first, codes = np.cumsum(lengths) - lengths, found.indices.to_numpy()
        counts = lengths[codes]
        ends = np.append(0, np.cumsum(counts))
        place = np.repeat(first[codes] - ends[:-1], counts) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(of_word), "<u4")[place]
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        return (ids[low:high].tobytes() for low, high in pairwise(bounds))


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def to_planes(ids: np.ndarray, width: int) -> list[bytes]:
    by_byte = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if width == 8:
        return [plane.tobytes() for plane in by_byte.T]
    bits = np.unpackbits(by_byte, axis=1, bitorder="little")
    return [plane.tobytes() for plane in np.packbits(np.ascontiguousarray(bits.T), axis=1)]


def from_planes(planes: list[bytes], n: int, width: int) -> np.ndarray:
    if width == 8:
        by_byte = np.stack([np.frombuffer(plane, np.uint8) for plane in planes], axis=1)
    else:
        packed_bits = np.stack([np.frombuffer(plane, np.uint8) for plane in planes])
        bits = np.unpackbits(packed_bits, axis=1, count=n)
        by_byte = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    return np.ascontiguousarray(by_byte).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes one file block by block; holds one block and 17 bytes a document."""

    def __init__(self, stream, block: int, width: int):
        self.stream, self.block, self.width = stream, block, width
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.stream.write(MAGIC + struct.pack("<BI", width, block))
        self.waiting: list[bytes] = []
        self.waiting_bytes, self.n_ids = 0, 0
        self.index: list[int] = []
        self.doc_ids: list[int | None] = []
        self.counts: list[int] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.counts.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.waiting.append(ids)
        self.waiting_bytes += len(ids)
        if self.waiting_bytes >= 4 * self.block:
            data = b"".join(self.waiting)
            whole = len(data) - len(data) % (4 * self.block)
            for start in range(0, whole, 4 * self.block):
                self._block(data[start : start + 4 * self.block])
            self.waiting, self.waiting_bytes = [data[whole:]], len(data) - whole

    def _block(self, data: bytes) -> None:
        planes = [self.compressor.compress(p) for p in to_planes(np.frombuffer(data, "<u4"), self.width)]
        self.index += [len(data) // 4, *map(len, planes)]
        for plane in planes:
            self.stream.write(plane)

    def close(self) -> None:
        rest = b"".join(self.waiting)
        if rest:
            self._block(rest)
        index = np.array(self.index, "<u4").tobytes()
        ids = np.array([0 if i is None else i for i in self.doc_ids], "<i8").tobytes()
        nulls = bytes(i is None for i in self.doc_ids)
        documents = self.compressor.compress(ids + nulls + np.array(self.counts, "<i8").tobytes())
        blocks = len(self.index) // (1 + 32 // self.width)
        self.stream.write(index + documents)
        self.stream.write(_FOOTER.pack(len(index), len(documents), blocks, len(self.counts), MAGIC))


def read_planes(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """The documents of a file (a random access stream) with their ids, block by block."""
    size = source.size()
    source.seek(0)
    magic, width, _ = struct.unpack("<4sBI", source.read(9))
    source.seek(size - _FOOTER.size)
    index_len, docs_len, n_blocks, n_docs, end = _FOOTER.unpack(source.read(_FOOTER.size))
    if magic != MAGIC or end != MAGIC:
        raise ValueError("not a plane file, or cut short")
    source.seek(size - _FOOTER.size - docs_len - index_len)
    planes = 32 // width
    index = np.frombuffer(source.read(index_len), "<u4").reshape(n_blocks, 1 + planes)
    expand = zstandard.ZstdDecompressor().decompress
    documents = expand(source.read(docs_len))
    doc_ids = np.frombuffer(documents, "<i8", n_docs)
    nulls = np.frombuffer(documents, np.uint8, n_docs, 8 * n_docs)
    counts = np.frombuffer(documents, "<i8", n_docs, 9 * n_docs)
    source.seek(9)

    def blocks() -> Iterator[np.ndarray]:
        for n, *lengths in index.tolist():
            yield from_planes([expand(source.read(length)) for length in lengths], n, width)

    ahead = blocks()
    held = np.empty(0, "<u4")
    for doc_id, null, count in zip(doc_ids.tolist(), nulls.tolist(), counts.tolist(), strict=True):
        parts, missing = [held[:count]], count - len(held)
        held = held[count:]
        while missing > 0:
            held = next(ahead)
            parts.append(held[:missing])
            held, missing = held[missing:], missing - len(held)
        yield (None if null else doc_id), (parts[0] if len(parts) == 1 else np.concatenate(parts))


def write_token_files(
    documents: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    folder: str | None = None,
    files: int | None = None,
    block: int = 65_536,
    plane_bits: int = 8,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Encode every whole text, append ``end_id``, write the ids in ascending order of the id column.

    Returns the manifest: path, part, n_docs, n_ids, n_bytes, one row per file. ``folder`` is a URI that
    executors reach through Arrow's file systems; by default a new folder below ``spark.checkpoint.dir``.
    Defined results: a null or empty text is the end id alone; null ids come first; equal ids are ordered by
    a hash of their texts; an empty table gives no or empty files. Further columns are not read.
    """
    spark = documents.sparkSession
    target = folder or scratch_path(spark, "token-files")
    count = files or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        system, root = fs.FileSystem.from_uri(target)
        system.create_dir(root, recursive=True)
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.planes"
        encode, end = word_encoder(tokenizer).encode, packed([end_id])
        with system.open_output_stream(f"{root}/{name}") as stream:
            writer = PlaneWriter(stream, block, plane_bits)
            for batch in batches:
                for low in range(0, batch.num_rows, ROWS):
                    doc_ids, texts = batch.slice(low, ROWS).columns
                    for doc_id, ids in zip(doc_ids.to_pylist(), encode(texts), strict=True):
                        writer.add(doc_id, ids + end)
            writer.close()
            size = stream.tell()
        row = {"path": f"{target}/{name}", "part": part, "n_docs": len(writer.counts), "n_ids": writer.n_ids, "n_bytes": size}
        schema = pa.schema([("path", pa.string()), ("part", pa.int32()), *[(c, pa.int64()) for c in ("n_docs", "n_ids", "n_bytes")]])
        yield pa.RecordBatch.from_pylist([row], schema)

    rows = id_and_text(documents, id_column, text_column).withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange(count, "id", "tie").sortWithinPartitions("id", "tie")
    return materialize(ordered.select("id", "text").mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, manifest: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per document of the files: id, ``start``, ``n_tokens``, ``ids_crc32``, ``ids`` being left to the caller.

    ``start`` sums the files before (one manifest row each) and the documents before within the file.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("path", "part", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    schema = f"{id_column} long, start long, n_tokens long, ids_crc32 long"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = fs.FileSystem.from_uri(row["path"])
                start, out = row["start"], []
                with system.open_input_file(path) as source:
                    for doc_id, ids in read_planes(source):
                        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                columns = list(zip(*out, strict=True)) or [(), (), (), ()]
                names = [id_column, "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(partitions, "part").mapInArrow(read, schema)
