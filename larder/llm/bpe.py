"""Operator 4: BPE encoding and decoding by tree concatenation.

A text is cut where a pre-token surely ends: before a space that a non-space follows. The pieces
repeat a lot, so each worker keeps the ids of recent ones. A piece goes through the tokenizer's own
pre-tokenizer, and the bytes of each pre-token through its merges. A pre-token longer than ``leaf`` bytes
(unsplit text: long runs of letters, of signs, of spaces) is halved down to leaves, which are encoded
independently; then neighbours are joined bottom up. A join re-encodes a window around the seam, wider
each time, until its first id is the left side's id at that place and its last id is the right side's.
Every adjacent pair of ids then occurs in an encoding of its own text, and a BPE sequence is right
exactly if all its adjacent pairs are.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from larder.llm.tables import id_and_text

# A space before one of these is no place to cut: white space, and signs of which Unicode versions disagree.
_NO_CUT = r"\s᠎​﻿"
_UNSURE = re.compile(f" (?:[{_NO_CUT}]|\\Z)")
_CUT = re.compile(f" (?=[^{_NO_CUT}])")
# Pieces of these signs only are split here: every Unicode version agrees on them, and it is faster.
_COMMON = re.compile("[\n\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PRE_TOKEN = re.compile(
    "'(?:s|t|re|ve|m|ll|d)"
    "| ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+| ?[0-9]+| ?[^\\sA-Za-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff]+|\\s+(?!\\S)|\\s+"
)


def byte_symbols() -> dict[int, str]:
    """The printable sign that stands for each byte in a byte-level vocabulary."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in own]
    return {byte: chr(byte) for byte in own} | {byte: chr(256 + i) for i, byte in enumerate(others)}


class PieceCache(dict):
    """Ids of pieces as little-endian 32-bit integers; emptied when full, so memory is bounded."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        found = self[piece] = self.encode(piece)
        return found


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class TreeEncoder:
    """Encoder and decoder of one byte-level BPE tokenizer file."""

    def __init__(self, path: str, leaf: int = 256, cached_pieces: int = 200_000):
        tokenizer = Tokenizer.from_file(path)
        self.pre_tokenizer = tokenizer.pre_tokenizer
        self.leaf = leaf
        self.special = {token.content: i for i, token in tokenizer.get_added_tokens_decoder().items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")
        byte_of = {symbol: byte for byte, symbol in byte_symbols().items()}
        self.byte_of = byte_of
        size = tokenizer.get_vocab_size(with_added_tokens=True)
        tokens = [tokenizer.id_to_token(i) for i in range(size)]
        self.token_bytes = [
            token.encode() if token in self.special else bytes(byte_of[c] for c in token) for token in tokens
        ]
        self.decimals = [str(i) for i in range(size)]
        # In a byte-level vocabulary an id is the rank of the merge that makes the token.
        ranks = {self.token_bytes[i]: i for i, token in enumerate(tokens) if token not in self.special}
        self.leaf_ids = tiktoken.Encoding(
            "merges", pat_str=".+", mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece
        self.pieces = PieceCache(self.spaced, cached_pieces)
        self.pre_tokens = PieceCache(lambda text: packed(self.tree(text.encode())), cached_pieces)

    def encode(self, text: str) -> np.ndarray:
        out: list[bytes] = []
        if any(token in text for token in self.special):
            for part in self.special_pattern.split(text):
                if part in self.special:
                    out.append(packed([self.special[part]]))
                else:
                    self.unmarked(part, out)
        else:
            self.unmarked(text, out)
        return np.frombuffer(b"".join(out), "<u4")

    def unmarked(self, text: str, out: list[bytes]) -> None:
        """Ids of a text without special tokens."""
        pieces = _CUT.split(text) if _UNSURE.search(text) else text.split(" ")
        if pieces[0]:
            out.append(self.piece(pieces[0]))
        out.extend(map(self.pieces.__getitem__, pieces[1:]))

    def spaced(self, piece: str) -> bytes:
        """Ids of a piece and the space before it."""
        if piece.isascii() and piece.isalpha() and len(piece) < self.leaf:
            return packed(self.leaf_ids(b" " + piece.encode()))
        return self.piece(" " + piece)

    def piece(self, text: str) -> bytes:
        if _COMMON.fullmatch(text):
            return b"".join(map(self.pre_tokens.__getitem__, _PRE_TOKEN.findall(text)))
        parts = self.pre_tokenizer.pre_tokenize_str(text)
        return b"".join(packed(self.tree(bytes(map(self.byte_of.__getitem__, s)))) for s, _ in parts)

    def tree(self, text: bytes) -> list[int]:
        """Ids of one pre-token, by halves when it is long."""
        if len(text) <= self.leaf:
            return self.leaf_ids(text)
        leaves = [text]
        while len(leaves[0]) > self.leaf:
            leaves = [half for s in leaves for half in (s[: len(s) // 2], s[len(s) // 2 :])]
        level = [self.leaf_ids(leaf) for leaf in leaves]
        while len(level) > 1:
            level = [self.concatenate(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        return level[0]

    def concatenate(self, left: list[int], right: list[int]) -> list[int]:
        width = 1
        while True:
            window = b"".join(self.token_bytes[i] for i in [*left[-width:], *right[:width]])
            middle = self.leaf_ids(window)
            left_agrees = width >= len(left) or middle[0] == left[-width]
            right_agrees = width >= len(right) or middle[-1] == right[width - 1]
            if left_agrees and right_agrees:
                return [*left[:-width], *middle, *right[width:]]
            width *= 2

    def decode(self, ids) -> str:
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")

    def decimal(self, ids) -> str:
        return ",".join(map(self.decimals.__getitem__, ids))


_encoders: dict[tuple[str, int], TreeEncoder] = {}


def encoder(path: str, leaf: int) -> TreeEncoder:
    """One per worker process and file; the cache of pieces lives on between tasks."""
    if (path, leaf) not in _encoders:
        _encoders[path, leaf] = TreeEncoder(path, leaf)
    return _encoders[path, leaf]


def list_array(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int64)
    flat = np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)
    return pa.LargeListArray.from_arrays(pa.array(ends), pa.array(flat)).cast(pa.list_(pa.int32()))


def encode_documents(
    documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", leaf: int = 256
) -> DataFrame:
    """Per row: the id column and ``ids``, the whole text's token ids.

    ``tokenizer`` is the path of a byte-level BPE file that every executor has. Special tokens written in a
    text get their ids; none is added. Defined results: a null or empty text has no ids; every row is encoded
    on its own, so null ids, repeated rows and an empty table need no rule; further columns are not read.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(tokenizer, leaf)
        for batch in batches:
            ids = list_array([tree.encode(text) for text in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["id", "ids"])

    rows = id_and_text(documents, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"id {kind}, ids array<int>").withColumnRenamed("id", id_column)


def decode_documents(
    encoded: DataFrame, tokenizer: str, id_column: str = "doc_id", ids_column: str = "ids", leaf: int = 256
) -> DataFrame:
    """Per row: the id column and ``text``, special tokens included; null ids give an empty text."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(tokenizer, leaf)
        for batch in batches:
            texts = [tree.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    rows = encoded.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(decode, f"id {kind}, text string").withColumnRenamed("id", id_column)


def round_trip(
    documents: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text", leaf: int = 256
) -> DataFrame:
    """Per row: id, ``n_tokens`` and the digests of the ids and of the text decoded from them.

    Encodes and decodes as the two operators above, in one pass that keeps no ids.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = encoder(tokenizer, leaf)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1):
                ids = tree.encode(text.as_py()).tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(tree.decimal(ids).encode()).hexdigest())
                of_text.append(hashlib.sha256(tree.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = id_and_text(documents, id_column, text_column)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(digests, schema).withColumnRenamed("id", id_column)
