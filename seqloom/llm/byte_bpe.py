"""Byte-level BPE encoding and decoding by the tokenizers library, from a file of merge ranks."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import tokens
from .resident import remembered
from .scratch import bounded_batches


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank of a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[bytes, bytes]]:
    """Every pair of tokens whose joined bytes are a token, in the order of the joined token's rank."""
    return [(t[:i], t[i:]) for t in sorted(ranks, key=ranks.get) for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]


def build_encoder(ranks: dict[bytes, int], pattern: str):
    """Tokenizer over the ranks: split by the pattern, bytes to characters, then merges by rank; whole tokens stay whole."""
    tokens.single_threaded()
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    chars = tokens.byte_characters()
    seen = lambda t: "".join(chars[b] for b in t)
    model = models.BPE(vocab={seen(t): r for t, r in ranks.items()}, merges=[(seen(a), seen(b)) for a, b in merges_of(ranks)], ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


class Decoder:
    """Ids back to bytes, by a table of all tokens' bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        parts = [b""] * (max(ranks.values(), default=-1) + 1)
        for t, r in ranks.items():
            parts[r] = t
        self.lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(parts), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, offsets of each); ids may end inside a character, as bytes are never decoded singly."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        data = self.flat[np.arange(total) + np.repeat(self.starts[ids] - (ends - lengths), lengths)]
        return data, np.concatenate([[0], ends])[offsets]

    def spans(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first character, character behind the last) of every token, counted from the start of its text."""
        data, texts = self.decode(ids, offsets)
        # Characters that begin before each byte: all bytes but continuation bytes begin one.
        begun = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        ends = np.cumsum(self.lengths[ids])
        before = np.repeat(begun[texts[:-1]], np.diff(offsets))
        return begun[ends - self.lengths[ids] + 1] - 1 - before, begun[ends] - before


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every row, in input order and without a shuffle.

    A null or empty text has no ids; null or repeated doc_ids and other columns make no difference.
    """
    bounded_batches(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(("ranks", ranks_path, pattern), lambda: tokens.by_library(build_encoder(read_ranks(ranks_path), pattern)))
        for batch in batches:
            ids, offsets = encoder.encode(batch.column(1))
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["doc_id", "ids"])

    return docs.select(docs["doc_id"].cast("bigint"), docs["text"]).mapInArrow(task, "doc_id bigint, ids array<int>")


def with_offsets(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, ids, starts array<int>, ends array<int>``: the code points of the text that each token covers, end exclusive.

    A token's span holds every character of which it has a byte, so tokens that share a split character both hold it. An empty
    text and null ids have empty arrays.
    """
    bounded_batches(encoded.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(ranks_path))
        for batch in batches:
            ids, offsets = _lists(batch.column(1))
            starts, ends = decoder.spans(ids, offsets)
            at = pa.array(offsets.astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (ids, starts, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], names=["doc_id", "ids", "starts", "ends"])

    columns = "doc_id bigint, ids array<int>, starts array<int>, ends array<int>"
    return encoded.select(encoded["doc_id"].cast("bigint"), encoded["ids"]).mapInArrow(task, columns)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, data binary``: the bytes that ``encode`` read; cast to string for the text. Null ids give no bytes."""
    bounded_batches(encoded.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(ranks_path))
        for batch in batches:
            ids, offsets = _lists(batch.column(1))
            data, ends = decoder.decode(ids, offsets)
            yield pa.RecordBatch.from_arrays([batch.column(0), _binary(data, ends)], names=["doc_id", "data"])

    return encoded.select(encoded["doc_id"].cast("bigint"), encoded["ids"]).mapInArrow(task, "doc_id bigint, data binary")


def digest(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of the ids and of the bytes they decode to."""
    bounded_batches(encoded.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(read_ranks(ranks_path))
        for batch in batches:
            ids, offsets = _lists(batch.column(1))
            data, ends = decoder.decode(ids, offsets)
            raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
            plain = memoryview(np.ascontiguousarray(data))
            n = range(batch.num_rows)
            columns = [
                batch.column(0),
                pa.array(np.diff(offsets)),
                pa.array([hashlib.sha256(raw[4 * offsets[i] : 4 * offsets[i + 1]]).hexdigest() for i in n], pa.string()),
                pa.array([hashlib.sha256(plain[ends[i] : ends[i + 1]]).hexdigest() for i in n], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return encoded.mapInArrow(task, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column, null lists as empty ones."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
