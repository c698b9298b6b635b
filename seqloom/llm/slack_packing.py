"""Packing with minimum bin slack: per sequence, a subset-sum program over bitsets picks the remaining lengths that fill it best."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import tokens
from .resident import remembered
from .scratch import bounded_batches
from .words import text_buffer, word_spans

#: Pieces a task holds back at most, each shorter than a sequence; the program chooses among them.
WAITING = 1024

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """How many of each length make the largest sum up to ``capacity``; ``counts`` says how many there are.

    Bit s of a set of sums says that s can be reached. Lengths join longest first, their counts in powers of two, until
    the capacity itself is reached; the counts come from walking the sets back.
    """
    mask, reach = (1 << capacity + 1) - 1, 1
    taken: list[tuple[int, int, int]] = []  # (sums before, length, copies that join at once)
    for length in sorted(counts, reverse=True):
        left, copies = min(counts[length], capacity // length), 1
        while left:
            copies = min(copies, left)
            taken.append((reach, length, copies))
            reach |= reach << length * copies & mask
            left -= copies
            copies *= 2
        if reach >> capacity:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, copies in reversed(taken):
        if not before >> total & 1:
            total -= length * copies
            chosen[length] = chosen.get(length, 0) + copies
    return chosen


class Packer:
    """Sequences of one task; ``add`` and ``finish`` yield (piece, offset, sequence) with a piece as (document, start, ids).

    Sequences are exactly full: what the best choice leaves free is filled with the front of a waiting piece. The last tokens of a task go into
    sequences whose lengths are powers of two, which need no padding either.
    """

    def __init__(self, capacity: int, waiting: int, first_id: int = 0):
        self.capacity, self.most, self.next_id = capacity, waiting, first_id
        self.by_length: dict[int, list[tuple]] = {}
        self.counts: dict[int, int] = {}
        self.pieces = self.tokens = 0

    def _push(self, piece: tuple) -> None:
        n = len(piece[2])
        self.by_length.setdefault(n, []).append(piece)
        self.counts[n] = self.counts.get(n, 0) + 1
        self.pieces += 1
        self.tokens += n

    def _pop(self, n: int) -> tuple:
        piece = self.by_length[n].pop()
        self.counts[n] -= 1
        if not self.counts[n]:
            del self.counts[n], self.by_length[n]
        self.pieces -= 1
        self.tokens -= n
        return piece

    def _sequence(self, size: int, *first: tuple) -> Iterator[tuple]:
        """One sequence of exactly ``size`` tokens, at most as many as wait; ``first`` pieces are in it."""
        chosen, free = list(first), size - sum(len(p[2]) for p in first)
        for length, n in fullest(self.counts, free).items():
            chosen += [self._pop(length) for _ in range(n)]
            free -= n * length
        if free:  # the shortest piece that is longer lends its front; every shorter one is in the sequence
            document, start, ids = self._pop(min(n for n in self.counts if n > free))
            chosen.append((document, start, ids[:free]))
            self._push((document, start + free, ids[free:]))
        offset = 0
        for piece in chosen:
            yield piece, offset, self.next_id
            offset += len(piece[2])
        self.next_id += 1

    def add(self, document: tuple, ids: np.ndarray) -> Iterator[tuple]:
        """Take one document; whole sequences of a long one leave at once."""
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield (document, start, ids[start : start + self.capacity]), 0, self.next_id
            self.next_id += 1
        if whole < len(ids):
            self._push((document, whole, ids[whole:]))
        while self.pieces >= self.most and self.tokens >= self.capacity:
            yield from self._sequence(self.capacity, self._pop(max(self.counts)))

    def finish(self) -> Iterator[tuple]:
        """Everything that still waits."""
        while self.tokens >= self.capacity:
            yield from self._sequence(self.capacity, self._pop(max(self.counts)))
        while self.tokens:
            yield from self._sequence(1 << self.tokens.bit_length() - 1)


class WordIds:
    """Ids of texts under a tokenizer that drops white space: those of the blank-free words one after the other."""

    def __init__(self, path: str):
        self.words = tokens.from_word_json(path)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids); a null text is empty."""
        data, offsets = text_buffer(column)
        starts, ends, first = word_spans(data, offsets)
        return self.words.encode_spans(data, starts, ends, first)


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 4096, end_id: int = 2, waiting: int = WAITING) -> DataFrame:
    """Pack all documents, each followed by ``end_id``, into sequences of ``capacity`` tokens or, at a task's end, of a power of two.

    One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``. The tokenizer file must drop ASCII
    white space, as word-level BPE with word ends does. Every task packs the rows of its input split by itself, so nothing is shuffled
    and a lost task is repeated alone; it holds ``waiting`` pieces, each shorter than a sequence. Documents are cut where they are longer than a sequence and where the best choice
    of whole pieces leaves a gap. A null or empty text is the single token ``end_id``; rows with a null or repeated ``doc_id`` are
    packed as they are; other columns are ignored; an empty table gives no rows. ``capacity`` is a power of two.
    """
    if capacity < 1 or capacity & capacity - 1:
        raise ValueError("capacity must be a power of two")
    bounded_batches(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(("words", tokenizer_path), lambda: WordIds(tokenizer_path))
        packer = Packer(capacity, waiting, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids, offsets = encoder.encode(batch.column(1))
            rows = []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                own = np.append(ids[offsets[i] : offsets[i + 1]], end_id).astype("<u4")
                rows += map(_row, packer.add((doc_id, len(own)), own))
            if rows:
                yield _batch(rows)
        rows = [_row(placed) for placed in packer.finish()]
        if rows:
            yield _batch(rows)

    return docs.select(docs["doc_id"].cast("bigint"), docs["text"]).mapInArrow(task, SCHEMA)


def _row(placed: tuple) -> tuple:
    (document, start, ids), offset, sequence = placed
    return document[0], start, len(ids), zlib.crc32(ids.tobytes()), document[1], sequence, offset


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)
