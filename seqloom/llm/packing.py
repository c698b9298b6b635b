"""Best-fit packing of token sequences: bounded-space online best fit, one packer per task."""

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

#: Open bins of a task at most; what they leave empty at its end is the price of packing without a shuffle.
OPEN_BINS = 512

SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


class Bins:
    """Open bins keyed by free space: bit f of one integer is set while a bin with f free places is open."""

    def __init__(self, capacity: int, most: int, first_id: int = 0):
        self.capacity, self.most, self.next_id = capacity, most, first_id
        self.free_bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0

    def _push(self, bin_id: int, free: int) -> None:
        if free:
            self.by_free[free].append(bin_id)
            self.free_bits |= 1 << free
            self.open += 1

    def _pop(self, free: int) -> int:
        bin_id = self.by_free[free].pop()
        self.open -= 1
        if not self.by_free[free]:
            self.free_bits ^= 1 << free
        return bin_id

    def place(self, size: int) -> tuple[int, int]:
        """(bin, offset) for a piece of ``size`` in 1..capacity: the fullest bin that holds it, else a new one."""
        fits = self.free_bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_id = self._pop(free)
        else:
            if self.open >= self.most:  # the fullest bin closes first
                self._pop((self.free_bits & -self.free_bits).bit_length() - 1)
            bin_id, free = self.next_id, self.capacity
            self.next_id += 1
        self._push(bin_id, free - size)
        return bin_id, self.capacity - free


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of one document; only what is longer than a sequence is cut, short piece first."""
    head = length % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, length, capacity))]


def pack(docs: DataFrame, tokenizer_path: str, *, capacity: int = 2048, end_id: int = 0, open_bins: int = OPEN_BINS) -> DataFrame:
    """Pack whole documents, each followed by ``end_id``, into sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. Every task packs the rows of its input
    split with bins of its own, so nothing is shuffled and a lost task is repeated alone. Pieces of one Arrow batch
    are placed longest first. A null or empty text is the single token ``end_id``; rows with a null or repeated
    ``doc_id`` are packed as they are; other columns are ignored; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(("json", tokenizer_path), lambda: tokens.from_json(tokenizer_path))
        bins = Bins(capacity, open_bins, TaskContext.get().partitionId() << 40)
        for batch in batches:
            ids, offsets = encoder.encode(batch.column(1))
            rows, pieces = [], []
            for i in range(batch.num_rows):
                own = np.append(ids[offsets[i] : offsets[i + 1]], end_id).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(own), capacity)):
                    pieces.append((i, piece, start, length, zlib.crc32(own[start : start + length].tobytes())))
            for p in sorted(pieces, key=lambda p: -p[3]):
                rows.append((*p, *bins.place(p[3])))
            if rows:
                row, *rest = zip(*rows, strict=True)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                columns = [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(x, k) for x, k in zip(rest, kinds, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return docs.select(docs["doc_id"].cast("bigint"), docs["text"]).mapInArrow(task, SCHEMA)
