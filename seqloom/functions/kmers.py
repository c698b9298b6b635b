"""k-mers as numbers over Arrow strings, and a Bloom filter over them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Fixed value: the letters a k-mer may hold, in the order of their digits.
LETTERS = "ACGTN"
#: Digits of base five that fit 63 bits.
LONGEST = 27
#: Letters worked on at a time; bounds the temporary arrays.
SLICE = 1 << 20

_DIGIT = np.full(256, -1, np.int64)
_DIGIT[np.frombuffer(LETTERS.encode(), np.uint8)] = range(len(LETTERS))


def distinct_kmers(column: pa.Array, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, k-mer) of a column of texts, each k-mer of a row once, some rows at a time.

    A k-mer is the number that its letters write in base five; one with another letter than ``ACGTN`` is left out, and a null text has none.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        # At least one row; a long one by itself.
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE, side="right")) - 1)
        values, rows = _packed(data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row], k)
        values, rows = _ordered(values, rows, stop - row, k)
        first = np.ones(len(values), bool)
        first[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
        yield rows[first] + row, values[first]
        row = stop


def _ordered(values: np.ndarray, rows: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    size = len(LETTERS) ** k
    if n * size < 1 << 63:
        # Both numbers in one sort as one, at a fraction of the time.
        both = np.sort(rows * size + values)
        rows = both // size
        return both - rows * size, rows
    order = np.lexsort((values, rows))
    return values[order], rows[order]


def _packed(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    n = max(len(data) - k + 1, 0)
    digits = _DIGIT[data]
    values = np.zeros(n, np.int64)
    for j in range(k):
        values *= len(LETTERS)
        values += digits[j : j + n]
    odd = np.concatenate([[0], np.cumsum(digits < 0)])
    places = np.arange(n)
    rows = np.searchsorted(offsets, places, side="right") - 1
    whole = (odd[k:][:n] == odd[:n]) & (places + k <= offsets[np.minimum(rows + 1, len(offsets) - 1)])
    return values[whole], rows[whole]


class Bloom:
    """Filter of 64-bit numbers with two hashes in ``bits`` bits, a power of two."""

    # Odd multipliers.
    FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

    def __init__(self, bits: int):
        self.shift = np.uint64(64 - (bits.bit_length() - 1))
        self.words = np.zeros(max(bits // 64, 1), np.uint64)

    def _places(self, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for factor in self.FACTORS:
            place = (values.astype(np.uint64) * np.uint64(factor)) >> self.shift
            yield (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))

    def add(self, values: np.ndarray) -> None:
        for word, bit in self._places(values):
            np.bitwise_or.at(self.words, word, bit)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        found = np.ones(len(values), bool)
        for word, bit in self._places(values):
            found &= (self.words[word] & bit) != 0
        return found
