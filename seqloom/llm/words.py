"""Words of whole texts as numpy arrays over Arrow buffers: spans, 64-bit hashes, runs of words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that separate words, [\x20\x09-\x0D].
SEPARATORS = [9, 10, 11, 12, 13, 32]
#: Bytes hashed at a time; bounds the temporary arrays.
SLICE = 1 << 20

_IS_SEPARATOR = np.zeros(256, bool)
_IS_SEPARATOR[SEPARATORS] = True
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, in place."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = _U(0x9E6C63D0876A9A47)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """Powers of the base up to n, mod 2**64."""
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * (_powers[-1:] * _BASE)])
    return _powers


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, offsets of each); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if large else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    o = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return b, o - o[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of each text's first word with the total appended); a word never crosses texts."""
    inside = ~_IS_SEPARATOR[data]
    first = np.empty(len(data) + 1, bool)
    first[0] = True
    first[1:] = False
    first[1:-1] = ~inside[:-1]
    first[offsets] = True
    starts = np.flatnonzero(inside & first[:-1])
    last = first[1:].copy()
    if len(data):
        last[:-1] |= ~inside[1:]
        last[-1] = True
    ends = np.flatnonzero(inside & last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word: a polynomial over random byte values, finalised with the length."""
    n = len(starts)
    out = np.empty(n, np.uint64)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE)))
        s, length = starts[i:j], ends[i:j] - starts[i:j]
        at = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(at, length)
        powers = _power(int(length.max()) + 1)
        terms = _BYTE[data[place + np.repeat(s, length)]]
        terms *= powers[place]
        out[i:j] = mix(np.add.reduceat(terms, at) ^ (length.astype(np.uint64) * _U(0xD6E8FEB86659FD93)))
        i = j
    return out


def runs(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every k consecutive words of one text, index of each text's first run with the total appended)."""
    count = np.maximum(np.diff(first) - (k - 1), 0)
    starts = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(starts[-1]) - np.repeat(starts[:-1], count) + np.repeat(first[:-1], count)
    out = np.zeros(len(at), np.uint64)
    for d in range(k):
        out *= _U(0xFF51AFD7ED558CCD)
        out += hashes[at + d]
        if d + 1 < k:
            out ^= out >> _U(29)
    return mix(out), starts
