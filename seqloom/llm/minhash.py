"""Near-duplicate documents by b-bit MinHash: bands for candidates, bit counts for estimates, full sets for links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .components import components
from .scratch import Scratch, bounded_batches
from .words import mix, runs, text_buffer, word_hashes, word_spans

#: At a similarity of 0.8 a pair shares no band with probability (1 - 0.8**6)**40, about 5e-6.
BANDS, ROWS = 40, 6
#: Low bits of each minimum kept in a packed signature.
BITS = 4
#: Pairs whose estimate is this far below the threshold are dropped unread: over six standard deviations.
SLACK = 0.17
#: Documents of one candidate group compared in one task.
BLOCK = 768
#: Rows of an id table (id, group, group size) that may be broadcast, at 24 bytes each.
SMALL_ROWS = 2_000_000

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    return (seeds[:n] >> _U(32)).astype(np.uint32) | np.uint32(1), (seeds[n:] >> _U(32)).astype(np.uint32)


def shingle_sets(column: pa.Array, words: int, *, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(sorted different shingle hashes of every text, offsets); fewer words make one shingle, no words none."""
    data, offsets = text_buffer(column)
    starts, ends, first = word_spans(_LOWER[data] if lower else data, offsets)
    hashes = word_hashes(_LOWER[data] if lower else data, starts, ends)
    shingles, at = runs(hashes, first, words)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    count = np.diff(first)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        whole = [mix(np.array([np.bitwise_xor.reduce(mix(hashes[first[i] : first[i + 1]] + np.arange(1, count[i] + 1, dtype=np.uint64)))], np.uint64)) for i in short]
        shingles, text = np.concatenate([shingles, *whole]), np.concatenate([text, short])
    order = np.lexsort((shingles, text))
    shingles, text = shingles[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (text[1:] != text[:-1])
    shingles, text = shingles[new], text[new]
    return shingles, np.searchsorted(text, np.arange(len(at)))


def minima(shingles: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """Per text with shingles, the minima under ``n`` hash functions."""
    some = offsets[:-1][np.diff(offsets) > 0]
    low = (shingles >> _U(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.empty((len(some), n), np.uint32)
    for k, (a, b) in enumerate(zip(*_coefficients(n), strict=True)):
        out[:, k] = np.minimum.reduceat(low * a + b, some) if len(some) else 0
    return out


def pack(mins: np.ndarray) -> np.ndarray:
    """Signatures: the low bits of all minima, sixteen to a 64-bit word."""
    nibbles = (mins ^ (mins >> np.uint32(16))).astype(np.uint64) & _U(15)
    pad = np.zeros((len(mins), -mins.shape[1] % 16), np.uint64)
    return np.bitwise_or.reduce(np.concatenate([nibbles, pad], axis=1).reshape(len(mins), -1, 16) << (np.arange(16, dtype=np.uint64) * _U(BITS)), axis=2)


def estimate(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Similarity of every signature of ``a`` to every one of ``b``: equal low bits counted, chance collisions taken off."""
    differ = np.zeros((len(a), len(b)), np.int64)
    for w in range(a.shape[1]):
        x = a[:, w, None] ^ b[None, :, w]
        x |= x >> _U(1)
        x |= x >> _U(2)
        differ += np.bitwise_count(x & _U(0x1111111111111111))
    chance = 2.0**-BITS
    return (1 - differ / n - chance) / (1 - chance)


def sketch(docs: DataFrame, words: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, same binary, bands array<long>``: ``same`` is one for equal sets, null with ``bands`` for empty ones."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles, offsets = shingle_sets(batch.column(1), words)
            count = np.diff(offsets)
            some = np.flatnonzero(count)
            mins = minima(shingles, offsets, bands * rows).astype(np.uint64).reshape(len(some), bands, rows)
            keys = np.broadcast_to(np.arange(bands, dtype=np.uint64), (len(some), bands)).copy()
            for r in range(rows):
                keys = mix(keys * _U(0xFF51AFD7ED558CCD) + mins[:, :, r] + _U(1))
            sums = np.zeros((batch.num_rows, 3), np.uint64)
            for j, salt in enumerate((0x51ED270B, 0x2545F491)):
                if len(some):
                    sums[some, j] = np.add.reduceat(mix(shingles ^ _U(salt)), offsets[:-1][some])
            sums[:, 2] = count
            empty = count == 0
            columns = [
                batch.column(0),
                pa.array(count.astype(np.int64)),
                pa.array([None if e else s.tobytes() for s, e in zip(sums, empty, strict=True)], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(~empty) * bands]).astype(np.int32)), pa.array(keys.reshape(-1).view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "same", "bands"])

    return docs.select(docs["doc_id"].cast("bigint"), docs["text"]).mapInArrow(task, "doc_id bigint, n_shingles bigint, same binary, bands array<bigint>")


def _sets(docs: DataFrame, words: int, n: int) -> DataFrame:
    """``doc_id, shingles binary, signature binary`` of rows with words."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles, offsets = shingle_sets(batch.column(1), words)
            some = np.flatnonzero(np.diff(offsets))
            signatures = pack(minima(shingles, offsets, n))
            columns = [
                batch.column(0).take(pa.array(some)),
                pa.array([shingles[offsets[i] : offsets[i + 1]].tobytes() for i in some], pa.binary()),
                pa.array([s.tobytes() for s in signatures], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shingles", "signature"])

    return docs.select(docs["doc_id"].cast("bigint"), docs["text"]).mapInArrow(task, "doc_id bigint, shingles binary, signature binary")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, for sorted sets."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    both = int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _links_in_blocks(percent: int, n: int, table: pa.Table) -> pa.RecordBatch | None:
    """A spanning set of the links between two blocks of one candidate group, or within one."""
    ids, own = table["doc_id"].to_numpy(), table["own"].to_numpy()
    left, right = table["left"][0].as_py(), table["right"][0].as_py()
    sets = [np.frombuffer(x, np.uint64) for x in table["shingles"].to_pylist()]
    signatures = np.array([np.frombuffer(x, np.uint64) for x in table["signature"].to_pylist()])
    x, y = np.flatnonzero(own == left), np.flatnonzero(own == right)
    near = estimate(signatures[x], signatures[y], n)
    if left == right:
        near[np.tril_indices(len(x))] = -1
    i, j = np.nonzero(near >= percent / 100 - SLACK)
    order = np.argsort(-near[i, j], kind="stable")
    i, j = x[i[order]], y[j[order]]
    forest, a, b = blocks.Forest(len(ids)), [], []
    for s in range(0, len(i), 256):
        open_ = forest.label[i[s : s + 256]] != forest.label[j[s : s + 256]]
        for p, q in zip(i[s : s + 256][open_], j[s : s + 256][open_], strict=True):
            if forest.label[p] != forest.label[q] and similar(sets[p], sets[q], percent):
                forest.union(p, q)
                a.append(int(ids[p]))
                b.append(int(ids[q]))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def near_duplicates(docs: DataFrame, *, words: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    A-Z are lower-cased; words are runs of characters other than ASCII blanks; a set holds the different runs of ``words`` words
    of the whole text, fewer words make one run, a null or blank text has an empty set and links with nothing. Documents link when
    ``100 * intersection >= percent * union``. ``component_id`` is the smallest doc_id reachable, ``kept`` marks it. Rows that share a
    doc_id are one document and all count as reachable; a null doc_id links with nothing, its component is null and kept null.

    1. Sketch every text once: set size, a 128-bit sum that is the same for equal sets, band keys of the minima.
    2. One representative (smallest doc_id) for each different set; copies link with it and go no further.
    3. Representatives in one band bucket hang on the smallest of it; the components of that table are candidate groups.
    4. Sets and b-bit signatures of candidates only; within each group, block against block, pairs whose estimated
       similarity is near the threshold are confirmed on full sets until all is joined that can be. Only a spanning set of links leaves a task.
    5. Components over all links.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    sketches = scratch.keep(sketch(docs, words, bands, rows), "sketches")
    known = sketches.filter("doc_id is not null and same is not null")
    first = known.groupBy("same").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    reps = scratch.keep(first, "reps")
    copies = known.select("doc_id", "same").join(reps.select("same", "rep"), "same").filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    keys = reps.select("rep", F.explode("bands").alias("band"))
    least = scratch.keep(keys.groupBy("band").agg(F.min("rep").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n"), "buckets")
    hung = keys.join(least, "band").filter("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b")).distinct()
    grouped = scratch.keep(components(hung, scratch), "groups")
    sizes = grouped.groupBy("component").agg(F.count("*").alias("size"))
    members = scratch.keep(grouped.join(sizes, "component"), "members")
    wanted = members.select("node", "component", "size")
    if members.count() <= SMALL_ROWS:
        wanted = F.broadcast(wanted)
    candidates = docs.select("doc_id", "text").join(wanted, docs["doc_id"] == F.col("node"))
    full = _sets(candidates.select("doc_id", "text"), words, bands * rows)
    placed = full.join(wanted, full["doc_id"] == F.col("node")).drop("node")
    dealt = blocks.block_pairs(placed, "component", "doc_id", "size", BLOCK)
    near = blocks.by_runs(dealt, ["component", "left", "right"], lambda t: _links_in_blocks(percent, bands * rows, t), "a bigint, b bigint")
    links = scratch.keep(copies.unionByName(near), "links")
    found = components(links, scratch)
    joined = sketches.select("doc_id", "n_shingles").join(found, F.col("doc_id") == F.col("node"), "left")
    result = joined.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return result.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def keep_one(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, whose document is the smallest of its group; rows with a null doc_id stay."""
    gone = Scratch(docs.sparkSession).keep(near_duplicates(docs, words=words, percent=percent).filter("not kept").select("doc_id").distinct(), "gone")
    gone = gone.withColumnRenamed("doc_id", "__gone")
    if gone.count() <= SMALL_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")
