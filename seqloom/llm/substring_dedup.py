"""Removal of long word passages that occur in an earlier document, by prefix-partitioned suffix trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch, bounded_batches
from .words import mix, runs, text_buffer, word_hashes, word_spans

WINDOW = 13
#: Words of the short prefix by which suffixes are grouped.
PREFIX = 4
#: Suffixes of one short prefix that are put into one subtree; above it the prefix is the whole window.
SUBTREE = 2000
#: Words that lie between one level of a subtree and the next.
EDGE = 5

_U = np.uint64


def anchors(hashes: np.ndarray, first: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes that stand for all windows: (text, place, prefix hash, first window, last window) of each.

    Of the prefixes within a window the one with the least hash, the first of equals, is its anchor; equal windows have equal
    anchors at equal places, so what repeats a window repeats its anchor, and only two in eleven suffixes are anchors.
    """
    grams, at = runs(hashes, first, prefix)
    count = np.maximum(np.diff(first) - (window - 1), 0)
    text = np.repeat(np.arange(len(count)), count)
    own = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = own + np.repeat(at[:-1], count)
    place, least = np.zeros(len(begin), np.int64), grams[begin]
    for t in range(1, window - prefix + 1):
        other = grams[begin + t]
        better = other < least
        least[better] = other[better]
        place[better] = t
    place += own
    new = np.ones(len(own), bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    lead = np.flatnonzero(new)
    last = own[np.append(lead[1:], len(own)) - 1] if len(own) else own
    return text[lead], place[lead], least[lead], own[lead], last


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_buffer(column)
    starts, ends, first = word_spans(data, offsets)
    return word_hashes(data, starts, ends), first


def _screened(docs: DataFrame, window: int, places: bool) -> DataFrame:
    """``prefix, doc_id`` of every anchor, with ``twin`` (a hash that tells rows of one doc_id apart) and ``place`` if asked for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = _words(batch.column(2))
            text, place, prefix, _, _ = anchors(hashes, first, window, PREFIX)
            for i in range(0, len(text), 100_000):
                part = slice(i, i + 100_000)
                rows = pa.array(text[part])
                columns = [pa.array(prefix[part].view(np.int64)), batch.column(0).take(rows)]
                if places:
                    columns += [batch.column(1).take(rows), pa.array(place[part].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["prefix", "doc_id", "twin", "place"][: len(columns)])

    schema = "prefix bigint, doc_id bigint" + ", twin int, place int" * places
    return docs.filter("doc_id is not null").mapInArrow(task, schema)


def _segments(docs: DataFrame, window: int) -> DataFrame:
    """The words around every listed anchor: ``prefix, large, doc_id, twin, start, words`` with the hashes of all words of its windows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, first = _words(batch.column(2))
            text, place, prefix, low, high = anchors(hashes, first, window, PREFIX)
            lists = batch.column(3)
            asked = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            span = np.int64(1) << 40
            listed = np.sort(owner * span + asked)  # place * 2 + large, sorted by text and place
            own = text * span + place * 2
            at = np.minimum(np.searchsorted(listed, own), max(len(listed) - 1, 0))
            keep = np.flatnonzero((listed[at] | 1) == (own | 1)) if len(listed) else np.zeros(0, np.int64)
            large = (listed[at[keep]] & 1).astype(bool) if len(listed) else np.zeros(0, bool)
            for i in range(0, len(keep), 20_000):
                k = keep[i : i + 20_000]
                rows = pa.array(text[k])
                begin, length = first[text[k]] + low[k], high[k] - low[k] + window
                flat = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(begin, length)
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                columns = [
                    pa.array(prefix[k].view(np.int64)), pa.array(large[i : i + 20_000]), batch.column(0).take(rows), batch.column(1).take(rows),
                    pa.array(low[k].astype(np.int32)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes[flat].view(np.int64))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["prefix", "large", "doc_id", "twin", "start", "words"])

    return docs.mapInArrow(task, "prefix bigint, large boolean, doc_id bigint, twin int, start int, words array<bigint>")


def _windows(table: pa.Table | pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start within the flat words, flat words) of every window of the segments."""
    lists = table["words"] if isinstance(table, pa.RecordBatch) else table["words"].combine_chunks()
    length = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    count = length - (window - 1)
    row = np.repeat(np.arange(len(length)), count)
    start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(np.cumsum(length) - length, count)
    return row, start, flat


def _edge(flat: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    for t in range(length):
        h = mix(h * _U(0xFF51AFD7ED558CCD) + flat[at + t] + _U(1))
    return h


def repeated(node: np.ndarray, start: np.ndarray, flat: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Which suffixes stand below a node of depth ``window`` that a smaller document also stands below.

    The subtrees of many prefixes at once, from their roots (``node``, one number for each prefix) down: a level splits
    every node by its suffixes' next words, and leaves the nodes with a single suffix behind, which repeat nothing. Nodes
    left at depth ``window`` are the repeats; each extends as far as neighbouring windows are repeated too.
    """
    out = np.zeros(len(node), bool)
    live, depth = np.arange(len(node)), 0
    while depth < window and len(live):
        step = min(EDGE, window - depth)
        key = mix(node.astype(np.uint64) * _U(0x9E3779B97F4A7C15) + _edge(flat, start[live] + depth, step))
        by = np.argsort(key, kind="stable")
        ordered = key[by]
        new = np.ones(len(by), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        number = np.cumsum(new) - 1
        shared = np.bincount(number)[number] > 1
        live, node, depth = live[by[shared]], number[shared], depth + step
    if len(live):
        edges = np.flatnonzero(np.diff(node, prepend=-1))
        least = np.minimum.reduceat(doc[live], edges)
        out[live] = doc[live] > np.repeat(least, np.diff(np.append(edges, len(live))))
    return out


def _passages(table: pa.Table, window: int) -> pa.RecordBatch:
    """``doc_id, twin, start, stop`` of the repeated words that the segments of whole prefix groups show."""
    row, start, flat = _windows(table, window)
    prefix, doc = table["prefix"].to_numpy(), table["doc_id"].to_numpy()
    root = np.unique(prefix, return_inverse=True)[1]
    hit = np.flatnonzero(repeated(root[row], start, flat, doc[row], window))
    lead = np.ones(len(hit), bool)
    lead[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
    begin = np.flatnonzero(lead)
    stop = np.append(begin[1:], len(hit)) - 1
    count = np.bincount(row, minlength=table.num_rows)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    low = table["start"].to_numpy().astype(np.int64)
    r = row[hit[begin]] if len(hit) else np.zeros(0, np.int64)
    columns = [
        pa.array(doc[r]), pa.array(table["twin"].to_numpy()[r]), pa.array((low[r] + place[hit[begin]]).astype(np.int32)),
        pa.array((low[r] + place[hit[stop]] + window).astype(np.int32)),
    ] if len(hit) else [pa.array([], pa.int64()), pa.array([], pa.int32()), pa.array([], pa.int32()), pa.array([], pa.int32())]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "twin", "start", "stop"])


PASSAGES = "doc_id bigint, twin int, start int, stop int"


def _subtrees(segments: DataFrame, window: int) -> DataFrame:
    """Repeated passages of the prefixes whose suffixes fit one subtree; many subtrees are built at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            prefix = batch.column(0).to_numpy(zero_copy_only=False)
            last = int(np.searchsorted(prefix, prefix[-1])) if len(prefix) else 0
            if last or (held and len(prefix) and held[-1].column(0)[-1].as_py() != prefix[0]):
                held.append(batch.slice(0, last))
                yield _passages(pa.Table.from_batches(held), window)
                held = []
            held.append(batch.slice(last))
        if held:
            yield _passages(pa.Table.from_batches(held), window)

    return segments.repartition("prefix").sortWithinPartitions("prefix").mapInArrow(task, PASSAGES)


def _full_prefixes(segments: DataFrame, window: int) -> DataFrame:
    """Repeated windows of the prefixes with many suffixes: there the prefix is the whole window, and a node is its least document."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, flat = _windows(batch, window)
            count = np.bincount(row, minlength=batch.num_rows)
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            at = batch.column(4).to_numpy(zero_copy_only=False)[row] + place
            rows = pa.array(row)
            columns = [batch.column(0).take(rows), pa.array(_edge(flat, start, window).view(np.int64)), batch.column(2).take(rows), batch.column(3).take(rows), pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["prefix", "whole", "doc_id", "twin", "start"])

    suffixes = segments.mapInArrow(task, "prefix bigint, whole bigint, doc_id bigint, twin int, start int")
    # The occurrences in a node's least document are marked by one more row and fall; keys hold the document, so no passage is one key.
    firsts = suffixes.groupBy("prefix", "whole").agg(F.min("doc_id").alias("doc_id")).select("prefix", "whole", "doc_id", F.lit(None).cast("struct<twin:int,start:int>").alias("at"))
    marked = suffixes.select("prefix", "whole", "doc_id", F.struct("twin", "start").alias("at")).unionByName(firsts)
    by_doc = marked.groupBy("prefix", "whole", "doc_id").agg(F.collect_list("at").alias("at"), F.count("*").alias("n"))
    hit = by_doc.filter(F.col("n") == F.size("at")).select("doc_id", F.inline("at"))
    return hit.select("doc_id", "twin", "start", (F.col("start") + window).cast("int").alias("stop"))


def _marked(docs: DataFrame, window: int) -> DataFrame:
    """``docs`` with ``__starts`` and ``__stops``: sorted word ranges to remove, null where there are none."""
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.hash("text").alias("twin"), "text")
    # A prefix that stands in one document only repeats nothing.
    counted = _screened(keyed, window, False).groupBy("prefix").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).filter("low < high")
    # Written first: a join of two plain shuffles may be split at a prefix that a third of the documents hold.
    shared = scratch.keep(counted.select("prefix", (F.col("n") > SUBTREE).alias("large")), "shared")
    listed = _screened(keyed, window, True).join(shared, "prefix")
    places = scratch.keep(listed.select("doc_id", "twin", (F.col("place").cast("bigint") * 2 + F.col("large").cast("int")).alias("place")), "places")
    scratch.drop("shared")
    by_doc = places.groupBy("doc_id", "twin").agg(F.collect_list("place").alias("places"))
    segments = scratch.keep(_segments(keyed.join(by_doc, ["doc_id", "twin"]), window), "segments")
    scratch.drop("places")
    small, large = segments.filter("not large"), segments.filter("large")
    passages = scratch.keep(_subtrees(small, window).unionByName(_full_prefixes(large, window)), "passages")
    scratch.drop("segments")
    ranges = passages.groupBy("doc_id", "twin").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
    ranges = ranges.select(F.col("doc_id").alias("__doc"), F.col("twin").alias("__twin"), F.col("ranges.start").alias("__starts"), F.col("ranges.stop").alias("__stops"))
    on = (docs["doc_id"].cast("bigint") == F.col("__doc")) & (F.hash(docs["text"]) == F.col("__twin"))
    return docs.join(ranges, on, "left").drop("__doc", "__twin")


def _kept(text: str | None, starts: list[int] | None, stops: list[int] | None) -> tuple[bytes, int, int]:
    words = (text or "").encode("utf-8").split()
    if not starts:
        return b" ".join(words), len(words), 0
    edge = np.zeros(len(words) + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]), len(words), int(gone.sum())


def remove_repeats(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every row.

    Words are runs of characters other than ASCII blanks. A word is removed when a run of ``window`` words that covers it starts also in
    a document with a smaller doc_id; runs are judged on the input. What stays is joined by single blanks. A null text has no
    words; texts shorter than the window lose nothing; rows of one doc_id do not remove each other's words; a row with a null doc_id neither
    loses words nor removes any.

    1. Anchors: per window the least prefix of 4 words. Prefixes found in one document only are dropped by a count.
    2. The words around the others are dealt by prefix: suffix groups of up to ``SUBTREE`` become subtrees of one task, larger
       ones are split on by the whole window as prefix, where a partly aggregated minimum is the node.
    3. Nodes of depth ``window`` with a smaller document give the passages; they are joined to the documents once.
    """
    ready = _marked(docs.select("doc_id", "text"), window).select(F.col("doc_id").cast("bigint"), "text", "__starts", "__stops")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_kept(*x) for x in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)]
            kept, n, removed = zip(*found, strict=True) if found else ((), (), ())
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_removed", "kept_text"])

    return ready.mapInArrow(task, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def clean(docs: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """``docs`` with all its columns; texts that lose words hold the kept words, the others stay as they are."""
    marked = _marked(docs, window)
    at = marked.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            lost = zip(texts, batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)
            new = [t if not a else _kept(t, a, b)[0].decode("utf-8") for t, a, b in lost]
            columns = [pa.array(new, batch.column(at).type) if i == at else c for i, c in enumerate(batch.columns[:-2])]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(batch.schema)[:-2]))

    return marked.mapInArrow(task, docs.schema)
