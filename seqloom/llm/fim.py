"""Fill-in-middle transformation: sentinels inserted in a byte buffer, segments exchanged in place by rotations, and back."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import bounded_batches

#: The marks before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Percent of documents that stay plain, and of the others that begin with the suffix.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
#: Bytes scanned or exchanged at a time; bounds the temporary arrays whatever the length of a text.
SLICE = 1 << 20


def byte_cuts(data: np.ndarray, cuts: Sequence[int]) -> list[int]:
    """The byte at which each of the ascending code points ``cuts`` begins; the end of the text where there is none."""
    out, seen, at = [], 0, 0
    while at < len(data) and len(out) < len(cuts):
        leads = np.flatnonzero((data[at : at + SLICE] & 0xC0) != 0x80)
        while len(out) < len(cuts) and cuts[len(out)] < seen + len(leads):
            out.append(at + int(leads[cuts[len(out)] - seen]))
        seen += len(leads)
        at += SLICE
    return out + [len(data)] * (len(cuts) - len(out))


def reverse(block: np.ndarray) -> None:
    """Reverse the bytes of ``block`` in place, a slice from each end at a time."""
    half, n = len(block) // 2, len(block)
    for at in range(0, half, SLICE):
        to = min(at + SLICE, half)
        front = block[at:to].copy()
        block[at:to] = block[n - to : n - at][::-1]
        block[n - to : n - at] = front[::-1]


def rotate(buffer: bytearray, left: int, middle: int, right: int) -> None:
    """Exchange the neighbours [left, middle) and [middle, right) in place by three reversals."""
    block = np.frombuffer(buffer, np.uint8)[left:right]
    reverse(block[: middle - left])
    reverse(block[middle - left :])
    reverse(block)


def arrange(text: bytes, form: str, cuts: Sequence[int], marks: Sequence[bytes]) -> bytearray:
    """``text`` with its marks, in the order of ``form``; ``cuts`` are the ends of prefix and middle in code points."""
    prefix, suffix, middle = marks
    buffer = bytearray(text)
    first, second = byte_cuts(np.frombuffer(text, np.uint8), cuts)
    buffer[second:second] = suffix
    buffer[first:first] = middle
    buffer[:0] = prefix
    first += len(prefix)
    second += len(prefix) + len(middle)  # prefix at 0, middle at first, suffix at second
    rotate(buffer, first if form == "psm" else 0, second, len(buffer))
    return buffer


def rebuild(output: bytes, form: str, marks: Sequence[bytes]) -> bytearray:
    """The text that ``arrange`` was given: the rotation inverted, the marks taken out."""
    prefix, suffix, middle = marks
    buffer, end = bytearray(output), len(output)
    if form == "psm":
        first, turned = output.find(suffix), output.find(middle)
        rotate(buffer, first, turned, end)
        second = first + end - turned
    else:
        turned = output.find(prefix)
        rotate(buffer, 0, turned, end)
        first, second = output.find(middle) - turned, end - turned
    del buffer[second : second + len(suffix)]
    del buffer[first : first + len(middle)]
    del buffer[: len(prefix)]
    return buffer


def _marks(sentinels: Sequence[str]) -> list[bytes]:
    """The marks as bytes, if none can begin inside another or across a border between a mark and a text without marks."""
    head = {s[:1] for s in sentinels}
    if len(sentinels) != 3 or len(head) != 1 or "" in head or any(next(iter(head)) in s[1:] for s in sentinels):
        raise ValueError("three sentinels with one first character that none holds again")
    if any(a is not b and b.startswith(a) for a in sentinels for b in sentinels):
        raise ValueError("no sentinel may begin another")
    return [s.encode() for s in sentinels]


def _number(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("bigint")


def transform(docs: DataFrame, *, seed: int = 1, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row, in input order and without a shuffle.

    Cuts and form come from a digest of ``seed`` and ``doc_id``, so retries agree: ``psm`` is prefix, suffix, middle, each after its sentinel, ``spm`` begins with the
    suffix, ``plain`` is the text itself. Empty and null texts and those that hold a sentinel stay plain, with null
    lengths; cuts may fall together or at the ends, and never inside a code point. A null doc_id is hashed as an empty
    one; repeated rows give equal rows; columns besides ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    marks = _marks(sentinels)
    bounded_batches(docs.sparkSession)
    text, doc_id = F.coalesce(docs["text"], F.lit("")), docs["doc_id"].cast("bigint")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    base = docs.select(doc_id.alias("doc_id"), text.alias("text"), digest.alias("digest"), F.length(text).cast("bigint").alias("n"))
    digest, n = F.col("digest"), F.col("n")
    plain = (n == 0) | (_number(digest, 2) % 100 >= 100 - plain_percent)
    for s in sentinels:
        plain |= F.col("text").contains(s)
    form = F.when(plain, "plain").when(_number(digest, 3) % 100 < spm_percent, "spm").otherwise("psm")
    cuts = [_number(digest, k) % (n + 1) for k in (0, 1)]
    chosen = base.select("doc_id", "n", form.alias("form"), F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"), "text")
    cut = F.col("form") != "plain"
    chosen = chosen.select("doc_id", "n", "form", F.when(cut, F.col("a")).alias("prefix_chars"), F.when(cut, F.col("b") - F.col("a")).alias("middle_chars"), "text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, prefixes, middles = (batch.column(i).to_pylist() for i in (2, 3, 4))
            texts = batch.column(5).cast(pa.binary()).to_pylist()
            rows = zip(texts, forms, prefixes, middles, strict=True)
            out = [t if f == "plain" else bytes(arrange(t, f, (a, a + m), marks)) for t, f, a, m in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(out, pa.binary()).cast(pa.string())], names=[*batch.schema.names[:5], "output"])

    return chosen.mapInArrow(task, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restore(outputs: DataFrame, *, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """``outputs`` with the column ``restored``, the exact text behind each ``output``, from it and its ``form`` alone.

    A null output stays null and a null form counts as plain; other columns pass through, save an older ``restored``.
    """
    marks = _marks(sentinels)
    bounded_batches(outputs.sparkSession)
    outputs = outputs.drop("restored")
    at, kind = outputs.columns.index("output"), outputs.columns.index("form")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(at).cast(pa.binary()).to_pylist(), batch.column(kind).to_pylist(), strict=True)
            out = [o if o is None or f in (None, "plain") else bytes(rebuild(o, f, marks)) for o, f in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary()).cast(pa.string())], names=[*batch.schema.names, "restored"])

    return outputs.mapInArrow(task, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in outputs.schema)}, restored string")


def digest(outputs: DataFrame) -> DataFrame:
    """The rows of ``transform`` with digests in place of the texts, that of the restored text besides."""
    rows = restore(outputs)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
