"""Adapter clipping and barcode assignment."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import bases
from ..functions.joins import join_small
from ..options import choice, fail_when, positive

_HIT = "struct<start:int,stop:int>"


def _exact(seq: Column, adapters: Sequence[str], where: str, overlap: int) -> Column:
    """The rule of :func:`_search` without mismatches, in the JVM: most bases, then leftmost, then the first adapter.

    Each adapter has up to three hits: whole, cut off by the read's end, cut off by its start.
    """
    hits: list[Column] = []

    def hit(found: Column, bases_: Column, start: Column, rank: int) -> None:
        hits.append(F.when(found, F.struct(bases_.cast("int").alias("n"), (-start).cast("int").alias("s"), F.lit(-rank).alias("r"))))

    for rank, a in enumerate(adapters):
        at = F.instr(seq, a)
        hit(at > 0, F.lit(len(a)), at - 1, rank)
        cut = range(len(a) - 1, overlap - 1, -1)
        if where in "ab" and cut:
            begin = F.regexp_instr(seq, F.lit("(?:" + "|".join(re.escape(a[:k]) for k in cut) + ")$"))
            hit(begin > 0, F.length(seq) - begin + 1, begin - 1, rank)
        if where in "gb" and cut:
            head = F.length(F.regexp_substr(seq, F.lit("^(?:" + "|".join(re.escape(a[-k:]) for k in cut) + ")")))
            hit(head.isNotNull(), head, F.lit(0), rank)
    best = F.array_max(F.array(*hits))
    start = F.when(best.isNull(), F.lit(-1)).otherwise(-best["s"])
    return F.struct(start.alias("start"), F.when(best.isNull(), F.lit(-1)).otherwise(start + best["n"]).alias("stop"))


def _search(adapters: Sequence[str], where: str, rate: float, overlap: int, adapter_n: bool, read_n: bool):
    """Pandas UDF finding the best placement of any adapter with bounded mismatches.

    Every read offset is one vectorised comparison over the whole Arrow batch.
    Best means most matching bases, then the leftmost start, then the first adapter.
    """
    n_code = ord("N")

    def place(seq: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        codes, lengths = bases.byte_matrix(seq)
        best = np.zeros(len(seq), np.int64)
        start = np.full(len(seq), -1, np.int64)
        stop = np.full(len(seq), -1, np.int64)
        width = codes.shape[1]
        for a in adapters:
            pattern = np.frombuffer(a.encode(), np.uint8)
            free = (pattern == n_code) if adapter_n else np.zeros(len(pattern), bool)
            first = -(len(a) - overlap) if where in "gb" else 0
            for at in range(first, max(width - overlap, 0) + 1):
                lo, hi = max(at, 0), min(at + len(a), width)
                if hi - lo < overlap:
                    continue
                window, part, any_base = codes[:, lo:hi], pattern[lo - at : hi - at], free[lo - at : hi - at]
                inside = window != 0
                hit = ((window == part) | any_base) & inside
                if read_n:
                    hit |= (window == n_code) & inside
                used, same = inside.sum(1), hit.sum(1)
                whole = used == len(a)
                partial = (used == lengths - at) if where in "ab" else np.zeros(len(seq), bool)
                if at < 0:
                    partial = used == at + len(a)
                ok = (whole | partial) & (used >= overlap) & (used - same <= np.floor(rate * used + 1e-9))
                better = ok & ((same > best) | ((same == best) & (start >= 0) & (lo < start)))
                best[better], start[better], stop[better] = same[better], lo, (lo + used)[better]
        return start, stop

    @F.pandas_udf(_HIT)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = np.full((len(batch), 2), -1, np.int64)
            for rows in bases.even_slices(bases.text_lengths(batch)):
                out[rows] = np.column_stack(place(batch.iloc[rows]))
            yield pd.DataFrame({"start": out[:, 0], "stop": out[:, 1]}).astype("int32")

    return search


def find_adapter(
    seq: Column,
    adapters: Sequence[str],
    *,
    where: str = "a",
    error_rate: float = 0.1,
    overlap: int = 3,
    adapter_wildcards: bool = True,
    read_wildcards: bool = False,
) -> Column:
    """0-based half-open ``struct<start,stop>`` of the adapter, start -1 when there is none.

    ``where``: ``a`` 3' adapter, ``g`` 5' adapter, ``b`` either. The hit with the most matching bases counts, of equals
    the leftmost, then the first adapter. Without allowed mismatches and wildcards the JVM finds it, else a batched
    search; both follow the same rule.
    """
    choice("where", where, "agb")
    positive("overlap", overlap)
    if not adapters or any(len(a) == 0 for a in adapters):
        raise ValueError("adapters must be non-empty strings")
    wild = (adapter_wildcards and any("N" in a for a in adapters)) or read_wildcards
    if not wild and all(int(error_rate * len(a) + 1e-9) == 0 for a in adapters):
        return _exact(seq, adapters, where, overlap)
    return _search(list(adapters), where, error_rate, overlap, adapter_wildcards, read_wildcards)(seq)


def clip_adapter(
    df: DataFrame,
    adapters: Sequence[str],
    *,
    where: str = "a",
    error_rate: float = 0.1,
    overlap: int = 3,
    times: int = 1,
    adapter_wildcards: bool = True,
    read_wildcards: bool = False,
    mask: bool = False,
    no_trim: bool = False,
    revcomp: bool = False,
) -> DataFrame:
    """Remove (or mask with N) adapters; ``clip_len`` holds the bases removed or masked, 0 for none.

    ``b`` adapters act like 5' adapters when they touch the read start, else like 3' ones.
    With ``revcomp`` a read whose reverse complement carries the adapter is turned round first.
    """
    positive("times", times)
    if mask and no_trim:
        raise ValueError("mask and no_trim exclude each other")
    opts = dict(
        where=where, error_rate=error_rate, overlap=overlap, adapter_wildcards=adapter_wildcards,
        read_wildcards=read_wildcards,
    )
    out = df
    if revcomp:
        out = out.withColumns(
            {
                "_fwd": find_adapter(F.col("seq"), adapters, **opts),
                "_rev": find_adapter(bases.reverse_complement("seq"), adapters, **opts),
            }
        )
        turn = (F.col("_fwd.start") < 0) & (F.col("_rev.start") >= 0)
        out = out.withColumns(
            {
                "seq": F.when(turn, bases.reverse_complement("seq")).otherwise(F.col("seq")),
                "qual": F.when(turn, F.reverse("qual")).otherwise(F.col("qual")),
                "is_rc": turn,
            }
        ).drop("_fwd", "_rev")
    out = out.withColumn("clip_len", F.lit(0))
    for _ in range(times):
        out = out.withColumn("_hit", find_adapter(F.col("seq"), adapters, **opts))
        found = F.col("_hit.start") >= 0
        if where == "g":
            front = found
        elif where == "a":
            front = F.lit(False)
        else:
            front = F.col("_hit.start") == 0
        size = F.length("seq")
        lo = F.when(front, F.col("_hit.stop")).otherwise(F.lit(0))
        hi = F.when(found & ~front, F.col("_hit.start")).otherwise(size)
        out = out.withColumns({"_lo": lo, "_hi": hi})
        removed = F.length("seq") - (F.col("_hi") - F.col("_lo"))
        if no_trim:
            out = out.withColumn("clip_len", F.greatest("clip_len", F.when(found, removed).otherwise(0)))
        elif mask:
            kept = F.substr("seq", F.col("_lo") + 1, F.col("_hi") - F.col("_lo"))
            masked = F.concat(F.repeat(F.lit("N"), F.col("_lo")), kept, F.repeat(F.lit("N"), size - F.col("_hi")))
            out = out.withColumns({"clip_len": F.col("clip_len") + removed, "seq": masked})
        else:
            span = (F.col("_lo") + 1, F.col("_hi") - F.col("_lo"))
            out = out.withColumns(
                {"clip_len": F.col("clip_len") + removed, "seq": F.substr("seq", *span), "qual": F.substr("qual", *span)}
            )
        out = out.drop("_hit", "_lo", "_hi")
    return out


def discard_trimmed(df: DataFrame) -> DataFrame:
    return df.filter("clip_len = 0")


def discard_untrimmed(df: DataFrame) -> DataFrame:
    return df.filter("clip_len > 0")


def _spelled(samples: DataFrame, barcode: str, mismatches: int) -> DataFrame:
    """(sample, barcode) for every string within ``mismatches`` of the sample's barcode."""
    near = samples.select("sample", F.col(barcode).alias("barcode"))
    for _ in range(mismatches):
        at = F.explode(F.sequence(F.lit(1), F.length("barcode"))).alias("_i")
        step = near.select("sample", "barcode", at)
        letter = F.explode(F.array(*[F.lit(x) for x in "ACGTN"])).alias("_x")
        step = step.select("sample", "barcode", "_i", letter)
        near = step.select(
            "sample",
            F.concat(
                F.substr("barcode", F.lit(1), F.col("_i") - 1), F.col("_x"), F.substr("barcode", F.col("_i") + 1)
            ).alias("barcode"),
        ).distinct()
    return near


def barcode_neighbours(samples: DataFrame, *, barcode: str = "index_r1", mismatches: int = 1) -> DataFrame:
    """Every string within ``mismatches`` of a barcode, with the sample it means.

    ``sample`` is NULL where two samples claim the same string.
    """
    return _spelled(samples, barcode, mismatches).groupBy("barcode").agg(
        F.when(F.count_distinct("sample") == 1, F.min("sample")).alias("sample")
    )


def demultiplex(
    reads: DataFrame,
    samples: DataFrame,
    *,
    read_barcode: str = "barcode",
    barcode: str = "index_r1",
    read_barcode2: str | None = None,
    barcode2: str = "index_r2",
    mismatches: int = 1,
) -> DataFrame:
    """Assign reads to samples by index barcode; no or several candidates give ``Undetermined``.

    Allowed mismatches are spelled out on the small barcode side, so the reads need one equi-join per index. With
    ``read_barcode2`` a sample must match both indices, each within ``mismatches``; a sample without a second one matches by the first.
    """
    choice("mismatches", mismatches, (0, 1, 2))
    if read_barcode2 is None:
        near = barcode_neighbours(samples, barcode=barcode, mismatches=mismatches)
        near = near.select(F.col("barcode").alias(read_barcode), F.col("sample").alias("_found"))
        joined = join_small(reads, near, read_barcode, "left")
        return joined.withColumn("sample", F.coalesce("_found", F.lit("Undetermined"))).drop("_found")
    single = samples.filter(F.col(barcode2).isNull()).select("sample").distinct().withColumn("_single", F.lit(True))
    first = _spelled(samples, barcode, mismatches).join(single, "sample", "left")
    first = first.groupBy(F.col("barcode").alias(read_barcode)).agg(
        F.collect_set("sample").alias("_first"), F.collect_set(F.when(F.col("_single"), F.col("sample"))).alias("_alone")
    )
    second = _spelled(samples.filter(F.col(barcode2).isNotNull()), barcode2, mismatches)
    second = second.groupBy(F.col("barcode").alias(read_barcode2)).agg(F.collect_set("sample").alias("_second"))
    joined = join_small(join_small(reads, first, read_barcode, "left"), second, read_barcode2, "left")
    none = F.array().cast("array<string>")
    both = F.array_intersect(F.coalesce("_first", none), F.coalesce("_second", none))
    found = F.array_union(both, F.coalesce("_alone", none))
    sample = F.when(F.size(found) == 1, found[0]).otherwise("Undetermined")
    return joined.withColumn("sample", sample).drop("_first", "_alone", "_second")


def sample_sheet_join(reads: DataFrame, samples: DataFrame) -> DataFrame:
    """Attach the sheet's columns; a sheet sample without reads is a run-time error."""
    present = reads.select("sample").distinct().withColumn("_seen", F.lit(True))
    checked = samples.join(present, "sample", "left")
    absent = F.concat(F.lit("sample of the sheet has no data: "), F.col("sample"))
    checked = checked.withColumn("sample", fail_when(F.col("_seen").isNull(), absent, F.col("sample"))).drop("_seen")
    return join_small(reads, checked, "sample")
