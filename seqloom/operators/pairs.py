"""Overlapping mates: merging and adapter identification."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
import numpy as np

from ..functions import bases
from ..functions.staging import evaluate_once
from ..options import positive
from .reads import pairs_of


def _overlap(min_overlap: int, max_mismatch: float):
    """Pandas UDF: best shift of the turned mate 2 against mate 1, one vectorised pass per shift.

    The score is matches minus mismatches; ties go to the longer overlap, then the smaller shift.
    """

    def best_shift(one: pd.Series, two: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, la = bases.byte_matrix(one)
        b, lb = bases.byte_matrix(two)
        shift = np.zeros(len(one), np.int64)
        size = np.zeros(len(one), np.int64)
        wrong = np.zeros(len(one), np.int64)
        best = np.full(len(one), -1, np.int64)
        for d in range(-(b.shape[1] - min_overlap), a.shape[1] - min_overlap + 1):
            x = a[:, max(d, 0) :]
            y = b[:, max(-d, 0) :]
            w = min(x.shape[1], y.shape[1])
            same = ((x[:, :w] == y[:, :w]) & (x[:, :w] != 0)).sum(1)
            span = np.minimum(la, d + lb) - max(d, 0)
            miss = span - same
            ok = (span >= min_overlap) & (miss <= np.floor(max_mismatch * span + 1e-9))
            score = same - miss
            better = ok & ((score > best) | ((score == best) & (span > size)))
            best[better], shift[better] = score[better], d
            size[better], wrong[better] = span[better], miss[better]
        return shift, size, wrong

    @F.pandas_udf("struct<shift:int,size:int,mismatches:int>")
    def overlap(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for one, two in batches:
            out = np.zeros((len(one), 3), np.int64)
            for rows in bases.even_slices(np.maximum(bases.text_lengths(one), bases.text_lengths(two))):
                out[rows] = np.column_stack(best_shift(one.iloc[rows], two.iloc[rows]))
            yield pd.DataFrame(out, columns=["shift", "size", "mismatches"]).astype("int32")

    return overlap


def pair_overlaps(reads: DataFrame, *, min_overlap: int = 10, max_mismatch: float = 0.1) -> DataFrame:
    """Pairs with the best overlap of mate 1 and turned mate 2 (``size`` 0 for none)."""
    positive("min_overlap", min_overlap)
    pairs = pairs_of(reads).withColumns({"rc2": bases.reverse_complement("seq2"), "rq2": F.reverse("qual2")})
    # A filter on ``ov`` would run the search a second time, with Python workers of its own.
    return evaluate_once(pairs, ov=_overlap(min_overlap, max_mismatch)(F.col("seq1"), F.col("rc2")))


def merge_pairs(
    reads: DataFrame,
    *,
    min_overlap: int = 10,
    min_len: int = 50,
    max_len: int = 300,
    max_n_frac: float = 1.0,
    phred_cap: int = 40,
    base: int = 33,
    max_mismatch: float = 0.1,
) -> DataFrame:
    """One consensus read per overlapping pair, with ``status`` assembled, unassembled or discarded.

    In the overlap the base of higher quality wins and mate 1 wins ties; equal bases add their
    qualities up to ``phred_cap``. Read-through beyond the fragment end is cut.
    """
    p = pair_overlaps(reads, min_overlap=min_overlap, max_mismatch=max_mismatch)
    shift, size = F.col("ov.shift"), F.col("ov.size")
    at1 = F.greatest(shift, F.lit(0)) + 1
    at2 = F.greatest(-shift, F.lit(0)) + 1
    tail2 = at2 + size
    rows = F.arrays_zip(
        bases.letters(F.substr("seq1", at1, size)).alias("a"),
        bases.letters(F.substr("rc2", at2, size)).alias("b"),
        bases.scores(F.substr("qual1", at1, size), base=base).alias("p"),
        bases.scores(F.substr("rq2", at2, size), base=base).alias("q"),
    )
    calls = F.transform(
        rows,
        lambda r: F.struct(
            F.when(r["p"] >= r["q"], r["a"]).otherwise(r["b"]).alias("s"),
            F.char(
                F.lit(base)
                + F.when(r["a"] == r["b"], F.least(r["p"] + r["q"], F.lit(phred_cap))).otherwise(F.greatest(r["p"], r["q"]))
            ).alias("q"),
        ),
    )
    merged = p.withColumn("_calls", calls).withColumns(
        {
            "seq": F.concat(
                F.when(shift > 0, F.substr("seq1", F.lit(1), shift)).otherwise(""),
                F.array_join(F.transform("_calls", lambda c: c["s"]), ""),
                F.when(shift >= 0, F.substr("rc2", tail2)).otherwise(""),
            ),
            "qual": F.concat(
                F.when(shift > 0, F.substr("qual1", F.lit(1), shift)).otherwise(""),
                F.array_join(F.transform("_calls", lambda c: c["q"]), ""),
                F.when(shift >= 0, F.substr("rq2", tail2)).otherwise(""),
            ),
        }
    )
    n_frac = (F.length("seq") - F.length(F.regexp_replace("seq", "[Nn]", ""))) / F.length("seq")
    status = (
        F.when(size == 0, "unassembled")
        .when(~F.length("seq").between(min_len, max_len) | (n_frac > max_n_frac), "discarded")
        .otherwise("assembled")
    )
    return merged.withColumn("status", status).select(
        "sample", "read_idx", F.col("qname1").alias("qname"), "status",
        F.when(size > 0, F.col("seq")).alias("seq"), F.when(size > 0, F.col("qual")).alias("qual"),
        size.alias("overlap"), F.col("ov.mismatches").alias("mismatches"),
    )


def identify_adapters(reads: DataFrame, *, min_overlap: int = 11, max_mismatch: float = 0.1) -> DataFrame:
    """Consensus base per position beyond the fragment end, for each sample and mate.

    ``rank_n`` reads carry the winning base of ``total`` reads that reach the position.
    """
    p = pair_overlaps(reads, min_overlap=min_overlap, max_mismatch=max_mismatch).filter("ov.size > 0")
    insert = F.col("ov.shift") + F.length("rc2")
    tails = p.select(
        "sample",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("mate"), F.substr("seq1", insert + 1).alias("tail")),
                F.struct(F.lit(2).alias("mate"), F.substr("seq2", insert + 1).alias("tail")),
            )
        ).alias("t"),
    ).filter(F.length("t.tail") > 0)
    per_base = (
        tails.select("sample", "t.mate", F.posexplode(bases.letters(F.col("t.tail"))).alias("pos", "base"))
        .groupBy("sample", "mate", "pos", "base")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_base.groupBy("sample", "mate", "pos").agg(
        F.max_by("base", F.struct("n", "base")).alias("base"), F.max("n").alias("rank_n"), F.sum("n").alias("total")
    )
