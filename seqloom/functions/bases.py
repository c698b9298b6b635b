"""Base and quality string expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .staging import evaluate_once


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def reverse_complement(seq: Column | str = "seq") -> Column:
    return F.reverse(F.translate(_col(seq), "ACGTNacgtn", "TGCANtgcan"))


def byte_matrix(texts: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Strings of a batch as a zero-padded byte matrix with their lengths."""
    lengths = text_lengths(texts)
    width = int(lengths.max()) if len(lengths) else 0
    if width == 0:
        return np.zeros((len(texts), 0), np.uint8), lengths
    flat = texts.fillna("").to_numpy().astype(f"S{width}")
    return flat.view(np.uint8).reshape(len(texts), width), lengths


def even_slices(lengths: np.ndarray, *, cells: int = 1 << 22) -> Iterator[np.ndarray]:
    """Row numbers of a batch in groups of similar length whose byte matrix stays below ``cells`` (or one row)."""
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        stop = at + 1
        while stop < len(order) and (stop - at + 1) * int(lengths[order[stop]]) <= cells:
            stop += 1
        yield order[at:stop]
        at = stop


def text_lengths(texts: pd.Series) -> np.ndarray:
    return texts.str.len().fillna(0).to_numpy(dtype=np.int64)


def sum_of_good_scores(qual: Column, *, floor: int = 15, base: int = 33) -> Column:
    """Sum of the base qualities of at least ``floor``, one vectorised pass per Arrow batch."""

    @F.pandas_udf(T.LongType())
    def total(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = np.zeros(len(batch), np.int64)
            for rows in even_slices(text_lengths(batch)):
                q = byte_matrix(batch.iloc[rows])[0].astype(np.int64) - base
                out[rows] = np.where(q >= floor, q, 0).sum(1)
            yield pd.Series(out)

    return total(qual)


def letters(text: Column | str) -> Column:
    """String to array of characters; the empty string gives an empty array."""
    c = _col(text)
    return F.when(F.length(c) == 0, F.array().cast("array<string>")).otherwise(F.split(c, ""))


def scores(qual: Column | str = "qual", *, base: int = 33) -> Column:
    return F.transform(letters(qual), lambda q: F.ascii(q) - F.lit(base))


def mismatches(a: Column, b: Column, *, any_base: str = "") -> Column:
    """Hamming distance of equally long strings; letters of ``any_base`` match everything."""
    pairs = F.arrays_zip(letters(a).alias("x"), letters(b).alias("y"))

    def differs(p: Column) -> Column:
        bad = p["x"] != p["y"]
        if any_base:
            bad = bad & ~p["x"].isin(*any_base) & ~p["y"].isin(*any_base)
        return bad

    return F.size(F.filter(pairs, differs))


def keep_span(df: DataFrame, first: Column, length: Column, *, costly: bool = False) -> DataFrame:
    """Cut ``seq`` and ``qual`` to ``length`` characters from 1-based ``first``; ``costly`` bounds are evaluated once."""
    bounds = {"_first": first.cast("int"), "_len": F.greatest(length.cast("int"), F.lit(0))}
    df = evaluate_once(df, **bounds) if costly else df.withColumns(bounds)
    cut = {c: F.substr(F.col(c), F.col("_first"), F.col("_len")) for c in ("seq", "qual") if c in df.columns}
    return df.withColumns(cut).drop("_first", "_len")
