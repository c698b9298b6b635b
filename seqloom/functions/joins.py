"""Joins with a side of few rows whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Rows of a small side that are taken to the driver and broadcast at most.
SMALL_ROWS = 20_000


def join_small(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "inner", *, limit: int = SMALL_ROWS) -> DataFrame:
    """Join with a side that has, as a rule, one row per sample, file or barcode, without shuffling ``big``.

    One job fetches up to ``limit`` + 1 rows of it. Up to ``limit`` rows are broadcast; a larger side is joined by
    shuffle. The result is the same either way.
    """
    on = [on] if isinstance(on, str) else list(on)
    rows = small.limit(limit + 1).collect()
    if len(rows) > limit:
        return big.join(small, on, how)
    return big.join(F.broadcast(small.sparkSession.createDataFrame(rows, small.schema)), on, how)
