"""Groups cut into blocks, and runs of rows of one key streamed to a function: no group need fit one task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def block_pairs(members: DataFrame, group: str, member: str, size: str, block: int) -> DataFrame:
    """Each row once for every pair of blocks that holds its block: adds ``own, left, right``.

    ``size`` is the column with the rows of the group. A group of up to ``block`` rows is one block; larger ones are dealt to
    blocks of about that many rows by a hash of ``member``, so any two rows of a group meet in exactly one pair of blocks.
    """
    n = F.ceil(F.col(size) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(member, F.lit("block")), n).cast("int")
    other = F.explode(F.sequence(F.lit(0), n - 1))
    dealt = members.withColumn("own", own).withColumn("other", other)
    return dealt.withColumn("left", F.least("own", "other")).withColumn("right", F.greatest("own", "other")).drop("other")


def by_runs(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Apply ``fn`` to all rows of each key, streamed; the rows of one key must fit a task's memory."""
    names = df.columns

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current: tuple | None = None

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                out = fn(pa.Table.from_batches(held))
                held.clear()
                if out is not None and out.num_rows:
                    yield out

        for batch in batches:
            marks = list(zip(*(batch.column(names.index(k)).to_pylist() for k in keys), strict=True))
            begin = 0
            for i, mark in enumerate(marks):
                if mark != current:
                    if i > begin:
                        held.append(batch.slice(begin, i - begin))
                    yield from flush()
                    current, begin = mark, i
            if len(marks) > begin:
                held.append(batch.slice(begin))
        yield from flush()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(task, schema)


class Forest:
    """Disjoint sets over 0..n-1 with labels kept flat, for vectorised tests."""

    def __init__(self, n: int):
        import numpy as np

        self.label = np.arange(n)

    def union(self, x: int, y: int) -> None:
        a, b = sorted((self.label[x], self.label[y]))
        self.label[self.label == b] = a
