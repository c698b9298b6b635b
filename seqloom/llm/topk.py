"""Exact top-k inner products by a pivot-distance index."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch, bounded_batches
from .vectors import Batches, matrix, packed, unpack, usable, width

PIVOTS = 32
#: Annuli of equal width around each pivot; with the pivots they bound the table of cells.
ANNULI = 16
#: Vectors of one block of an annulus.
BLOCK = 1024
SCALE = 256


def _distances(rows: np.ndarray, squares: np.ndarray, pivots: np.ndarray, pivot_squares: np.ndarray, top: float, lifted: bool) -> np.ndarray:
    """Distances to the pivots after the lift that makes inner products distances: data get a last component
    sqrt(top - square), queries get zero."""
    last = np.sqrt(np.maximum(top - squares, 0)) if lifted else np.zeros(len(rows))
    lift = np.sqrt(np.maximum(top - pivot_squares, 0))
    d = (squares + last**2)[:, None] + top - 2 * (rows @ pivots.T + last[:, None] * lift[None])
    return np.sqrt(np.maximum(d, 0))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of each row's k best: highest score, ties to the smaller id."""
    if scores.shape[1] <= k:
        return np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)
    by_id = np.argsort(ids, kind="stable")
    return by_id[np.argsort(-scores[:, by_id], axis=1, kind="stable")[:, :k]]


def top_k(vectors: DataFrame, queries: Column, *, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of ``vectors(vec_id, embedding)``: the best ``k`` of all other vectors for each row that fulfils ``queries``.

    Components count as ``floor(256 * x)``; the score is the integer inner product, ties go to the smaller vec_id; fewer candidates give fewer rows.
    Vectors that are null, empty or hold null or non-finite components, and rows with a null vec_id, take no part; a shorter vector counts as if filled up
    with zeros; rows that share a vec_id are one vector with the better score. Exact while scores stay within 63 bits. Other columns are ignored.

    1. Pivots are vectors drawn by a hash of the id. After a lift that turns inner products into distances, every vector is keyed by its nearest
       pivot and the distance to it, and sorted into annuli, cut into blocks; many equal vectors are just many blocks.
    2. A query's own block gives a first k-th score. By the triangle inequality only annuli that come near enough can hold a better vector;
       the query expands to those, nearest first by score bound, and each block stops where even its nearest point cannot reach the score.
    3. The best of the blocks are ranked by query. Queries travel to blocks, never blocks to queries.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    whole = F.transform("embedding", lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    given = vectors.withColumn("__query", F.coalesce(queries, F.lit(False))).filter(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    given = given.select(F.col("vec_id").cast("bigint"), whole.alias("v"), "__query")
    n = width(given, "v")
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    top = given.agg(F.max(square)).first()[0] or 0.0
    drawn = given.select("vec_id", "v").orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id").limit(pivots).collect()
    if not drawn:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    chosen = np.unique(np.array([list(r["v"]) + [0] * (n - len(r["v"])) for r in drawn], np.float64), axis=0)
    chosen_squares = (chosen**2).sum(axis=1)
    exact_in_double = top < 2.0**53
    wide = 2 * np.sqrt(top) / ANNULI or 1.0  # no distance after the lift exceeds twice the longest vector
    slack = 1e-9 * max(top, 1.0)

    def key(batches: Batches) -> Batches:
        for batch in batches:
            rows = matrix(batch.column(1), n, np.int64)
            d = _distances(rows.astype(np.float64), (rows.astype(np.float64) ** 2).sum(axis=1), chosen, chosen_squares, top, True)
            near = d.argmin(axis=1) if len(rows) else np.zeros(0, np.int64)
            own = d[np.arange(len(rows)), near]
            columns = [batch.column(0), batch.column(2), pa.array(near.astype(np.int32)), pa.array((own / wide).astype(np.int32)), pa.array(own), packed(rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "query", "pivot", "annulus", "distance", "v"])

    keyed = given.select("vec_id", "v", "__query").mapInArrow(key, "vec_id bigint, query boolean, pivot int, annulus int, distance double, v binary")

    def cut(batches: Batches) -> Batches:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            pivot, annulus = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            edges = np.flatnonzero(np.diff(pivot, prepend=-1) | np.diff(annulus, prepend=-1))
            for low, high in zip(edges, [*edges[1:], len(pivot)], strict=True):
                for i in range(low, high, BLOCK):
                    own = batch.slice(i, min(BLOCK, high - i))
                    d = own.column(4).to_numpy()
                    columns = [
                        pa.array([part << 32 | number]), pa.array([int(pivot[low])], pa.int32()), pa.array([int(annulus[low])], pa.int32()), pa.array([float(d.min())]), pa.array([float(d.max())]),
                        pa.array([own.column(0).to_numpy().tobytes()]), pa.array([own.column(1).to_numpy(zero_copy_only=False).tobytes()]), pa.array([b"".join(own.column(5).to_pylist())]),
                    ]
                    number += 1
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "pivot", "annulus", "low", "high", "ids", "queries", "vs"])

    ordered = keyed.repartitionByRange("pivot", "annulus", "distance", "vec_id").sortWithinPartitions("pivot", "annulus", "distance", "vec_id")
    index = scratch.keep(ordered.mapInArrow(cut, "block bigint, pivot int, annulus int, low double, high double, ids binary, queries binary, vs binary"), "index")
    # At most pivots * annuli rows.
    cells = index.groupBy("pivot", "annulus").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()

    def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64) if exact_in_double else a @ b.T

    def expand(batches: Batches) -> Batches:
        c_pivot, low, high = cells["pivot"].to_numpy(), cells["low"].to_numpy(), cells["high"].to_numpy()
        for batch in batches:
            for i in range(batch.num_rows):
                ids, asks = np.frombuffer(batch.column(5)[i].as_py(), np.int64), np.frombuffer(batch.column(6)[i].as_py(), bool)
                if not asks.any():
                    continue
                rows = np.frombuffer(batch.column(7)[i].as_py(), np.int64).reshape(-1, n)
                own = rows[asks].astype(np.float64)
                squares = (own**2).sum(axis=1)
                scores = products(rows[asks], rows).astype(np.float64)
                scores[ids[asks][:, None] == ids[None]] = -np.inf
                # Rows of one id are one vector: only the best of them may count towards the k-th score.
                alone = np.unique(ids, return_index=True)[1] if len(np.unique(ids)) < len(ids) else slice(None)
                scores = scores[:, alone]
                first = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] >= k else np.full(len(scores), -np.inf)
                d = _distances(own, squares, chosen, chosen_squares, top, False)[:, c_pivot]
                gap = np.maximum(np.maximum(d - high, low - d), 0)
                reach = (top + squares[:, None] - gap**2) / 2
                q, cell = np.nonzero(reach >= first[:, None] - slack)
                by = np.lexsort((-reach[q, cell], q))
                q, cell = q[by], cell[by]
                at = pa.array(np.flatnonzero(asks)[q])
                columns = [
                    pa.array(c_pivot[cell]), pa.array(cells["annulus"].to_numpy()[cell]), pa.array(ids).take(at), pa.array(first[q]), packed(rows).take(at),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["pivot", "annulus", "query_id", "first", "q"])

    asked = index.mapInArrow(expand, "pivot int, annulus int, query_id bigint, first double, q binary")
    requests = asked.join(index.select("pivot", "annulus", "block"), ["pivot", "annulus"]).select("block", F.lit(1).alias("kind"), "query_id", "first", "q", F.lit(None).cast("binary").alias("ids"), F.lit(0.0).alias("low"), F.lit(0.0).alias("high"), "pivot")
    data = index.select("block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("query_id"), F.lit(None).cast("double").alias("first"), F.col("vs").alias("q"), "ids", "low", "high", "pivot")

    def search(batches: Batches) -> Batches:
        block, ids, rows, starts, low, high, pivot = None, None, None, None, 0.0, 0.0, 0
        for batch in batches:
            kinds, blocks = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            i = 0
            while i < len(kinds):
                if kinds[i] == 0:
                    block, low, high, pivot = blocks[i], batch.column(6)[i].as_py(), batch.column(7)[i].as_py(), batch.column(8)[i].as_py()
                    ids, rows = np.frombuffer(batch.column(5)[i].as_py(), np.int64), np.frombuffer(batch.column(4)[i].as_py(), np.int64).reshape(-1, n)
                    # Rows of one id lie together and are merged before the best are taken: copies must not fill the cut.
                    by_id = np.argsort(ids, kind="stable")
                    alone, starts = np.unique(ids[by_id], return_index=True)
                    ids, rows, starts = (alone, rows[by_id], starts) if len(alone) < len(ids) else (ids, rows, None)
                    i += 1
                    continue
                j = i + 1
                while j < len(kinds) and kinds[j] == 1 and blocks[j] == blocks[i] and j - i < 512:
                    j += 1
                assert blocks[i] == block
                asker, first = batch.column(2).slice(i, j - i).to_numpy(), batch.column(3).slice(i, j - i).to_numpy()
                q = unpack(batch.column(4).slice(i, j - i), n, np.int64)
                i = j
                own = q.astype(np.float64)
                squares = (own**2).sum(axis=1)
                d = _distances(own, squares, chosen[pivot : pivot + 1], chosen_squares[pivot : pivot + 1], top, False)[:, 0]
                gap = np.maximum(np.maximum(d - high, low - d), 0)
                live = np.flatnonzero((top + squares - gap**2) / 2 >= first - slack)
                if not len(live):
                    continue
                scores = products(q[live], rows)
                if starts is not None:
                    scores = np.maximum.reduceat(scores, starts, axis=1)
                other = asker[live][:, None] != ids[None]
                low_score = np.int64(np.iinfo(np.int64).min)
                best = _best(np.where(other, scores, low_score).astype(np.float64) if exact_in_double else np.where(other, scores, low_score + 1), ids, k + 1)
                r = np.repeat(np.arange(len(live)), best.shape[1])
                c = best.reshape(-1)
                fine = other[r, c] & (scores[r, c] >= first[live][r])
                yield pa.RecordBatch.from_arrays([pa.array(asker[live][r[fine]]), pa.array(ids[c[fine]]), pa.array(scores[r, c][fine])], names=["query_id", "vec_id", "score"])

    both = requests.unionByName(data).repartition("block").sortWithinPartitions("block", "kind")
    found = both.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
