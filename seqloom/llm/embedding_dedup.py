"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within cells, one representative of each group."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import blocks
from .components import components
from .scratch import Scratch, bounded_batches
from .vectors import Batches, matrix, packed, unpack, usable, width

#: Vectors that the cells are fitted on at most, drawn by a hash; all vectors are then dealt to the cells.
SAMPLE = 8192
#: Different vectors meant for one cell, and the most cells.
CELL, CELLS = 400, 1024
#: A vector also visits the cells whose centre is this much less similar than its nearest one at most.
#: With 128 cells over 64 components this misses less than one of a thousand pairs with a cosine of just 0.9.
MARGIN = 0.15
BLOCK = 2048


def spherical_kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of unit rows; the start is spread evenly over the rows, an empty centre takes the row served worst."""
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = rows @ centres.T
        own = near.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, rows)
        length = np.linalg.norm(sums, axis=1)
        empty = np.flatnonzero(length == 0)
        if len(empty):
            sums[empty] = rows[np.argsort(near[np.arange(len(rows)), own], kind="stable")[: len(empty)]]
            length = np.linalg.norm(sums, axis=1)
        centres = sums / np.where(length == 0, 1, length)[:, None]
    return centres


def _unit(rows: np.ndarray) -> np.ndarray:
    biggest = np.abs(rows).max(axis=1, keepdims=True)
    scaled = rows / np.where(biggest == 0, 1, biggest)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, *, cosine: float = 0.9, margin: float = MARGIN) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors(vec_id, embedding)``; other columns are ignored.

    Rows link when their cosine in double precision is ``cosine`` or more. Vectors that are null, empty, zero or hold null or non-finite
    components link with nothing; a shorter vector counts as if filled up with zeros. ``n_links`` counts the other rows linked with, ``component_id`` is
    the smallest vec_id reachable, ``kept`` marks it. A row with a null vec_id links with nothing and has null results. Rows that share a vec_id with equal vectors
    are links of each other; with different ones the counts of both are added, as ids name components.

    1. Equal vectors are one representative with a count; a vector that a third of all rows repeat is compared once.
    2. Spherical k-means on a bounded sample gives cells. Every representative lives in its nearest cell and visits those nearly as near,
       so pairs at the borders are found too (recall is measured in the tests).
    3. In each cell, block against block, products find the links of residents with residents and visitors; a pair that
       meets in two cells counts in the first. A task returns sums by vector and a spanning set of links, not the pairs.
    4. Components over links and copies.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    nonzero = F.exists("embedding", lambda x: x != 0)
    fine = F.col("vec_id").isNotNull() & usable(F.col("embedding")) & nonzero
    given = vectors.filter(fine).select(F.col("vec_id").cast("bigint"), F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("v"))
    n = width(given, "v")
    # Single precision holds what single precision gave; all arithmetic is in double.
    kind = "<f4" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"

    def pack(batches: Batches) -> Batches:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), packed((matrix(batch.column(1), n) + 0.0).astype(kind))], names=["vec_id", "v"])

    rows = scratch.keep(given.mapInArrow(pack, "vec_id bigint, v binary"), "rows")
    reps = scratch.keep(rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "reps")
    count = reps.count()
    sample = reps.orderBy(F.xxhash64("v")).select("v").limit(SAMPLE).collect()
    if not sample:
        return vectors.select(F.col("vec_id").cast("bigint"), F.when(F.col("vec_id").isNotNull(), F.lit(0).cast("bigint")).alias("n_links"), F.col("vec_id").cast("bigint").alias("component_id"), (F.col("vec_id") == F.col("vec_id")).alias("kept"))
    fitted = _unit(np.frombuffer(b"".join(r["v"] for r in sample), kind).astype(np.float64).reshape(-1, n))
    centres = spherical_kmeans(fitted, max(1, min(CELLS, count // CELL, len(fitted))))

    def deal(batches: Batches) -> Batches:
        for batch in batches:
            near = _unit(unpack(batch.column(0), n, kind).astype(np.float64)) @ centres.T
            home = near.argmax(axis=1)
            row, cell = np.nonzero(near >= near[np.arange(len(home)), home][:, None] - margin)
            visits = pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(len(home) + 1)).astype(np.int32)), pa.array(cell.astype(np.int32)))
            for i in range(0, len(row), 2000):
                at = pa.array(row[i : i + 2000])
                columns = [pa.array(cell[i : i + 2000].astype(np.int32)), pa.array(home[row[i : i + 2000]].astype(np.int32)), *(c.take(at) for c in (batch.column(1), batch.column(2), visits, batch.column(0)))]
                yield pa.RecordBatch.from_arrays(columns, names=["cell", "home", "rep", "copies", "visits", "v"])

    dealt = reps.select("v", "rep", "copies").mapInArrow(deal, "cell int, home int, rep bigint, copies bigint, visits array<int>, v binary")
    lives = F.col("home") == F.col("cell")
    # At most CELLS rows. Residents meet residents and visitors; visitors do not meet.
    sizes = dealt.groupBy("cell").agg(F.ceil(F.count_if(lives) / BLOCK).cast("int").alias("mine"), F.ceil(F.count_if(~lives) / BLOCK).cast("int").alias("guests"))
    placed = dealt.join(F.broadcast(sizes.filter("mine > 0")), "cell")
    hashed = F.xxhash64("v", F.lit("block"))
    own = F.when(lives, F.pmod(hashed, F.col("mine"))).otherwise(F.col("mine") + F.pmod(hashed, F.col("guests"))).cast("int")
    others = F.sequence(F.lit(0), F.when(lives, F.col("mine") + F.col("guests")).otherwise(F.col("mine")) - 1)
    cut = placed.withColumn("own", own).withColumn("other", F.explode(others)).withColumns({"left": F.least("own", "other"), "right": F.greatest("own", "other")})
    cut = cut.drop("other", "mine", "guests")

    def compare(table: pa.Table) -> pa.RecordBatch | None:
        cell, left, right = (table[c][0].as_py() for c in ("cell", "left", "right"))
        own, home, rep, copies = (table[c].to_numpy() for c in ("own", "home", "rep", "copies"))
        unit = _unit(unpack(table["v"], n, kind).astype(np.float64))
        x, y = np.flatnonzero(own == left), np.flatnonzero(own == right)
        links, forest, edges = np.zeros(len(rep), np.int64), blocks.Forest(len(rep)), []
        visits = table["visits"].combine_chunks()
        for s in range(0, len(x), 512):
            part = x[s : s + 512]
            i, j = np.nonzero(unit[part] @ unit[y].T >= cosine - 1e-12)
            i, j = part[i], y[j]
            once = i < j if left == right else np.ones(len(i), bool)
            settled = once & ((home[i] == cell) | (home[j] == cell))
            i, j = i[settled], j[settled]
            both = (home[i] == cell) & (home[j] == cell)
            guest, host = np.where(home[i] == cell, j, i), np.where(home[i] == cell, i, j)
            for t in np.flatnonzero(~both):
                # The host may visit the guest's home as well; then the pair counts in the cell with the smaller number.
                if home[guest[t]] < cell and home[guest[t]] in visits[int(host[t])].as_py():
                    continue
                both[t] = True
            i, j = i[both], j[both]
            true = np.einsum("ij,ij->i", unit[i], unit[j]) >= cosine
            i, j = i[true], j[true]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            open_ = forest.label[i] != forest.label[j]
            for a, b in zip(i[open_], j[open_], strict=True):
                if forest.label[a] != forest.label[b]:
                    forest.union(a, b)
                    edges.append((int(rep[a]), int(rep[b])))
        some = np.flatnonzero(links)
        blobs = table["v"].combine_chunks().take(pa.array(some))
        a, b = zip(*edges, strict=True) if edges else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([blobs, pa.nulls(len(a), pa.binary())]), pa.array([*links[some].tolist(), *[0] * len(a)], pa.int64()), pa.array([None] * len(some) + list(a), pa.int64()), pa.array([None] * len(some) + list(b), pa.int64())],
            names=["v", "links", "a", "b"],
        )

    found = scratch.keep(blocks.by_runs(cut, ["cell", "left", "right"], compare, "v binary, links bigint, a bigint, b bigint"), "found")
    sums = found.filter("v is not null").groupBy("v").agg(F.sum("links").alias("links"))
    known = reps.join(sums, "v", "left").select("v", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    placed = scratch.keep(rows.join(known, "v").select("vec_id", "rep", "links"), "placed")
    linked = components(found.filter("a is not null").select("a", "b").unionByName(placed.filter("vec_id <> rep").select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))), scratch)
    per_id = placed.groupBy("vec_id").agg(F.max("links").alias("links")).join(linked, F.col("vec_id") == F.col("node"), "left").select(F.col("vec_id").alias("id"), "links", "component")
    joined = vectors.select(F.col("vec_id").cast("bigint")).join(per_id, F.col("vec_id") == F.col("id"), "left")
    number = F.when(F.col("vec_id").isNotNull(), F.coalesce("links", F.lit(0).cast("bigint")))
    result = joined.select("vec_id", number.alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return result.withColumn("kept", F.col("vec_id") == F.col("component_id"))
