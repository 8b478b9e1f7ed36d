"""Exact top-k by inner product with a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it. Rows sorted by that key are cut into
tiles, so a tile is an annulus around its pivot: all its rows lie between two distances. For a query q at
distance d from the pivot, the triangle inequality puts every row x of the annulus at least
``gap = max(0, d - outer, inner - d)`` away, and since ``2 q.x = |q|^2 + |x|^2 - |q - x|^2``, no row scores
above ``(|q|^2 + max |x|^2 - gap^2) / 2``. Queries are keyed and cut into blocks the same way. A block's
annuli are sorted by that bound and visited in rounds of growing number, until the bound of all that
are left is below the k-th score of every query of the block. Within a visited annulus, queries that it
cannot serve are left out by their own distance.

The result is exact. Pivots come from a bounded sample; distances are squared integers, so keys are exact,
and the bound, the only rounded number, is raised by more than its rounding.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import staged
from recsift.llm.vectors import as_matrix, inner, largest, scaled, slices

#: Rows, those with the smallest hashes of the id, from which pivots are fitted; every row is indexed.
SAMPLE = 20_000
PIVOTS = 64
#: Most rows of an annulus, and most queries of a block.
TILE, BLOCK = 1024, 256
#: Annuli that a block visits in its first round; each round visits so many times more than the one before.
FIRST, GROWTH = 4, 4
#: What a bound is raised by: a share of the squared lengths in it, far above the rounding of their roots, and one.
SLACK = 1e-12


class Index(NamedTuple):
    """``tiles``: (tile, pivot, inner, outer, top, ids, vectors); distances and top, the largest length, are squared."""

    tiles: DataFrame
    pivots: np.ndarray


def fit_pivots(rows: DataFrame, dims: int, pivots: int = PIVOTS, sample: int = SAMPLE, rounds: int = 8) -> np.ndarray:
    """At most ``pivots`` integer points: rounded means of clusters of at most ``sample`` rows."""
    few = rows.select("vec_id", "v", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id", "v").limit(sample)
    got = few.select("v").toArrow()["v"].combine_chunks()
    x = as_matrix(got, dims)
    if not len(x):
        return np.zeros((1, dims), np.int64)
    length, chosen = (x * x).sum(1), [0]
    far = length + length[0] - 2 * inner(x, x[:1])[:, 0]
    while len(chosen) < pivots and far.max() > 0:  # the farthest point from those chosen
        chosen.append(int(far.argmax()))
        far = np.minimum(far, length + length[chosen[-1]] - 2 * inner(x, x[chosen[-1:]])[:, 0])
    centre = x[chosen]
    for _ in range(rounds):
        own = distances(x, centre).argmin(1)
        size = np.bincount(own, minlength=len(centre))
        total = np.zeros(centre.shape)
        np.add.at(total, own, x)
        centre = np.where(size[:, None] > 0, np.rint(total / np.maximum(size, 1)[:, None]), centre).astype(np.int64)
    return np.unique(centre, axis=0)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Squared distances of all rows from all pivots, exact."""
    return (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * inner(x, pivots)


def keyed(rows: DataFrame, pivots: np.ndarray, **names: str) -> DataFrame:
    """``(vec_id, v, pivot, far)`` of all ``rows (vec_id, v)``: the nearest pivot, the first of several, and its squared distance."""
    dims = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = distances(as_matrix(b.column("v"), dims), pivots)
            near = d.argmin(1)
            yield pa.record_batch([b.column("vec_id"), b.column("v"), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])], names=["vec_id", "v", "pivot", "far"])

    return rows.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<int>, pivot int, far long")


def cut(rows: DataFrame, dims: int, size: int, count: int, pure: bool = True) -> DataFrame:
    """Tiles of at most ``size`` rows of ``keyed`` rows, ``count`` in all, which lie side by side in the order of their keys.

    A ``pure`` tile has one pivot. Ranges that lie side by side are read by one task while they are few tiles.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = TaskContext.get().partitionId() << 32
        for b in batches:
            x, far, pivot, ids = as_matrix(b.column("v"), dims), b.column("far").to_numpy(), b.column("pivot").to_numpy(), b.column("vec_id")
            for lo, hi in slices(pivot if pure else np.zeros(len(pivot)), size):
                part = x[lo:hi]
                yield pa.record_batch([pa.array([v], t) for v, t in (
                    (tile, pa.int64()), (pivot[lo], pa.int32()), (far[lo], pa.int64()), (far[hi - 1], pa.int64()), ((part * part).sum(1).max(), pa.int64()),
                    (ids[lo:hi].to_numpy().tobytes(), pa.binary()), (part.astype(np.int32).tobytes(), pa.binary()))], names=["tile", "pivot", "inner", "outer", "top", "ids", "vectors"])
                tile += 1

    order = ["pivot", "far", "vec_id", "v"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).coalesce(1 + count // (8 * size)).mapInArrow(run, "tile long, pivot int, inner long, outer long, top long, ids binary, vectors binary")


def build_index(rows: DataFrame, dims: int, pivots: int = PIVOTS, sample: int = SAMPLE, tile: int = TILE) -> Index:
    """The index of all ``rows (vec_id, v)``, whose longest vector has ``dims`` components; its tiles are stored."""
    points = fit_pivots(rows, dims, pivots, sample)
    return Index(staged(cut(keyed(rows, points), dims, tile, rows.count()), "annuli"), points)


def bound(low: Column, high: Column, length: Column) -> Column:
    """The most that a query between the squared distances ``low`` and ``high`` from the pivot scores in an annulus."""
    gap = F.greatest(F.lit(0.0), F.sqrt(low) - F.sqrt("outer"), F.sqrt("inner") - F.sqrt(high))
    return (length + F.col("top") - gap * gap) / 2 + (length + F.col("top") + F.col("outer") + high) * SLACK + 1.0


def _visits(queries: DataFrame, index: Index, dims: int) -> DataFrame:
    """``(block, tile, bound, place)``: for every block of queries all annuli, the most promising first.

    Blocks and annuli meet by pivot; every block has one row a pivot, with the least and largest distance of
    its queries. A pivot's rows are dealt over several keys, so that a hot pivot is several tasks.
    """
    points, salts = index.pivots, 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, raw in zip(b.column("block").to_pylist(), b.column("vectors")):
                x = np.frombuffer(raw.as_py(), np.int32).reshape(-1, dims).astype(np.int64)
                d = distances(x, points)
                yield pa.record_batch([pa.array(np.full(len(points), block)), pa.array(np.arange(len(points), dtype=np.int32)), pa.array(d.min(0)), pa.array(d.max(0)),
                                       pa.array(np.full(len(points), (x * x).sum(1).max()))], names=["block", "pivot", "low", "high", "length"])

    ranges = queries.select("block", "vectors").mapInArrow(run, "block long, pivot int, low long, high long, length long").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rings = index.tiles.select("tile", "pivot", "inner", "outer", "top", F.pmod(F.xxhash64("tile"), F.lit(salts)).cast("int").alias("salt"))
    met = ranges.join(rings, ["pivot", "salt"]).select("block", "tile", bound(F.col("low"), F.col("high"), F.col("length")).alias("bound"))
    return met.withColumn("place", F.row_number().over(Window.partitionBy("block").orderBy(F.desc("bound"), "tile")))


def _scored(cells: DataFrame, points: np.ndarray, k: int) -> DataFrame:
    """``(block, query, score, vec_id)``: of each cell, a block and an annulus, the k best rows of each query that can be among the best."""
    dims = points.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in b.to_pylist():
                q, x = (np.frombuffer(c[n], np.int32).reshape(-1, dims).astype(np.int64) for n in ("q_vectors", "vectors"))
                q_ids, ids = (np.frombuffer(c[n], np.int64) for n in ("q_ids", "ids"))
                least = np.full(len(q), np.iinfo(np.int64).min)
                for s in c["least"] or ():
                    least[s["query"]] = s["score"]
                length, d = (q * q).sum(1), distances(q, points[c["pivot"]:c["pivot"] + 1])[:, 0]
                gap = np.maximum(0, np.maximum(np.sqrt(d) - np.sqrt(c["outer"]), np.sqrt(c["inner"]) - np.sqrt(d)))
                use = np.flatnonzero((length + c["top"] - gap * gap) / 2 + (length + c["top"] + c["outer"] + d) * SLACK + 1 >= least)
                if not len(use):
                    continue
                scores = inner(q[use], x)
                for row, at in zip(*np.nonzero(q_ids[use][:, None] == ids)):
                    if (q[use[row]] == x[at]).all():
                        scores[row, at] = np.iinfo(np.int64).min  # the query's own row
                row, score, own = largest(scores, ids, k, least[use])
                yield pa.record_batch([pa.array(np.full(len(row), c["block"])), pa.array(use[row].astype(np.int32)), pa.array(score), pa.array(own)], names=["block", "query", "score", "vec_id"])

    return cells.mapInArrow(run, "block long, query int, score long, vec_id long")


def search(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding", pivots: int = PIVOTS,
           sample: int = SAMPLE, tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``rows`` where ``is_query``, the ``k`` other rows with the largest inner products.

    Components become floor(scale * x). All, if there are fewer than k; ties to the smaller id. ``is_query`` is
    a condition on ``vec_id``. Ids are integers. Rows with a null id or vector or a null or non-finite
    component take no part; rows alike in id and components are one row; of rows that share an id each is
    a query, and a candidate for the others. Shorter vectors count as filled up with zeros, and scaled
    components are held within 2 ** 23. An empty table gives no rows. Other columns are ignored.

    Every row is scored against every query whose bound it may reach; where vectors lie at nearly equal
    distances, as random ones of many dimensions do, that is nearly all. A block's annuli are listed in
    rows of a few numbers; vectors move once a round to the cells that need them.
    """
    whole = staged(scaled(rows, scale, id_col, vec_col), "vectors")
    dims = whole.agg(F.max(F.size("v"))).first()[0] or 1
    index = build_index(whole, dims, pivots, sample, tile)
    asked = whole.where(is_query)
    queries = staged(cut(keyed(asked, index.pivots), dims, block, asked.count(), pure=False).select(
        F.col("tile").alias("block"), F.col("ids").alias("q_ids"), "vectors"), "queries")
    visits = staged(_visits(queries, index, dims), "visits")
    own = Window.partitionBy("block", "query").orderBy(F.desc("score"), "vec_id")
    best, done, more = None, 0, FIRST
    while True:
        left = visits.where(F.col("place") > done)
        if best is None:
            limits = queries.select("block", F.lit(None).cast("array<struct<query:int,score:long>>").alias("least"), F.lit(None).cast("double").alias("lowest"))
        else:  # at most as many numbers a block as it has queries
            full = best.where(F.col("place") == k).groupBy("block").agg(F.collect_list(F.struct("query", "score")).alias("least"), F.min("score").alias("low"))
            counted = queries.select("block", (F.octet_length("q_ids") / 8).cast("int").alias("n"))
            limits = counted.join(full, "block", "left").select("block", "least", F.when(F.size("least") == F.col("n"), F.col("low")).cast("double").alias("lowest"))
        left = left.join(limits, "block").where(F.col("lowest").isNull() | (F.col("bound") >= F.col("lowest")))
        if best is not None and left.isEmpty():
            break
        cells = left.where(F.col("place") <= done + more).select("block", "tile", "least")
        cells = cells.join(queries.withColumnRenamed("vectors", "q_vectors"), "block").join(index.tiles, "tile")
        found = _scored(cells, index.pivots, k)
        if best is not None:
            found = found.unionByName(best.drop("place"))
        best = staged(found.withColumn("place", F.row_number().over(own)).where(F.col("place") <= k), "best")
        done, more = done + more, more * GROWTH
    named = queries.select("block", "q_ids").mapInArrow(_named, "block long, query int, query_id long")
    return best.join(named, ["block", "query"]).select("query_id", F.col("place").cast("int").alias("rank"), "vec_id", "score")


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, raw in zip(b.column("block").to_pylist(), b.column("q_ids")):
            ids = np.frombuffer(raw.as_py(), np.int64)
            yield pa.record_batch([pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], names=["block", "query", "query_id"])
