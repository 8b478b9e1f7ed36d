"""Hard-negative mining with Four-Russians scoring.

Vectors are integers. A candidate is stored by bit planes: plane i holds bit i of every component (two's
complement), eight components to a byte. An anchor has a table for each group of eight components: the sum
of every subset of them, 256 entries. The inner product of an anchor and one plane of a candidate is then
one lookup per byte, and the full product is the planes' sums shifted by their place and added, the top
plane with a minus; it is exact. Tables of an anchor block lie side by side, so a lookup serves all its
anchors at once.

Anchors are cut into blocks and candidates into tiles, each of a single label. Blocks meet the tiles of
their label for the positives, and all other tiles for the negatives, so every pair is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import staged
from recsift.llm.vectors import as_matrix, largest, scaled, slices

#: Most candidates of a tile, and most anchors of a block.
TILE, BLOCK = 4096, 64
#: Bit sets of a byte: row m has a 1 for each bit of m.
SUBSETS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def planes_needed(low: int, high: int) -> int:
    """Bits of two's complement that hold all numbers from ``low`` to ``high``."""
    return max(int(high).bit_length(), int(-low - 1).bit_length() if low < 0 else 0) + 1


def packed(x: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes (planes, groups, rows) of the rows of ``x``, a byte for eight components."""
    wide = np.zeros((len(x), -(-x.shape[1] // 8) * 8), np.int64)
    wide[:, :x.shape[1]] = x
    return np.stack([np.packbits((wide >> i & 1).astype(np.uint8), axis=1, bitorder="little").T for i in range(planes)]) if len(x) else np.zeros((planes, wide.shape[1] // 8, 0), np.uint8)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Tables (groups, 256, anchors): sums of all subsets of each group of eight components."""
    wide = np.zeros((len(anchors), -(-anchors.shape[1] // 8) * 8), np.int64)
    wide[:, :anchors.shape[1]] = anchors
    return np.stack([SUBSETS @ wide[:, g:g + 8].T for g in range(0, wide.shape[1], 8)])


def four_russians(tables: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
    """Inner products (rows, anchors) of candidates' bit planes and anchors' subset sums."""
    planes, _, n = bytes_.shape
    most = np.abs(tables).max(axis=1).sum(0).max(initial=0) * 2.0**planes
    tables = np.ascontiguousarray(tables.astype(np.int32 if most < 2.0**31 else np.int64))
    total, seen = np.zeros((n, tables.shape[2]), tables.dtype), np.empty((n, tables.shape[2]), tables.dtype)
    for i in range(planes - 1, -1, -1):
        total += total
        for table, byte in zip(tables, bytes_[i]):
            np.take(table, byte, axis=0, out=seen)
            if i == planes - 1:
                total -= seen
            else:
                total += seen
    return total.astype(np.int64)


def _cut(rows: DataFrame, dims: int, size: int, planes: int | None) -> DataFrame:
    """``(part, k, label, ids, vectors)`` of at most ``size`` rows of one label; vectors as ``planes`` bit planes, or plain.

    Rows are dealt by label and id, so a label with many rows is many tasks; ranges that lie side by side
    are read by one task while they are few tiles.
    """
    few = 1 + rows.count() // (8 * size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k = TaskContext.get().partitionId(), 0
        for b in batches:
            x, ids, label = as_matrix(b.column("v"), dims), b.column("vec_id").to_numpy(), b.column("label").to_numpy()
            for lo, hi in slices(label, size):
                vectors = packed(x[lo:hi], planes) if planes else x[lo:hi].astype(np.int32)
                yield pa.record_batch([pa.array([v], t) for v, t in ((part, pa.int64()), (k, pa.int64()), (label[lo], pa.int64()), (ids[lo:hi].tobytes(), pa.binary()),
                                                                     (vectors.tobytes(), pa.binary()))], names=["part", "k", "label", "ids", "vectors"])
                k += 1

    order = ["label", "vec_id", "v"]
    return rows.select("vec_id", "label", "v").repartitionByRange(*order).sortWithinPartitions(*order).coalesce(few).mapInArrow(
        run, "part long, k long, label long, ids binary, vectors binary")


def _numbered(cut: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Stored tiles with a ``name`` from 0 to less than the second value; some numbers may be unused."""
    kept = staged(cut, name)
    parts, most = kept.agg(F.coalesce(F.max("part") + 1, F.lit(0)), F.coalesce(F.max("k") + 1, F.lit(0))).first()
    return kept.select((F.col("part") * most + F.col("k")).alias(name), "label", "ids", "vectors"), parts * most


NONE = np.iinfo(np.int64).min


def _mined(cells: DataFrame, dims: int, planes: int, k: int, low: int, high: int) -> DataFrame:
    """``(block, anchor, positive_id, positive_score, score, vec_id)``: the best of every cell.

    Cells of one label give each anchor's k best other rows, without the positive columns. Others give, for
    each positive in ``positives``, the k best rows with a score within the bounds, in per cent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in b.to_pylist():
                a = np.frombuffer(c["a_vectors"], np.int32).reshape(-1, dims).astype(np.int64)
                ids, a_ids = np.frombuffer(c["ids"], np.int64), np.frombuffer(c["a_ids"], np.int64)
                raw = np.frombuffer(c["vectors"], np.uint8).reshape(planes, -1, len(ids))
                scores = np.ascontiguousarray(four_russians(subset_sums(a), raw).T)
                if c["label"] == c["a_label"]:
                    for row, at in zip(*np.nonzero(a_ids[:, None] == ids)):
                        if (packed(a[row:row + 1], planes)[:, :, 0] == raw[:, :, at]).all():
                            scores[row, at] = NONE  # the anchor's own row
                    row, got, own = largest(scores, ids, k)
                    positive_id = positive_score = pa.nulls(len(row), pa.int64())
                else:
                    want = c["positives"] or []
                    anchor, pos, of = (np.array([p[n] for p in want], np.int64) for n in ("anchor", "score", "vec_id"))
                    near = scores[anchor]
                    near = np.where((low * pos[:, None] <= 100 * near) & (100 * near <= high * pos[:, None]), near, NONE)
                    at, got, own = largest(near, ids, k)
                    row, positive_id, positive_score = anchor[at], pa.array(of[at]), pa.array(pos[at])
                yield pa.record_batch([pa.array(np.full(len(row), c["block"])), pa.array(np.asarray(row).astype(np.int32)), positive_id, positive_score, pa.array(got), pa.array(own)],
                                      names=["block", "anchor", "positive_id", "positive_score", "score", "vec_id"])

    return cells.mapInArrow(run, "block long, anchor int, positive_id long, positive_score long, score long, vec_id long")


def hard_negatives(rows: DataFrame, is_anchor: Column, k_positive: int = 5, k_negative: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                   id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", tile: int = TILE, block: int = BLOCK) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Scores are inner products of the components floor(scale * x); higher come first, ties by smaller id. An
    anchor, a row where ``is_anchor`` (a condition on ``vec_id``), has its first ``k_positive`` other rows of its
    label as positives. For each of them come the first ``k_negative`` rows of other labels with
    ``low * positive_score <= 100 * score <= high * positive_score``. All, if there are fewer; a positive
    without such rows has none.

    Ids and labels are integers. Rows with a null id, label or vector, or a null or non-finite component,
    take no part; rows alike in id, label and components are one row; of rows that share an id each is
    an anchor and a candidate. Shorter vectors count as filled up with zeros, and scaled components
    are held within 2 ** 23. An empty table gives no rows. Other columns are ignored.
    """
    whole = staged(scaled(rows.where(F.col(label_col).isNotNull()), scale, id_col, vec_col, label=F.col(label_col).cast("long")), "labelled")
    dims, least, most = whole.agg(F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    dims, planes = max(1, dims or 0), planes_needed(least or 0, most or 0)
    tiles, n_tiles = _numbered(_cut(whole, dims, tile, planes), "tile")
    anchors, _ = _numbered(_cut(whole.where(is_anchor), dims, block, None), "block")
    anchors = anchors.select("block", F.col("label").alias("a_label"), F.col("ids").alias("a_ids"), F.col("vectors").alias("a_vectors"))

    same = anchors.select("block", "a_label").join(tiles.select("tile", F.col("label").alias("a_label")), "a_label").drop("a_label")
    cells = same.join(anchors, "block").join(tiles, "tile")
    own = Window.partitionBy("block", "anchor").orderBy(F.desc("score"), "vec_id")
    found = _mined(cells.withColumn("positives", F.lit(None).cast("array<struct<anchor:int,score:long,vec_id:long>>")), dims, planes, k_positive, low, high)
    positives = staged(found.withColumn("place", F.row_number().over(own)).where(F.col("place") <= k_positive).select("block", "anchor", "score", "vec_id"), "positives")

    wanted = positives.groupBy("block").agg(F.collect_list(F.struct("anchor", "score", "vec_id")).alias("positives"))  # block * k_positive, at most
    every = wanted.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(max(n_tiles, 1) - 1)))).withColumn("tile", F.col("tile").cast("long"))
    cells = every.join(anchors, "block").join(tiles, "tile").where("label <> a_label")
    mined = _mined(cells, dims, planes, k_negative, low, high)
    order = Window.partitionBy("block", "anchor", "positive_id", "positive_score").orderBy(F.desc("score"), "vec_id")
    mined = mined.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k_negative)
    named = anchors.select("block", "a_ids").mapInArrow(_named, "block long, anchor int, anchor_id long")
    return mined.join(named, ["block", "anchor"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                                                         "positive_score", F.col("score").alias("negative_score"))


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for block, raw in zip(b.column("block").to_pylist(), b.column("a_ids")):
            ids = np.frombuffer(raw.as_py(), np.int64)
            yield pa.record_batch([pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], names=["block", "anchor", "anchor_id"])
