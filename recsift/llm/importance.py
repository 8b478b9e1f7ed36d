"""Importance resampling: how much likelier a text is under a target model than under a raw model.

Both models are bags of hashed n-grams, one table each for the words, the first letters of words (which
gather inflected and rare forms), and pairs of neighbouring words. The
raw model is counted over all documents, the target model over documents that labels name as good. A
document's log weight sums, over its n-grams, the log ratio of the models; documents are drawn without
replacement in proportion to their weights by Gumbel top-k: add Gumbel noise, take the largest.

A few insults in clean prose hardly move that sum, so what tells toxic from good text is weighed by
itself: a third model is counted over documents labelled toxic, and a document's toxicity is the sum per
word of the log ratios, toxic to good, of those n-grams alone that are much likelier in toxic text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.common import staged
from recsift.llm.word_hash import batches_of_words, pairs

#: Buckets and pseudo-counts of the tables of words, heads and pairs. A pseudo-count is added to the
#: target count and to what the raw model leads one to expect, so n-grams without evidence weigh nothing.
TABLES = ((1 << 19, 3.0), (1 << 16, 3.0), (1 << 18, 20.0))
SIZE = sum(buckets for buckets, _ in TABLES)
#: Labelled documents used, at most; those with the smallest hash of the id.
MAX_LABELS = 200_000
#: One in so many labelled documents is kept out of the models, to calibrate on.
HELD_OUT = 5
#: Log ratio, toxic to good, from which an n-gram counts for toxicity.
EVIDENCE = 1.0
#: Scale of the noise against the tempered log weight.
TEMPER = 0.05
#: Taken off the keys of documents above the limit of toxicity, so that they are drawn after all others.
LAST = 1e9


def labelled(labels: DataFrame, bound: int = MAX_LABELS) -> dict[str, np.ndarray]:
    """``id`` (sorted), ``good``, ``toxic``, ``held_out`` arrays of at most ``bound`` labelled documents.

    A document is good if no label calls it low or toxic; null labels are ignored, repeated ones merge.
    """
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    rows = one.where("quality IS NOT NULL OR toxic IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("quality", F.lit(1)).cast("long").alias("quality"), F.coalesce("toxic", F.lit(0)).cast("long").alias("toxic"),
        F.xxhash64("doc_id").alias("h")).orderBy("h").limit(bound).toArrow().sort_by("doc_id")
    ids, quality, toxic, h = (rows[c].to_numpy() for c in ("doc_id", "quality", "toxic", "h"))
    return {"id": ids, "good": (quality > 0) & (toxic == 0), "toxic": toxic > 0, "held_out": (h.view(np.uint64) >> np.uint64(40)) % np.uint64(HELD_OUT) == 0}


def positions(ids: pa.Array, known: np.ndarray) -> np.ndarray:
    """Where each id stands in the sorted ``known``; -1: nowhere, or null."""
    own = ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(known):
        return np.full(len(own), -1)
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    return np.where((known[at] == own) & ids.is_valid().to_numpy(zero_copy_only=False), at, -1)


def cells(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first, last, cell, row)``: every n-gram's cell, table after table."""
    for first, last, h, heads, rows in batches_of_words(texts):
        p, pair_rows = pairs(h, rows)
        at, cell = 0, []
        for x, (buckets, _) in zip((h, heads, p), TABLES):
            cell.append((x % np.uint64(buckets)).astype(np.int64) + at)
            at += buckets
        yield first, last, np.concatenate(cell), np.r_[rows, rows, pair_rows]


def counts(docs: DataFrame, ids: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Counts of every cell: row 0 over all ``docs (doc_id, text)``, row g over documents of group g >= 1.

    Counted per task, summed by Spark; the driver gets one row per cell, a bounded number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((groups + 1, SIZE), np.int64)
        for b in batches:
            at = positions(b.column(0), ids)
            of = np.where(at >= 0, group[at] if len(group) else 0, 0)
            for first, last, cell, row in cells(b.column(1)):
                out[0] += np.bincount(cell, minlength=SIZE)
                mine = of[first:last][row]
                for g in range(1, groups + 1):
                    if (mine == g).any():
                        out[g] += np.bincount(cell[mine == g], minlength=SIZE)
        used = np.flatnonzero(out[0])
        for lo in range(0, len(used), 1 << 16):
            part = used[lo:lo + (1 << 16)]
            yield pa.record_batch([pa.array(part.astype(np.int32)), *(pa.array(out[g, part]) for g in range(groups + 1))], names=["cell", *(f"n{g}" for g in range(groups + 1))])

    made = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ", ".join(["cell int", *(f"n{g} long" for g in range(groups + 1))]))
    got = made.groupBy("cell").agg(*(F.sum(f"n{g}").alias(f"n{g}") for g in range(groups + 1))).toArrow()
    out = np.zeros((groups + 1, SIZE))
    for g in range(groups + 1):
        out[g, got["cell"].to_numpy()] = got[f"n{g}"].to_numpy()
    return out


def log_ratio(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Per cell, the log of the part's share over the whole's, shrunk towards zero by the pseudo-counts."""
    out = np.zeros(len(whole), np.float32)
    hi = 0
    for buckets, prior in TABLES:
        lo, hi = hi, hi + buckets
        expect = whole[lo:hi] * (part[lo:hi].sum() / max(1.0, whole[lo:hi].sum()))
        out[lo:hi] = np.log((part[lo:hi] + prior) / (expect + prior))
    return out


def toxic_limit(good: np.ndarray, toxic: np.ndarray, keep_good: float) -> float:
    """The toxicity up to which texts pass: the least share of ``good`` above it plus share of ``toxic`` up to it.

    At least a share ``keep_good`` of the good passes, so that few toxic labels cannot cost many good
    texts. Halfway to the next value seen; infinite where no limit tells the two apart.
    """
    if not len(good) or not len(toxic):
        return np.inf
    seen = np.unique(np.r_[good, toxic])
    seen = seen[seen >= np.quantile(good, keep_good, method="inverted_cdf")]
    loss = np.searchsorted(np.sort(toxic), seen, "right") / len(toxic) - np.searchsorted(np.sort(good), seen, "right") / len(good)
    best = int(loss.argmin())
    return float(seen[best:best + 2].mean()) if loss[best] < 0 else np.inf


def gumbel(ids: pa.Array, seed: int) -> np.ndarray:
    """Standard Gumbel noise, the same for the same id and seed on every run."""
    u = np.array([(xxhash.xxh64_intdigest(str(i), seed=seed) + 0.5) / 2.0**64 for i in ids.to_pylist()])
    return -np.log(-np.log(np.clip(u, 1e-300, 1 - 1e-16)))


def kth_largest(scores: DataFrame, col: str, k: int, bins: int = 1024) -> float:
    """The k-th largest value of ``col``, by narrowing a histogram; each round is one aggregation."""
    low, high = scores.agg(F.min(col), F.max(col)).first()
    above = 0
    while low < high:
        at = F.least(F.floor((F.col(col) - low) / (high - low) * bins), F.lit(bins - 1))
        seen = scores.where(F.col(col).between(low, high)).groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi"))
        for r in seen.orderBy(F.desc("bin")).collect():  # at most ``bins`` rows
            if above + r.n >= k:
                low, high = r.lo, r.hi
                break
            above += r.n
    return low


def resample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int | None = None, keep_good: float = 0.98,
             seed: int = 7, max_labels: int = MAX_LABELS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, n_words, log_weight, gumbel_key, draw_key, kept)`` for every row of ``docs``.

    Rows above the limit of toxicity are drawn last: their keys are lowered by ``LAST``. The limit is where
    labelled good and toxic documents, held out from the models, are told apart best, but a share
    ``keep_good`` of the good ones pass (``toxic_limit``).

    ``kept`` marks the ``k`` rows with the largest keys (ties at the last place are all kept). Without
    ``k`` weights are tempered by length, so that long texts do not fill both ends of the order: the key
    drawn by, ``draw_key``, is the log weight over the root of the number of words, plus ``TEMPER`` times the
    noise, which draws in proportion to the exponential of the former over ``TEMPER``. The k largest keys
    up to the limit of toxicity are kept; k is the number of rows, over the whole table, whose key reaches what
    a share ``keep_good`` of the held-out good documents up to that limit reach. With ``k`` ``draw_key`` equals
    ``gumbel_key``. Without held-out labels of both kinds none is toxic.

    The target model comes from at most ``max_labels`` labelled rows of ``labels (doc_id, quality,
    toxic)``; the raw model, the weights and the selection cover every document and its whole text. Null
    or empty texts weigh nothing (log weight 0). Rows with a null id are unlabelled and share their
    noise; repeated rows have equal keys. Without good labels every weight is 0 and, if ``k`` is not
    given, all are kept. An empty table gives no rows. ``keep`` names columns to carry along (they are
    weighed again on the way rather than stored or joined); others are ignored.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    known = labelled(labels, max_labels)
    kind = np.where(known["good"], 1, np.where(known["toxic"], 2, 0)).astype(np.int8)
    n = counts(own, known["id"], np.where(known["held_out"], 0, kind), 2)
    ratio, toxic = (log_ratio(n[g], n[0]) if n[g].sum() else np.zeros(n.shape[1], np.float32) for g in (1, 2))
    ids = known["id"]
    calibrate = np.where(known["held_out"], kind, 0).astype(np.int8)
    shared = docs.sparkSession.sparkContext.broadcast((ratio, np.where(toxic - ratio >= EVIDENCE, toxic - ratio, 0)))  # SIZE numbers each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, evidence = shared.value
        for b in batches:
            weight, toxicity, words = np.zeros(b.num_rows), np.zeros(b.num_rows), np.zeros(b.num_rows, np.int64)
            for first, last, cell, row in cells(b.column(1)):
                weight[first:last] = np.bincount(row, table[cell], last - first)
                toxicity[first:last] = np.bincount(row, evidence[cell], last - first)
                words[first:last] = np.bincount(row[cell < TABLES[0][0]], minlength=last - first)
            at = positions(b.column(0), ids)
            held_out = np.where(at >= 0, calibrate[at] if len(calibrate) else 0, 0).astype(np.int8)
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], pa.array(words), pa.array(weight), pa.array(weight + gumbel(b.column(0), seed)),
                                              pa.array(toxicity / np.maximum(words, 1)), pa.array(held_out)],
                                             names=["doc_id", *b.schema.names[2:], "n_words", "log_weight", "gumbel_key", "toxicity", "held_out"])

    def weighed(*carried: str) -> DataFrame:
        kinds = "".join(f"`{c}` {docs.schema[c].dataType.simpleString()}, " for c in carried)
        taken = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"), *carried)
        return taken.mapInArrow(run, f"doc_id long, {kinds}n_words long, log_weight double, gumbel_key double, toxicity double, held_out byte")

    scores = staged(weighed(), "weights")
    tempered = F.col("log_weight") / F.sqrt(F.greatest("n_words", F.lit(1))) + TEMPER * (F.col("gumbel_key") - F.col("log_weight"))
    seen = scores.where("held_out > 0").groupBy("doc_id").agg(F.max(F.struct("held_out", "toxicity", tempered.alias("key"))).alias("x")).select("x.*").toArrow()  # at most max_labels rows
    which, toxicity, own_key = (seen[c].to_numpy() for c in ("held_out", "toxicity", "key"))
    most = toxic_limit(toxicity[which == 1], toxicity[which == 2], keep_good)
    lowered = lambda key: key - F.when(F.col("toxicity") > most, LAST).otherwise(0.0)
    rows = scores.count()
    if k is None:
        level, drawn = -np.inf, lowered(tempered)
        good = own_key[(which == 1) & (toxicity <= most)]
        if len(good) and n[1].sum():
            level = float(np.quantile(good, 1 - keep_good, method="inverted_cdf"))
        wanted = scores.where((drawn >= level) & (F.col("toxicity") <= most)).count()
    else:
        wanted, drawn = k, lowered(F.col("gumbel_key"))
    limit = kth_largest(scores.select(drawn.alias("key")), "key", wanted) if 0 < wanted < rows else (np.inf if wanted <= 0 else -np.inf)
    kept = (drawn >= float(limit)) & ((F.col("toxicity") <= most) if k is None else F.lit(True))
    return (weighed(*keep) if keep else scores).select("doc_id", *keep, "n_words", "log_weight", lowered(F.col("gumbel_key")).alias("gumbel_key"), drawn.alias("draw_key"), kept.alias("kept"))
