"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Texts become lower-cased words of letters and digits; shingles are ``width`` words. A benchmark item of m
shingles is compared with windows of m shingles (fewer at a document's end). Fingerprints are 64-bit
SimHashes of the shingles, weighted by how often they occur. They are cut into blocks; two fingerprints
within ``radius`` bits differ in at most ``radius // blocks`` bits in some block, so probing each block's
values within that many flips finds all of them. Candidates are verified with the exact weighted Jaccard
similarity of the shingle multisets, sum of minima over sum of maxima.

Only windows that share a shingle with some item of their size are fingerprinted: the others have
similarity zero. Built-in column functions only.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.llm.common import fresh, staged

#: Rows, of at most six numbers, up to which a table made from the benchmark is broadcast; beyond, Spark shuffles both sides.
BROADCAST_ROWS = 1_000_000


def words(text: Column) -> Column:
    """Lower-cased words of letters and digits; null: none."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(F.regexp_replace(low, r"[^\p{L}\p{M}\p{N}]+", " "), " "), lambda w: w != "")


def with_shingles(df: DataFrame, width: int, name: str = "run") -> DataFrame:
    """``df`` with ``name``, the hashes of all runs of ``width`` words of its column ``ws``, in order.

    Word hashes are a column of their own first, so that a run only looks them up. (Explode ``name``
    with ``explode_outer``: for ``explode`` Spark would add a filter on the array's size, pushed below
    both columns and with them in it once for every look-up.)
    """
    hashed = df.withColumn("hashed", F.transform("ws", lambda w: F.xxhash64(w)))
    runs = F.transform("hashed", lambda h, i: F.xxhash64(h, *(F.get("hashed", i + k) for k in range(1, width))))
    return hashed.withColumn(name, F.slice(runs, 1, F.greatest(F.size("hashed") - (width - 1), F.lit(0)))).drop("hashed")


def _small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are within the bound."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _lanes(h: Column, wide: int) -> list[Column]:
    """The 64 bits of ``h`` in lanes of ``wide`` bits, as many to a long as fit, so that sums of the longs are 64 counters."""
    out, each = [], 63 // wide
    for lo in range(0, 64, each):
        parts = [F.shiftleft(F.shiftrightunsigned(h, b).bitwiseAND(F.lit(1).cast("long")), wide * k) for k, b in enumerate(range(lo, min(lo + each, 64)))]
        out.append(sum(parts[1:], parts[0]))
    return out


def _fingerprint(lanes: list[Column], n: Column, wide: int) -> Column:
    """A bit is set if over half of the ``n`` shingles have it."""
    bits, each = [], 63 // wide
    for b in range(64):
        ones = F.shiftrightunsigned(lanes[b // each], wide * (b % each)).bitwiseAND(F.lit((1 << wide) - 1).cast("long"))
        bits.append(F.when(ones * 2 > n, F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")))
    while len(bits) > 1:  # a shallow tree
        bits = [a.bitwiseOR(b) for a, b in zip(bits[::2], bits[1::2])]
    return bits[0]


def _block(fp: Column, i: int, blocks: int) -> Column:
    size = 64 // blocks
    return F.shiftrightunsigned(fp, size * i).bitwiseAND(F.lit((1 << size) - 1).cast("long"))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Sum of minima over sum of maxima of the counts in two arrays."""
    times = lambda xs, v: F.size(F.filter(xs, lambda x: x == v))
    least = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, v: s + F.least(times(a, v), times(b, v)))
    return least / (F.size(a) + F.size(b) - least)


def _key() -> Column:
    return F.xxhash64("doc_id", "text")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", width: int = 5, similarity: float = 0.8, radius: int = 23, blocks: int = 8) -> DataFrame:
    """``(doc_id, key, item_id, start, similarity)``: the best window of each document for each item it holds.

    A document holds an item if one of its item-sized windows is within ``radius`` bits and its
    similarity is at least ``similarity``. ``start`` is the window's first shingle (ties: the earliest).
    ``key`` is a hash of the document's id and text, for joins back.

    Items of fewer than ``width`` words are one shingle of all their words; items without words, null or
    empty, match nothing. Null or empty texts hold nothing. Repeated document rows are one document here;
    repeated item rows are one item; rows with a null id are reported under null. Empty tables give no rows. Other
    columns are ignored.

    Tables of the items' hashes and probes, a few numbers a row, are broadcast only if their counted rows are
    within ``BROADCAST_ROWS``; shingles stay out of them and are fetched for pairs within the radius. The documents
    are cut into shingles once and meet the items' shingles in a semi join; only documents with a shared
    shingle go further, in a staged table.
    """
    if 64 % blocks or not 0 <= radius < 64:
        raise ValueError("blocks must divide 64, and the radius be 0 to 63 bits")
    items = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("ws")).where(F.size("ws") > 0).distinct()
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).select("doc_id", _key().alias("key"), words(F.col("text")).alias("ws"))
    held = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("key", _key())
    item_parts, doc_parts = [], []
    for w in sorted(r.w for r in items.select(F.least(F.size("ws"), F.lit(width)).alias("w")).distinct().collect()):  # at most ``width`` values
        at_w = with_shingles(items.where(F.least(F.size("ws"), F.lit(width)) == w), w, "item").select("item_id", F.lit(w).alias("w"), "item")
        item_parts.append(at_w)
        wanted = at_w.select(F.explode("item").alias("h")).distinct()
        runs = with_shingles(own, w)
        met = runs.select("doc_id", "key", F.explode_outer("run").alias("h")).join(_small(wanted), "h", "left_semi").select("doc_id", "key").distinct()
        near = held.join(met.select("key"), "key").dropDuplicates(["key"]).select("doc_id", "key", words(F.col("text")).alias("ws"))
        doc_parts.append(with_shingles(near, w).select("doc_id", "key", F.lit(w).alias("w"), "run"))
    if not item_parts:
        return own.limit(0).select("doc_id", "key", F.lit(None).cast(benchmark.schema[item_col].dataType).alias("item_id"), F.lit(0).alias("start"),
                                   F.lit(0.0).alias("similarity"))
    item = staged(_all(item_parts).withColumn("m", F.size("item")).withColumn("item_key", F.xxhash64("item_id", "item")), "items")
    doc = staged(_all(doc_parts), "leak-docs")

    # Where each window size has a shared shingle, and the windows that hold one.
    shared = item.select("w", "m", F.explode("item").alias("h")).distinct()
    places = doc.select("key", "w", F.size("run").alias("n"), F.posexplode("run").alias("p", "h")).join(_small(shared), ["w", "h"])
    spread = places.select("key", "w", "m", "n", F.explode(F.sequence(F.greatest(F.col("p") - F.col("m") + 1, F.lit(0)), F.col("p"))).alias("start")).distinct()
    # All shingles of those windows, each once, then sums over sliding windows.
    ends = spread.groupBy("key", "w", "m", "n").agg(F.collect_set("start").alias("starts"))
    every = ends.join(doc.select("key", "w", "run"), ["key", "w"]).select(
        "key", "w", "m", "starts", "run",
        F.explode_outer(F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, F.least(s + F.col("m"), F.col("n")) - 1))))).alias("p"))
    rows = every.select("key", "w", "m", "p", F.array_contains("starts", F.col("p")).alias("is_start"), F.get("run", F.col("p")).alias("h"))
    most = item.agg(F.max("m")).first()[0]
    wide = int(most).bit_length()  # a window has at most ``most`` shingles, and so has each counter
    lanes = [f"l{i}" for i in range(len(_lanes(F.col("h"), wide)))]
    laned = rows.select("*", *(x.alias(c) for x, c in zip(_lanes(F.col("h"), wide), lanes)))
    # Frames of m shingles for any m: positions are scaled so that m of them make ``unit``, rounded down
    # (neighbours stay at least 2 apart, and what is m apart stays exactly ``unit`` apart).
    unit = 2 * most
    frame = Window.partitionBy("key", "w", "m").orderBy(F.expr(f"CAST(p AS BIGINT) * {unit} DIV m")).rangeBetween(0, unit - 1)
    slid = laned.select("key", "w", "m", "p", "is_start", F.count(F.lit(1)).over(frame).alias("size"),
                        *(F.sum(c).over(frame).alias(c) for c in lanes)).where("is_start")
    windows = slid.select("key", "w", "m", F.col("p").alias("start"), _fingerprint([F.col(c) for c in lanes], F.col("size"), wide).alias("fp"))

    summed = item.select("item_key", "w", "m", F.explode("item").alias("h")).select(
        "item_key", "w", "m", *(x.alias(c) for x, c in zip(_lanes(F.col("h"), wide), lanes))).groupBy("item_key", "w", "m").agg(*(F.sum(c).alias(c) for c in lanes))
    marked = summed.select("item_key", "w", "m", _fingerprint([F.col(c) for c in lanes], F.col("m"), wide).alias("item_fp"))
    size, reach = 64 // blocks, radius // blocks
    flips = F.array(*(F.lit(sum(1 << b for b in at)).cast("long") for e in range(reach + 1) for at in combinations(range(size), e)))
    probes = marked.select("*", F.posexplode(F.array(*(_block(F.col("item_fp"), i, blocks) for i in range(blocks)))).alias("block", "value")).select(
        "item_key", "w", "m", "item_fp", "block", F.explode(F.transform(flips, lambda f: f.bitwiseXOR(F.col("value")))).alias("value"))
    index = windows.select("*", F.posexplode(F.array(*(_block(F.col("fp"), i, blocks) for i in range(blocks)))).alias("block", "value"))
    apart = F.col("fp").bitwiseXOR(F.col("item_fp"))
    # A pair that meets in several blocks goes on from the first of them alone.
    first = F.coalesce(*(F.when(F.bit_count(_block(apart, i, blocks)) <= reach, F.lit(i)) for i in range(blocks)))
    near = index.join(_small(probes), ["w", "m", "block", "value"]).where((F.bit_count(apart) <= radius) & (F.col("block") == first))
    # Only pairs within the radius fetch their shingles.
    cut = near.select("key", "w", "m", "start", "item_key").join(doc.select("key", "w", "run"), ["key", "w"]).select(
        "key", "start", "item_key", F.slice("run", F.col("start") + 1, F.col("m")).alias("window"))
    found = cut.join(item.select("item_key", "item_id", "item"), "item_key").select(
        "key", "item_id", "start", weighted_jaccard(F.col("window"), F.col("item")).alias("similarity")).where(F.col("similarity") >= similarity)
    best = found.groupBy("key", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("b"))
    named = doc.select("doc_id", "key").distinct()
    return best.join(named, "key").select("doc_id", "key", "item_id", (-F.col("b.back")).alias("start"), F.col("b.similarity").alias("similarity"))


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """The rows of ``docs (doc_id, text, ...)``, all columns, that hold no benchmark item."""
    name = fresh(docs, "leak_key")
    bad = leaks(docs, benchmark, **kw).select(F.col("key").alias(name)).distinct()
    return docs.join(bad, _key() == F.col(name), "left_anti")
