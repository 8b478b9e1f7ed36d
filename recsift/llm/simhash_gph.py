"""SimHash near-duplicates, found by the generalised pigeonhole principle.

Fingerprints within ``radius`` differing bits link. The 64 bits are dealt into a few partitions that
hold correlated bits together; how many follows from what they are expected to cost. A fingerprint gets one threshold per partition; if the thresholds sum
to ``radius - partitions + 1``, any fingerprint within the radius is within the threshold in at least
one partition (were it beyond each, the distances would sum to more than the radius). Thresholds are
unequal: dynamic programming picks, for each fingerprint, those that promise the fewest candidates. A
threshold of -1 leaves a partition out, which is what crowded values get.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.common import staged
from recsift.llm.components import components
from recsift.plans.session import staging_dir

BITS = 64
#: Words of a sub-partition whose value frequencies are counted; 2 ** SUB counts each.
SUB = 11
#: What probing one more key costs, in candidates.
PROBE_COST = 1.0

_hash = partial(xxhash.xxh64_intdigest, seed=42)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of one text as a signed 64-bit integer; no words: zero."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    h = np.fromiter(map(_hash, grams), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``: every document's SimHash over its whole text, as a long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([fingerprint(x, shingle) for x in b.column(1).to_pylist()], pa.int64())],
                                  names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, fp long")


def _bits(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.int64).view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)


def _moments(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bit i and bit j; summed by Spark over all of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = _bits(b.column(0).to_numpy()).astype(np.float64)
            total, n = total + x.T @ x, n + len(x)
        i, j = np.triu_indices(BITS)
        yield pa.record_batch([pa.array(np.r_[i * BITS + j, -1].astype(np.int32)), pa.array(np.r_[total[i, j], n].astype(np.int64))],
                              names=["cell", "n"])

    out, n = np.zeros((BITS, BITS)), 0
    for cell, v in fps.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n")).collect():
        if cell < 0:
            n = v
        else:
            out[cell // BITS, cell % BITS] = out[cell % BITS, cell // BITS] = v
    return n, out


def group_bits(n: int, both: np.ndarray, partitions: int) -> list[list[int]]:
    """Deal the bits into ``partitions`` groups of nearly equal size, correlated bits together.

    Greedy: a group starts at the free bit that is most correlated with the other free bits, and
    takes the free bit with the highest mean correlation to the group until it is full.
    """
    p = np.diag(both) / max(n, 1)
    cov = both / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.clip(np.outer(np.diag(cov), np.diag(cov)), 1e-12, None))
    corr = np.abs(cov / scale)
    np.fill_diagonal(corr, 0)
    free, out = list(range(BITS)), []
    for left in range(partitions, 0, -1):
        width = len(free) // left
        group = [max(free, key=lambda b: corr[b, free].sum())]
        while len(group) < width:
            group.append(max((b for b in free if b not in group), key=lambda b: corr[b, group].mean()))
        free = [b for b in free if b not in group]
        out.append(sorted(group))
    return out


def _value(bits: np.ndarray, group: list[int]) -> np.ndarray:
    return (bits[:, group] << np.arange(len(group), dtype=np.uint64)).sum(1, dtype=np.uint64).astype(np.int64)


def _subs(group: list[int]) -> list[list[int]]:
    k = -(-len(group) // SUB)
    return [group[len(group) * i // k:len(group) * (i + 1) // k] for i in range(k)]


def _near(fps: DataFrame, groups: list[list[int]], radius: int) -> list[list[np.ndarray]]:
    """For each sub-partition of each partition: per value, the share of fingerprints at distance 0..radius.

    The counts of values come from all fingerprints; there are at most 2 ** SUB values each.
    """
    subs = [(i, k, s) for i, g in enumerate(groups) for k, s in enumerate(_subs(g))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(1 << len(s), np.int64) for _, _, s in subs]
        for b in batches:
            bits = _bits(b.column(0).to_numpy())
            for t, (_, _, s) in zip(sums, subs):
                t += np.bincount(_value(bits, s), minlength=len(t))
        for at, t in enumerate(sums):
            v = np.flatnonzero(t)
            yield pa.record_batch([pa.array(np.full(len(v), at, np.int32)), pa.array(v.astype(np.int32)), pa.array(t[v])], names=["at", "v", "n"])

    counts = [np.zeros(1 << len(s)) for _, _, s in subs]
    for at, v, n in fps.select("fp").mapInArrow(run, "at int, v int, n long").groupBy("at", "v").agg(F.sum("n")).collect():
        counts[at][v] = n
    out: list[list[np.ndarray]] = [[] for _ in groups]
    for (i, _, s), c in zip(subs, counts):
        every = np.arange(len(c), dtype=np.int64)
        c = c / max(1.0, c.sum())
        near = np.zeros((len(c), radius + 1))
        for flips in range(min(radius, len(s)) + 1):
            for at in combinations(range(len(s)), flips):
                near[:, flips] += c[every ^ sum(1 << b for b in at)]
        out[i].append(near)
    return out


def allocate(cost: np.ndarray, total: int) -> np.ndarray:
    """Thresholds per row and partition, by dynamic programming.

    ``cost[row, partition, e + 1]`` is what threshold ``e`` costs, for e = -1, 0, 1, ...; the
    thresholds of a row sum to ``total`` at the least sum of costs (ties: the smaller threshold
    in the later partition).
    """
    rows, parts, kinds = cost.shape
    spend = total + parts  # each threshold is counted from -1
    best = np.full((rows, spend + 1), np.inf)
    best[:, 0] = 0
    picks = []
    for i in range(parts):
        new, pick = np.full_like(best, np.inf), np.zeros(best.shape, np.int64)
        for e in range(min(kinds, spend + 1)):
            with_e = best[:, :spend + 1 - e] + cost[:, i, e][:, None]
            better = with_e < new[:, e:]
            new[:, e:][better], pick[:, e:][better] = with_e[better], e
        best = new
        picks.append(pick)
    out, left, every = np.zeros((rows, parts), np.int64), np.full(rows, spend), np.arange(rows)
    for i in range(parts - 1, -1, -1):
        e = picks[i][every, left]
        out[:, i], left = e - 1, left - e
    return out


def expected_cost(n: int, groups: list[list[int]], near: list[list[np.ndarray]], radius: int) -> float:
    """Candidates and probes that a fingerprint is expected to cost with these groups and the thresholds best on average."""
    cost = np.zeros((1, len(groups), radius + 2))
    for i, g in enumerate(groups):
        share = np.eye(1, radius + 1)[0]
        for table in near[i]:
            share = np.convolve(share, table[:, 0] @ table)[:radius + 1]  # a value's own share is that at distance 0
        cost[0, i, 1:] = np.cumsum(share) * n + PROBE_COST * np.cumsum([comb(len(g), e) for e in range(radius + 1)])
    limit = allocate(cost, radius - len(groups) + 1)[0]
    return float(sum(cost[0, i, e + 1] for i, e in enumerate(limit)))


def partitioned(fps: DataFrame, radius: int, partitions: int | None) -> tuple[int, list[list[int]], list[list[np.ndarray]]]:
    """The number of fingerprints, the groups of bits, and their ``_near``: of all numbers of partitions (or the given one)
    the one of the least expected cost, which falls as fingerprints grow in number. One pass counts for all."""
    n, both = _moments(fps)
    options = [group_bits(n, both, m) for m in ([partitions] if partitions else range(1, radius + 2))]
    near = iter(_near(fps, [g for groups in options for g in groups], radius))
    tables = [[next(near) for _ in groups] for groups in options]
    best = min(range(len(options)), key=lambda k: expected_cost(n, options[k], tables[k], radius))
    return n, options[best], tables[best]


def links(fps: DataFrame, radius: int = 3, partitions: int | None = None) -> DataFrame:
    """``(u, v)``, u < v: all pairs of different fingerprints in ``fps`` (distinct longs) within ``radius`` bits."""
    n, groups, near = partitioned(fps, radius, partitions)
    flips = [[np.array([sum(1 << b for b in at) for at in combinations(range(len(g)), e)], np.uint64).view(np.int64) for e in range(radius + 1)] for g in groups]

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy()
            bits = _bits(fp)
            cost = np.zeros((len(fp), len(groups), radius + 2))
            for i, g in enumerate(groups):
                share = np.zeros((len(fp), radius + 1))
                share[:, 0] = 1
                for s, table in zip(_subs(g), near[i]):
                    own = table[_value(bits, s)]
                    share = np.stack([sum(share[:, a] * own[:, e - a] for a in range(e + 1)) for e in range(radius + 1)], 1)
                probes = np.cumsum([len(f) for f in flips[i]])
                cost[:, i, 1:] = np.cumsum(share, 1) * n + PROBE_COST * probes
            limit = allocate(cost, radius - len(groups) + 1)
            for i, g in enumerate(groups):
                value = _value(bits, g)
                key = (np.int64(i) << np.int64(BITS - 8)) | value
                yield pa.record_batch([pa.array(key), pa.array(fp), pa.array(np.zeros(len(fp), bool))], names=["key", "fp", "probe"])
                for e in range(radius + 1):
                    at = np.flatnonzero(limit[:, i] >= e)
                    some = max(1, (1 << 18) // len(flips[i][e]))
                    for lo in range(0, len(at), some):
                        rows = at[lo:lo + some]
                        probe = ((np.int64(i) << np.int64(BITS - 8)) | (value[rows][:, None] ^ flips[i][e][None, :])).ravel()
                        yield pa.record_batch([pa.array(probe), pa.array(np.repeat(fp[rows], len(flips[i][e]))), pa.array(np.ones(len(probe), bool))],
                                              names=["key", "fp", "probe"])

    made = fps.select("fp").mapInArrow(keys, "key long, fp long, probe boolean")
    index = made.where("not probe").select("key", F.col("fp").alias("u"))
    probe = made.where("probe").select("key", F.col("fp").alias("v"))
    # Every fingerprint probes for all others, so it is enough that the larger one finds the smaller.
    return index.join(probe, "key").where((F.col("u") < F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)).select("u", "v").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3,
                    partitions: int | None = None) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``.

    Texts are lower-cased (A-Z) and cut into words at ASCII white space; a fingerprint bit is set if
    it is set in over half of the XXH64 (seed 42) hashes of the shingles, repeats included. Documents
    are in one component if a chain of fingerprints within ``radius`` bits joins them;
    ``component_id`` is its smallest id.

    Null or empty texts and texts without words have fingerprint zero and link like any other; fewer
    words than a shingle: the whole sequence is one shingle. Rows with a null id keep a row and belong
    to their component, which is named by its smallest non-null id (null if there is none). Repeated
    rows stay repeated. An empty table gives no rows. Other columns are ignored.

    Equal fingerprints are collapsed before the search, so exact copies are never paired. A group of
    copies is thus one node; only pairs of different fingerprints that truly link are written. Without
    ``partitions`` their number, up to ``radius + 1``, follows from the expected cost: the more fingerprints, the
    fewer and wider they are, so candidates do not grow with the square.
    """
    staging_dir(docs.sparkSession)
    if partitions is not None and not 1 <= partitions <= radius + 1:
        raise ValueError("partitions must lie between 1 and radius + 1")
    own = staged(fingerprints(docs, id_col, text_col, shingle), "simhash")
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(nodes.select("fp"), radius, partitions))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = rooted.join(named, "root").select("fp", "component_id")
    return own.join(by_fp, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
