"""Katz backoff language model over pairs of words.

P(w | h) is the Good-Turing discounted share of the pair (h, w) among the pairs of h if training text has
it, else alpha(h) * P(w); P(w) is in turn the discounted share of w among all tokens, or, for words that
training text lacks, the mass that discounting left over. alpha(h) is set so that the probabilities
after h sum to one exactly. Histories that training text lacks back off wholly.

Counts are kept in tables partitioned by hash. Documents are dealt into blocks (see ``blocks``):

1. A block sends its distinct words with their training counts; word buckets sum them and answer with
   the count and the rank of each, which together with the bucket is the word's id.
2. A block sends its distinct pairs, by id, with their training counts; pair buckets sum them, answer
   with the counts, and tell the word buckets of the histories how many followers of each count they
   saw. Pairs of a frequent history are dealt over several buckets, in proportion to its count.
3. Word buckets sum what they were told and answer each block with the sums for its words.
4. A block evaluates each of its tokens by the recursion above and sums by document.

What is sent about a history are whole numbers, so weights do not depend on the order of sums.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm.blocks import block_count, in_blocks, texts
from recsift.llm.word_hash import batches_of_words, mixed

#: Text per block; its tokens and pairs are held as arrays of eight bytes each.
BLOCK_BYTES = 12 << 20
#: Ids of the end of a text and of what stands before its first word; words are 64-bit hashes.
END, START = np.uint64(1), np.uint64(2)
#: Counts up to this are discounted.
CUT = 5
#: A history's pairs go to one bucket more for each so many occurrences.
SPLIT = 1 << 16
#: Numbers kept per history: followers by pair count 1..CUT, sum of larger pair counts, followers by
#: their own count 1..CUT, sum of larger own counts.
SUMS = 2 * (CUT + 1)
#: Kinds of answer.
WORDS, PAIRS, HISTORY, TOTALS = range(4)


def pack(x: np.ndarray) -> bytes:
    """Whole numbers, eight planes of bytes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(np.int64)


def packed_up(x: np.ndarray) -> bytes:
    """The same for ascending numbers: their differences."""
    return pack(np.diff(x.astype(np.int64), prepend=np.int64(0)))


def unpacked_up(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw))


def is_held_out(doc_id, fold: int = 1, folds: int = 5) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == fold


class Block:
    """The tokens of a block's documents, with histories, as places in its sorted distinct words."""

    def __init__(self, f: pa.Table) -> None:
        self.held_out = np.array([is_held_out(i.as_py()) for i in f["doc_id"]], bool)
        docs = len(self.held_out)
        hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for first, _, h, _, r in batches_of_words(pa.array(texts(f["packed"]), pa.large_string())):
            hashes.append(h)
            rows.append(r + first)
        h, r = np.concatenate(hashes), np.concatenate(rows)
        ends = np.cumsum(np.bincount(r, minlength=docs)) + np.arange(docs)
        token = np.empty(len(h) + docs, np.uint64)
        token[np.arange(len(h)) + r], token[ends] = h, END
        self.doc = np.repeat(np.arange(docs), np.diff(ends, prepend=-1))
        self.words, place = np.unique(np.r_[token, START], return_inverse=True)
        self.token = place[:-1]
        self.history = np.r_[place[-1:], self.token[:-1]]
        self.history[ends[:-1] + 1] = place[-1]
        self.trained = ~self.held_out[self.doc]
        self.counts = np.bincount(self.token[self.trained], minlength=len(self.words))
        self.counts[place[-1]] = (~self.held_out).sum()

    def cuts(self, n: int) -> np.ndarray:
        """Where each of the ``n`` buckets begins among the sorted words."""
        return np.searchsorted(((self.words >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32), np.arange(n + 1, dtype=np.uint64))

    def learn(self, answers: pa.Table, n: int) -> None:
        """Takes the words' global counts and ids, and from them the order in which pairs are sent."""
        cuts = self.cuts(n)
        self.count, self.id = np.zeros(len(self.words), np.int64), np.zeros(len(self.words), np.int64)
        for kind, bucket, a, b in zip(*(answers[c].to_pylist() for c in ("kind", "bucket", "a", "b"))):
            if kind == WORDS:
                own = slice(cuts[bucket], cuts[bucket + 1])
                self.count[own], self.id[own] = unpack(a), unpacked_up(b) * n + bucket
        pairs, self.pair = np.unique(self.history * len(self.words) + self.token, return_inverse=True)
        self.h, self.w = pairs // len(self.words), pairs % len(self.words)
        salt = self.id[self.w] % (1 + self.count[self.h] // SPLIT)
        self.to = (mixed(mixed(self.id[self.h].view(np.uint64)) + salt.view(np.uint64)) % np.uint64(n)).astype(np.int64)
        self.order = np.lexsort((self.id[self.w], self.id[self.h], self.to))
        self.pair_cuts = np.searchsorted(self.to[self.order], np.arange(n + 1))


def _of_counts(c: np.ndarray) -> list[int]:
    """How many counts are 1, 2, ... CUT + 1."""
    return [int((c == r).sum()) for r in range(1, CUT + 2)]


def discounts(of: list[int]) -> np.ndarray:
    """Katz's discount for counts 0 to CUT + 1 (1 for 0 and beyond the cut), from counts of counts.

    Good-Turing, rescaled so that the mass taken is that of the singletons; where the counts of counts
    give none between 0 and 1, (r - 0.5) / r.
    """
    d = np.ones(CUT + 2)
    tail = (CUT + 1) * of[CUT] / of[0] if of[0] else 1.0
    for r in range(1, CUT + 1):
        turing = (r + 1) * of[r] / (r * of[r - 1]) if of[r - 1] else 0.0
        x = (turing - tail) / (1 - tail) if tail < 1 else 0.0
        d[r] = x if 0 < x < 1 else (r - 0.5) / r
    return d


def shares(c: np.ndarray, d: np.ndarray, total) -> np.ndarray:
    """Discounted relative counts."""
    return d[np.minimum(c, CUT + 1)] * c / np.maximum(total, 1)


def masses(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(discounted, plain)`` totals from numbers of counts 1..CUT and the sum of larger counts."""
    by = sums[:, :CUT] * np.arange(1, CUT + 1)
    return by @ d[1:CUT + 1] + sums[:, CUT], by.sum(1) + sums[:, CUT]


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``.

    Texts are lower-cased (A-Z) and cut at ASCII white space; the end of a text is one more token.
    Training text is that of documents whose crc32 of the id as text is not 1 modulo 5. ``base_score``
    is the add-half unigram score, ``score`` the model's log10 probability of the whole text.

    Null and empty texts are the end alone. A null id counts as the empty text for the fold; repeated
    rows are repeated text, and each gets its row. Where the pairs of a history, or all words, leave no
    mass to unseen ones (no count is below the cut), one occurrence is added to the total for them. An
    empty table gives no rows; other columns are ignored. Words are told apart by 64-bit hashes.
    """
    n = block_count(docs, text_col, BLOCK_BYTES)
    blocks = in_blocks(docs, n, id_col, text_col)
    answer = "block int, kind int, bucket int, a binary, b binary, sums array<long>"

    def answers(rows: list[tuple]) -> pa.Table:
        kinds = {"block": pa.int32(), "kind": pa.int32(), "bucket": pa.int32(), "a": pa.binary(), "b": pa.binary(), "sums": pa.list_(pa.int64())}
        return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(kinds.items())})

    def send_words(f: pa.Table) -> pa.Table:
        b, block = Block(f), f["block"][0].as_py()
        cuts = b.cuts(n)
        used = [k for k in range(n) if cuts[k] < cuts[k + 1]]
        return pa.table({"bucket": pa.array(used, pa.int32()), "block": pa.array([block] * len(used), pa.int32()),
                         "words": pa.array([packed_up(b.words[cuts[k]:cuts[k + 1]]) for k in used], pa.binary()),
                         "counts": pa.array([pack(b.counts[cuts[k]:cuts[k + 1]]) for k in used], pa.binary())})

    def gathered(f: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[slice]]:
        """The bucket's distinct words, their counts, the rank of each entry, each row's entries."""
        words = [unpacked_up(x).view(np.uint64) for x in f["words"].to_pylist()]
        ends = np.cumsum([len(x) for x in words])
        distinct, rank = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.concatenate([unpack(x) for x in f["counts"].to_pylist()])
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, rank, counts)
        return distinct, total, rank, [slice(e - len(x), e) for e, x in zip(ends, words)]

    def answer_words(f: pa.Table) -> pa.Table:
        distinct, total, rank, parts = gathered(f)
        out = [(block, WORDS, bucket, pack(total[rank[p]]), packed_up(rank[p]), None) for block, bucket, p in zip(f["block"].to_pylist(), f["bucket"].to_pylist(), parts)]
        c = total[distinct != START]
        return answers(out + [(None, TOTALS, WORDS, None, None, [int(c.sum()), int((c > 0).sum()), *_of_counts(c)])])

    def send_pairs(f: pa.Table, known: pa.Table) -> pa.Table:
        b, block = Block(f), f["block"][0].as_py()
        b.learn(known, n)
        seen = np.bincount(b.pair[b.trained], minlength=len(b.h))
        rows = []
        for k in range(n):
            p = b.order[b.pair_cuts[k]:b.pair_cuts[k + 1]]
            if len(p):
                rows.append((k, block, packed_up(b.id[b.h[p]]), pack(b.id[b.w[p]]), pack(seen[p]), pack(b.count[b.w[p]])))
        cols = ("to", "block", "h", "w", "seen", "count")
        return pa.table({c: pa.array([r[i] for r in rows], pa.int32() if i < 2 else pa.binary()) for i, c in enumerate(cols)})

    def answer_pairs(f: pa.Table) -> pa.Table:
        hs = [unpacked_up(x) for x in f["h"].to_pylist()]
        ends = np.cumsum([len(x) for x in hs])
        h = np.concatenate(hs)
        w, seen, count = (np.concatenate([unpack(x) for x in f[c].to_pylist()]) for c in ("w", "seen", "count"))
        order = np.lexsort((w, h))
        first = np.r_[True, (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)]
        group = np.empty(len(h), np.int64)
        group[order] = np.cumsum(first) - 1
        total = np.zeros(group.max() + 1, np.int64)
        np.add.at(total, group, seen)
        out = [(block, PAIRS, bucket, pack(total[group[e - len(x):e]]), None, None) for block, bucket, e, x in zip(f["block"].to_pylist(), f["to"].to_pylist(), ends, hs)]
        out.append((None, TOTALS, PAIRS, None, None, _of_counts(total)))
        h, own = h[order][first][total > 0], count[order][first][total > 0]
        total = total[total > 0]
        heads, at = np.unique(h, return_inverse=True)
        sums = np.zeros((len(heads), SUMS), np.int64)
        for c, col in ((total, 0), (own, CUT + 1)):
            small = c <= CUT
            np.add.at(sums, (at[small], col + c[small] - 1), 1)
            np.add.at(sums, (at[~small], col + CUT), c[~small])
        for bucket in np.unique(heads % n).tolist():
            mine = heads % n == bucket
            out.append((None, HISTORY, bucket, packed_up(heads[mine] // n), pack(sums[mine].T.ravel()), None))
        return answers(out)

    def answer_histories(f: pa.Table, told: pa.Table) -> pa.Table:
        """Sums what pair buckets told; their totals, all sent to one place, are summed and passed on."""
        out, heads, given = [], [], []
        for kind, a, b, c in zip(*(told[c].to_pylist() for c in ("kind", "a", "b", "sums"))):
            if kind == TOTALS:
                given.append(c)
            else:
                heads.append((unpacked_up(a), unpack(b).reshape(SUMS, -1).T))
        if given:
            out.append((None, TOTALS, PAIRS, None, None, np.sum(given, 0).tolist()))
        if len(f):
            distinct, _, rank, parts = gathered(f)
            sums = np.zeros((len(distinct), SUMS), np.int64)
            for at, x in heads:
                sums[at] += x
            out += [(block, HISTORY, bucket, pack(sums[rank[p]].T.ravel()), None, None) for block, bucket, p in zip(f["block"].to_pylist(), f["bucket"].to_pylist(), parts)]
        return answers(out)

    def score(f: pa.Table, known: pa.Table) -> pa.Table:
        b = Block(f)
        b.learn(known, n)
        cuts = b.cuts(n)
        sums, seen = np.zeros((len(b.words), SUMS), np.int64), np.zeros(len(b.h), np.int64)
        totals = np.zeros(CUT + 3, np.int64)
        pair_totals = np.zeros(CUT + 1, np.int64)
        for kind, bucket, a, c in zip(*(known[c].to_pylist() for c in ("kind", "bucket", "a", "sums"))):
            if kind == HISTORY:
                sums[cuts[bucket]:cuts[bucket + 1]] = unpack(a).reshape(SUMS, -1).T
            elif kind == PAIRS:
                seen[b.order[b.pair_cuts[bucket]:b.pair_cuts[bucket + 1]]] = unpack(a)
            elif kind == TOTALS and bucket == WORDS:
                totals += c
            elif kind == TOTALS:
                pair_totals += c
        tokens, distinct = int(totals[0]), int(totals[1])
        dw, dp = discounts(totals[2:].tolist()), discounts(pair_totals.tolist())
        whole = np.array([[*totals[2:2 + CUT], tokens - totals[2:2 + CUT] @ np.arange(1, CUT + 1)]])
        given = masses(whole, dw)[0][0]
        all_words = tokens + (given >= tokens)  # no mass left: one occurrence for words not seen
        low = np.where(b.count > 0, shares(b.count, dw, all_words), 1 - given / max(all_words, 1))
        kept, pairs = masses(sums[:, :CUT + 1], dp)
        pairs_plus = pairs + (kept >= pairs)
        covered = masses(sums[:, CUT + 1:], dw)[0] / max(all_words, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            alpha = np.where(pairs > 0, (1 - kept / pairs_plus) / (1 - covered), 1.0)
            p = np.where(seen > 0, shares(seen, dp, pairs_plus[b.h]), alpha[b.h] * low[b.w])
            logs = np.log10(p)[b.pair]
        base = np.log10((b.count + 0.5) / (tokens + 0.5 * (distinct + 1)))[b.token]
        add = lambda x: np.bincount(b.doc, x, len(b.held_out))
        return pa.table({"doc_id": f["doc_id"], "held_out": pa.array(b.held_out), "n_tokens": pa.array(np.bincount(b.doc, minlength=len(b.held_out))),
                         "n_known": pa.array(add(b.count[b.token] > 0).astype(np.int64)), "train_tokens": pa.array(np.full(len(b.held_out), tokens)),
                         "base_score": pa.array(add(base)), "score": pa.array(add(logs))})

    sent = blocks.groupBy("block").applyInArrow(send_words, "bucket int, block int, words binary, counts binary")
    word_answers = sent.groupBy("bucket").applyInArrow(answer_words, answer)
    to_blocks = word_answers.where("block IS NOT NULL")
    pairs = blocks.groupBy("block").cogroup(to_blocks.groupBy("block")).applyInArrow(send_pairs, "to int, block int, h binary, w binary, seen binary, count binary")
    pair_answers = pairs.groupBy("to").applyInArrow(answer_pairs, answer)
    told = pair_answers.where(F.col("kind") != PAIRS)
    histories = sent.groupBy("bucket").cogroup(told.groupBy("bucket")).applyInArrow(answer_histories, answer)
    totals = word_answers.where("block IS NULL").unionByName(histories.where("block IS NULL"))
    # Every block needs the sums over all buckets, a few numbers per table.
    summed = totals.select("bucket", F.posexplode("sums").alias("at", "x")).groupBy("bucket", "at").agg(F.sum("x").alias("x"))
    listed = summed.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("s"))
    none = F.lit(None).cast("binary")
    everywhere = listed.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), F.lit(TOTALS).alias("kind"), "bucket", none.alias("a"), none.alias("b"),
                               F.col("s.x").alias("sums"))
    known = to_blocks.unionByName(pair_answers.where(F.col("kind") == PAIRS)).unionByName(histories.where("block IS NOT NULL")).unionByName(everywhere)
    kind = docs.schema[id_col].dataType.simpleString()
    out = blocks.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out

