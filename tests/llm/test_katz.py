import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pytest

from recsift.llm import katz, queries
from tests.llm.brute import SF, WORD, lower, table


class Plain:
    """The same model in plain dictionaries."""

    def __init__(self, rows):
        self.uni, self.bi = Counter(), defaultdict(Counter)
        for i, t in rows:
            if zlib.crc32(str("" if i is None else i).encode()) % 5 != 1:
                prev = "<s>"
                for w in self.tokens(t):
                    self.uni[w] += 1
                    self.bi[prev][w] += 1
                    prev = w
        self.n, self.v = sum(self.uni.values()), len(self.uni)
        of = lambda cs: [sum(c == r for c in cs) for r in range(1, 7)]
        self.d1 = katz.discounts(of(list(self.uni.values())))
        self.d2 = katz.discounts(of([c for f in self.bi.values() for c in f.values()]))
        got = sum(self.d1[min(c, 6)] * c for c in self.uni.values())
        self.total = self.n + (got >= self.n)
        self.rest = 1 - got / max(self.total, 1)

    @staticmethod
    def tokens(t):
        return WORD.findall(lower(t)) + ["</s>"]

    def low(self, w):
        c = self.uni[w] if w in self.uni else 0
        return self.d1[min(c, 6)] * c / self.total if c else self.rest

    def p(self, w, h):
        f = self.bi.get(h)
        if not f:
            return self.low(w)
        got = sum(self.d2[min(c, 6)] * c for c in f.values())
        total = sum(f.values())
        total += got >= total
        if w in f:
            return self.d2[min(f[w], 6)] * f[w] / total
        return (1 - got / total) / (1 - sum(self.low(x) for x in f)) * self.low(w)

    def row(self, i, t):
        ts = self.tokens(t)
        return (str(i), zlib.crc32(str("" if i is None else i).encode()) % 5 == 1, len(ts), sum(w in self.uni for w in ts), self.n,
                sum(log10((self.uni.get(w, 0) + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in ts), sum(log10(self.p(w, h)) for h, w in zip(["<s>"] + ts, ts)))


def compared(got, rows):
    m = Plain(rows)
    want = sorted(m.row(i, t) for i, t in rows)
    own = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    assert [x[:5] for x in own] == [x[:5] for x in want]
    assert np.allclose([x[5:] for x in own], [x[5:] for x in want], rtol=1e-9)
    return m


def test_query_matches_brute_force(spark):
    got = queries.QUERIES["op10_katz"](spark, SF).collect()
    m = compared(got, table("documents", "doc_id, text"))
    for h in ["<s>", "the", "of", "no such word", *list(m.bi)[:40]]:  # exactly normalised, the unseen word included
        assert sum(m.p(w, h) for w in m.uni) + m.p("no such word", h) == pytest.approx(1, abs=1e-9)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("split", [3, 1 << 16])
def test_edge_rows(spark, monkeypatch, split):
    monkeypatch.setattr(katz, "SPLIT", split)  # small: pairs of nearly every history are dealt over buckets
    rows = [(0, None), (1, ""), (2, "The the THE cat"), (3, "a b a b a c\x0b\n"), (4, "é É"), (4, "é É"), (None, "no id"), (None, None), (7, "w x " * 30_000), (8, "unseen words only here")]
    rows += [(k, f"the cat sat on w{k % 7} the mat") for k in range(20, 60)]
    df = spark.createDataFrame([x + ("c", 1) for x in rows], "doc_id long, text string, words string, block int")
    compared(katz.katz_scores(df).collect(), rows)
    assert katz.katz_scores(df.limit(0)).collect() == []


def test_packing():
    x = np.array([0, -1, 2**62, 5, 2**40], np.int64)
    assert katz.unpack(katz.pack(x)).tolist() == x.tolist()
    u = np.sort(np.random.default_rng(0).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (katz.unpacked_up(katz.packed_up(u)).view(np.uint64) == u).all()
    assert len(katz.unpack(katz.pack(x[:0]))) == 0
