from collections import Counter
from math import log

import numpy as np
import pyarrow as pa
import pytest

from recsift.llm import importance, queries
from recsift.llm.word_hash import batches_of_words
from tests.llm.brute import WORD, lower, table

M = 2**64 - 1


def mix(h):
    for _ in range(2):
        h = ((h ^ h >> 32) * 0xD6E8FEB86659FD93) & M
    return h ^ h >> 32


def plain_hash(word):
    h = 0
    for k, b in enumerate(word.encode()):
        h = (h + (b + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64)) & M
    return mix(h)


def plain_cells(text):
    ws = WORD.findall(lower(text))
    hs = [plain_hash(w) for w in ws]
    heads = [0] * len(ws)
    for i, w in enumerate(ws):
        h = 0
        for k, b in enumerate(w.encode()[:4]):
            h = (h + (b + 1) * pow(0x9E3779B97F4A7C15, k, 1 << 64)) & M
        heads[i] = mix(h)
    ps = [mix((a * 0x9E3779B97F4A7C15 + b) & M) for a, b in zip(hs, hs[1:])]
    out, at = [], 0
    for xs, (buckets, _) in zip((hs, heads, ps), importance.TABLES):
        out += [x % buckets + at for x in xs]
        at += buckets
    return out


TEXTS = ["Hello World hello", None, "", " \n", "world", "a  b\thello ", "é É É", "x" * 70 + " world\x0bEnd", "w " * 50_000]


@pytest.mark.parametrize("chunk", [1, 20, 1 << 21])
def test_word_hashes(monkeypatch, chunk):
    from recsift.llm import word_hash
    monkeypatch.setattr(word_hash, "CHUNK", chunk)
    got = [[] for _ in TEXTS]
    for first, last, h, _, rows in batches_of_words(pa.array(["skipped"] + TEXTS).slice(1)):
        for x, r in zip(h, rows):
            got[first + r].append(int(x))
    assert got == [[plain_hash(w) for w in WORD.findall(lower(t))] for t in TEXTS]


def test_weights_match_brute_force(spark):
    docs = table("documents", "doc_id, text")[:60] + list(enumerate(TEXTS, 1000)) + [(None, "null id text"), (3, "again the same id")]
    labels = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(50)] + [(1000, 1, 0), (None, 1, 0), (4, None, None), (5, 1, None), (5, 0, 0)]
    d = spark.createDataFrame([x + ("c",) for x in docs], "doc_id long, text string, cell string")
    lab = spark.createDataFrame([x + ("c",) for x in labels], "doc_id long, quality int, toxic int, id string")
    known = importance.labelled(lab)
    target = set(known["id"][known["good"] & ~known["held_out"]].tolist())
    assert target <= {i for i, q, t in labels if q == 1} and 5 not in target and 7 not in target and len(target) > 10
    raw, tgt = Counter(), Counter()
    for i, t in docs:
        c = plain_cells(t)
        raw.update(c)
        if i in target:
            tgt.update(c)
    ratio, lo = {}, 0
    for buckets, prior in importance.TABLES:
        scale = sum(v for c, v in tgt.items() if lo <= c < lo + buckets) / sum(v for c, v in raw.items() if lo <= c < lo + buckets)
        ratio |= {c: log((tgt[c] + prior) / (v * scale + prior)) for c, v in raw.items() if lo <= c < lo + buckets}
        lo += buckets
    want = sorted((str(i), len(WORD.findall(t or "")), round(sum(ratio[c] for c in plain_cells(t)), 2)) for i, t in docs)
    for k in (None, 10, 0, 10_000):
        got = importance.resample(d, lab, k=k).collect()
        own = sorted((str(r.doc_id), r.n_words, r.log_weight) for r in got)
        assert [x[:2] for x in own] == [x[:2] for x in want]
        assert np.allclose([x[2] for x in own], [x[2] for x in want], rtol=1e-4, atol=0.02)
        if k is not None:
            best = sorted((r.gumbel_key for r in got), reverse=True)[:k]
            assert sorted((r.gumbel_key for r in got if r.kept), reverse=True) == best


def test_no_labels_and_no_rows(spark):
    d = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.log_weight, r.kept) for r in importance.resample(d, none).collect()] == [(0.0, True)] * 2
    assert importance.resample(d.limit(0), none).collect() == []


def test_query_keeps_good_and_rejects_low_text(spark):
    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id: r.kept for r in queries.QUERIES["op5_importance"](spark, sf).collect()}
    import duckdb
    rows = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{sf}/labels.parquet'").fetchall()
    share = lambda ids: np.mean([kept[i] for i in ids])
    assert share([i for i, q, t in rows if q and not t]) > 0.95
    assert share([i for i, q, t in rows if not q]) < 0.15


def test_toxic_text_is_rejected_at_any_length(spark):
    import duckdb
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: (r.kept, r.n_words) for r in queries.QUERIES["op5_importance"](spark, sf).collect()}
    rows = duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{sf}/labels.parquet'").fetchall()
    known = importance.labelled(spark.read.parquet(f"{sf}/labels.parquet"))
    unseen = set(known["id"][known["held_out"]].tolist())
    share = lambda ids: np.mean([got[i][0] for i in ids])
    toxic, good = [i for i, q, t in rows if t], [i for i, q, t in rows if q and not t]
    assert share(toxic) < 0.03 and share([i for i in toxic if i in unseen]) < 0.05 and share([i for i in toxic if got[i][1] > 1000]) < 0.05
    assert share(good) > 0.97 and share([i for i in good if i in unseen]) > 0.95 and share([i for i in good if got[i][1] > 1000]) > 0.97
    assert share([i for i, q, t in rows if not q]) < 0.03


def test_query_draws_the_largest_keys_below_the_limit(spark):
    got = queries.QUERIES["op5_importance"](spark, "/root/testdata/sf0.01").collect()
    allowed = sorted((r.draw_key for r in got if r.draw_key > -importance.LAST / 2), reverse=True)
    kept = sorted((r.draw_key for r in got if r.kept), reverse=True)
    assert 0 < len(kept) < len(allowed) <= len(got) and kept == allowed[:len(kept)]
    for r in got[:50]:
        noise = importance.gumbel(pa.array([r.doc_id]), 7)[0]
        low = importance.LAST if r.draw_key < -importance.LAST / 2 else 0
        assert r.draw_key == pytest.approx(r.log_weight / max(r.n_words, 1) ** 0.5 + importance.TEMPER * noise - low, abs=1e-6)


def test_toxic_limit():
    limit = lambda good, toxic, keep=0.5: importance.toxic_limit(np.array(good), np.array(toxic), keep)
    assert limit([0.0, 0.0, 0.1], [0.1, 0.1, 0.5]) == pytest.approx(0.05)
    assert limit([0.0, 0.0, 0.1], [0.1, 0.1, 0.5], 0.98) == pytest.approx(0.3)
    assert limit([0.0, 0.1], [0.3]) == pytest.approx(0.2)
    assert limit([0.0] * 3, [0.0] * 2) == limit([0.0] * 3, []) == limit([], [0.1]) == np.inf


def test_toxic_rows_are_drawn_last(spark):
    plain = [(i, " ".join(f"w{(i * 7 + j) % 40}" for j in range(60))) for i in range(200)]
    docs = [(i, t + " vile scum trash" if i % 4 == 0 else t) for i, t in plain]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in docs if i < 160], "doc_id long, quality int, toxic int")
    assert {r.doc_id for r in importance.resample(d, lab, k=150).collect() if r.kept} == {i for i, _ in docs if i % 4}
    assert not any(r.kept for r in importance.resample(d, lab).collect() if r.doc_id % 4 == 0)


def test_gumbel_noise_is_standard():
    g = importance.gumbel(pa.array(range(20_000)), 3)
    assert abs(g.mean() - 0.5772) < 0.05 and abs(g.std() - np.pi / 6**0.5) < 0.05
