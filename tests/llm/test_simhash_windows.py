import re
from collections import Counter

import pytest

from recsift.llm import queries, simhash_windows
from tests.llm import brute


def ws(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def sim(a, b):
    a, b = Counter(a), Counter(b)
    return sum((a & b).values()) / sum((a | b).values())


def expected(docs, items, least=0.8):
    """Best similarity of any item-sized window, without fingerprints."""
    out = {}
    grams = {}
    for j, t in items:
        w = ws(t)
        k = min(5, len(w))
        if k:
            grams[j] = (k, [tuple(w[i:i + k]) for i in range(len(w) - k + 1)])
    for d, t in docs:
        w = ws(t)
        runs = {k: [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] for k in {k for k, _ in grams.values()}}
        have = {k: set(r) for k, r in runs.items()}
        for j, (k, g) in grams.items():
            if have[k].isdisjoint(g):
                continue
            best = max(((sim(runs[k][s:s + len(g)], g), -s) for s in range(len(runs[k]))), default=(0, 0))
            if best[0] >= least:
                out[d, j] = (round(best[0], 9), -best[1])
    return out


def shown(df):
    return {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in df.collect()}


def test_query_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(brute, "SF", brute.SF.replace("0.001", "0.01"))
    got = queries.QUERIES["op8_simhash_windows"](spark, brute.SF)
    want = expected(brute.table("documents", "doc_id, text"), brute.table("benchmark", "item_id, text"))
    assert shown(got) == want and len(want) > 5


def test_edits_short_items_and_edge_rows(spark):
    base = [f"w{k}" for k in range(200)]
    item = base[20:60]
    swap = lambda at: [("zz" if i in at else w) for i, w in enumerate(item)]
    docs = [(1, " ".join(base)), (2, "x y z " + " ".join(swap({1})) + " tail words here"), (3, " ".join(swap({5, 20, 33}))), (4, " ".join(item[:34])),
            (5, " ".join(item[:20])), (6, " ".join(item[:15] + ["new"] + item[15:])), (7, None), (8, ""), (9, "Alpha, BETA! gamma"), (10, "alpha beta"),
            (11, "one two"), (12, "a b c d e " * 30), (13, "W20" + " ".join(base[21:60]).upper()), (14, "filler " * 60_000 + " ".join(item)), (1, " ".join(base)), (None, " ".join(item))]
    items = [(1, " ".join(item)), (2, "alpha beta gamma"), (3, None), (4, ""), (5, "--- !"), (6, "a b c d e a b c d e a b"), (1, " ".join(item)), (7, "one")]
    d = spark.createDataFrame([x + ("c", 1) for x in docs], "doc_id long, text string, key string, m int")
    b = spark.createDataFrame([x + ("c",) for x in items], "item_id long, text string, run string")
    got = shown(simhash_windows.leaks(d, b))
    assert got == expected(docs, items)
    assert {(1, 1), (2, 1), (4, 1), (9, 2), (12, 6), (11, 7), (14, 1), (None, 1)} <= set(got) and (5, 1) not in got
    assert sorted(r.doc_id for r in simhash_windows.decontaminated(d, b).collect()) == sorted({x[0] for x in docs if x[0]} - {x[0] for x in got})
    assert simhash_windows.leaks(d.limit(0), b).collect() == simhash_windows.leaks(d, b.limit(0)).collect() == []


def test_long_text_in_which_every_position_matches(spark):
    docs, items = [(1, "a b c d e " * 4_000), (2, "a b c d x " * 50)], [(1, "a b c d e a b c d e a b c"), (1, "b c d e a b c"), (2, "a b c d x a b")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = shown(simhash_windows.leaks(d, b))
    assert got == {(1, 1): (1.0, 0), (2, 2): (1.0, 0)}


def test_radius_and_blocks_are_checked(spark):
    d = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    for bad in ({"blocks": 7}, {"radius": 64}, {"radius": -1}):
        with pytest.raises(ValueError):
            simhash_windows.leaks(d, d.withColumnRenamed("doc_id", "item_id"), **bad)
