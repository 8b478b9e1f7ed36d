import random
from math import comb

import numpy as np
import pytest
import xxhash

from recsift.llm import queries, simhash_gph
from recsift.llm.components import components
from tests.llm.brute import SF, WORD, lower, pairs_within, roots, table


def plain_fingerprint(text):
    w = WORD.findall(lower(text))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def expected(rows):
    fp = [plain_fingerprint(t) for _, t in rows]
    up = roots(set(fp), pairs_within(fp, 3))
    least = {}
    for (i, _), f in zip(rows, fp):
        if i is not None:
            least[up[f]] = min(i, least.get(up[f], i))
    return sorted(((i, f"{f:016x}", least.get(up[f])) for (i, _), f in zip(rows, fp)), key=repr)


def test_query_matches_brute_force(spark):
    got = queries.QUERIES["op9_simhash_near_dedup"](spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == expected(table("documents", "doc_id, text"))


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One Two"), (5, "one\x0btwo"), (6, "x " * 70_000), (6, "x " * 70_000), (None, "one two"),
            (None, "only null ids here, and nothing else"), (9, "non break İ É word")]
    df = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, fp string, root string")
    assert sorted(map(tuple, simhash_gph.near_duplicates(df).collect()), key=repr) == expected(rows)
    assert simhash_gph.near_duplicates(df.limit(0)).collect() == []


@pytest.mark.parametrize("radius,partitions", [(3, 3), (3, 4), (3, 2), (2, 3), (5, 4)])
def test_every_link_is_found(spark, radius, partitions):
    r = random.Random(radius * 10 + partitions)
    base = [r.getrandbits(64) for _ in range(30)] + [0, 2**64 - 1]
    fps = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, radius + 1))) for b in base for _ in range(40)}
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    got = {tuple(x) for x in simhash_gph.links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius, partitions).collect()}
    assert got == pairs_within(signed, radius)


def test_allocation_is_the_cheapest_split():
    r = np.random.default_rng(1)
    cost = np.sort(r.random((200, 3, 5)), axis=2)
    cost[:, :, 0] = 0
    got = simhash_gph.allocate(cost, 1)
    every = [(a, b, 1 - a - b) for a in range(-1, 4) for b in range(-1, 4) if -1 <= 1 - a - b <= 3]
    for row, t in zip(cost, got):
        assert t.sum() == 1
        assert np.isclose(sum(row[i, e + 1] for i, e in enumerate(t)), min(sum(row[i, e + 1] for i, e in enumerate(s)) for s in every))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(8, 40)] + [(5, 5), (3, 1), (1, 3), (None, 4)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == roots({n for e in real for n in e}, real)


def test_number_of_partitions_follows_the_number_of_fingerprints():
    both = np.full((64, 64), 0.25) + np.eye(64) * 0.25  # independent bits
    chosen = []
    for n in (10**3, 10**7, 10**10, 10**17):
        costs = {}
        for m in range(1, 5):
            groups = simhash_gph.group_bits(1, both, m)
            near = [[np.array([[comb(len(s), e) for e in range(4)]] * 2**len(s)) / 2**len(s) for s in simhash_gph._subs(g)] for g in groups]
            costs[m] = simhash_gph.expected_cost(n, groups, near, 3)
        chosen.append(min(costs, key=costs.get))
    assert chosen == sorted(chosen, reverse=True) and chosen[0] == 4 and chosen[2] == 2 and chosen[-1] == 1


@pytest.mark.parametrize("partitions", [1, 2, 4])
def test_links_with_any_number_of_partitions(spark, partitions):
    g = np.random.default_rng(partitions)
    base = g.integers(-2**63, 2**63, 40, dtype=np.int64)
    fps = {int(b) for b in base} | {int(b ^ np.int64(1 << int(i))) for b in base for i in g.integers(0, 63, 3)}
    df = spark.createDataFrame([(x,) for x in sorted(fps)], "fp long")
    got = {(r.u, r.v) for r in simhash_gph.links(df, 3, partitions).collect()}
    assert got == pairs_within(fps, 3)
