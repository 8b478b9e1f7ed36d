import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recsift.llm import pivot_search
from recsift.llm.vectors import scaled

KIND = "vec_id long, embedding array<double>"


def whole(rows, scale=64):
    """Distinct rows that take part, as integers of equal length."""
    kept = {(r[0], tuple(math.floor(scale * x) for x in r[1])) for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])}
    most = max((len(v) for _, v in kept), default=0)
    return sorted((i, v + (0,) * (most - len(v))) for i, v in kept)


def expected(rows, every, k):
    own = whole(rows)
    out = []
    for i, v in own:
        if i % every == 0:
            others = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in own if (j, w) != (i, v))[:k]
            out += [(i, r, j, -s) for r, (s, j) in enumerate(others, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def clustered(n=700, dims=16, seed=3):
    g = np.random.default_rng(seed)
    centre = g.normal(size=(12, dims))
    x = centre[g.integers(0, 12, n)] + 0.05 * g.normal(size=(n, dims))
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


@pytest.mark.parametrize("sizes", [(8, 16, 8), (64, 1024, 256)])
def test_search_against_all_pairs(spark, sizes):
    rows = clustered()
    rows += [(700 + i, rows[3][1]) for i in range(60)]  # ties beyond k
    pivots, tile, block = sizes
    got = pivot_search.search(spark.createDataFrame(rows, KIND), F.col("vec_id") % 20 == 0, 20, pivots=pivots, tile=tile, block=block)
    assert result(got) == expected(rows, 20, 20)


def test_bounds_spare_annuli_of_clustered_vectors(spark, monkeypatch):
    seen = []
    score = pivot_search._scored
    monkeypatch.setattr(pivot_search, "_scored", lambda cells, *a: (seen.append(cells.count()), score(cells, *a))[1])
    rows = clustered(1500, 32)
    got = pivot_search.search(spark.createDataFrame(rows, KIND), F.col("vec_id") % 20 == 0, 5, pivots=12, tile=16, block=4)
    assert result(got) == expected(rows, 20, 5)
    index = pivot_search.build_index(scaled(spark.createDataFrame(rows, KIND), 64, "vec_id", "embedding"), 32, 12, tile=16).tiles.count()
    assert sum(seen) < 0.7 * index * (75 / 4)  # of all blocks and annuli


def test_bound_holds_for_every_row(spark):
    rows = spark.createDataFrame(clustered(300), KIND)
    own = scaled(rows, 64, "vec_id", "embedding").cache()
    index = pivot_search.build_index(own, 16, 8, tile=10)
    x = {r.vec_id: np.array(r.v, np.int64) for r in own.collect()}
    for t in index.tiles.collect():
        centre, ids = index.pivots[t.pivot], np.frombuffer(t.ids, np.int64)
        far = [int(((x[i] - centre) ** 2).sum()) for i in ids]
        assert far == sorted(far) and (far[0], far[-1]) == (t.inner, t.outer) and t.top == max(int((x[i] ** 2).sum()) for i in ids)
        for q in list(x.values())[::37]:
            d = math.sqrt(((q - centre) ** 2).sum())
            gap = max(0, d - math.sqrt(t.outer), math.sqrt(t.inner) - d)
            assert max(int(q @ x[i]) for i in ids) <= (int(q @ q) + t.top - gap * gap) / 2 + 1
    assert sorted(i for t in index.tiles.collect() for i in np.frombuffer(t.ids, np.int64)) == list(range(300))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5]), (0, [0.5, -0.5]), (0, [0.25, 0.25]), (1, [0.5, -0.5]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (20, [inf, 0.0]), (None, [1.0, 1.0]),
            (40, []), (60, [1.0]), (-20, [0.0, 2.0, 1.0]), (7, [-0.001, 0.0])]
    frame = spark.createDataFrame([(*r, 5, "a") for r in rows], KIND + ", score int, block string")
    assert result(pivot_search.search(frame, F.col("vec_id") % 20 == 0, 3)) == expected(rows, 20, 3)
    assert result(pivot_search.search(frame, F.col("vec_id") % 20 == 0, 50)) == expected(rows, 20, 50)
    assert pivot_search.search(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    one = spark.createDataFrame([(20, [1.0])], KIND)
    assert pivot_search.search(one, F.col("vec_id") % 20 == 0).collect() == []


def test_one_vector_held_by_a_third_of_the_rows_and_long_components(spark):
    g = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [float(x) for x in g.normal(size=3)]) for i in range(600)] + [(600 + i, [3e4 * i, -1e5, 3.0]) for i in range(5)]
    got = pivot_search.search(spark.createDataFrame(rows, KIND), F.col("vec_id") % 20 == 0, 20, tile=32)
    assert result(got) == expected(rows, 20, 20)
