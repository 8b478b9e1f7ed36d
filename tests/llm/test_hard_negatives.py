import numpy as np
import pytest
from pyspark.sql import functions as F

from recsift.llm import hard_negatives as hn
from tests.llm.test_pivot_search import whole

KIND = "vec_id long, embedding array<double>, label int"


def expected(rows, every, k=5, low=80, high=100):
    parts = {}
    for r in rows:
        if r[2] is not None:
            parts.setdefault(r[2], []).append(r)
    most = max((len(r[1]) for r in rows if r[1] is not None), default=0)
    own = sorted({(i, v + (0,) * (most - len(v)), label) for label, part in parts.items() for i, v in whole(part, 256)})
    out = []
    for i, v, label in own:
        if i % every == 0:
            near = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in own if (j, w, other) != (i, v, label))
            for ps, p, _ in [x for x in near if x[2] == label][:k]:
                band = [(s, j) for s, j, other in near if other != label and low * -ps <= 100 * -s <= high * -ps][:k]
                out += [(i, p, r, j, -ps, -s) for r, (s, j) in enumerate(band, 1)]
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_tables_and_planes_give_inner_products():
    g = np.random.default_rng(1)
    for dims, top in ((64, 200), (13, 5), (8, 1 << 23), (1, 1), (24, 0)):
        a, x = (g.integers(-top, top + 1, (n, dims)) for n in (7, 50))
        planes = hn.planes_needed(int(x.min()), int(x.max()))
        assert (hn.four_russians(hn.subset_sums(a), hn.packed(x, planes)) == x @ a.T).all()
    assert [hn.planes_needed(*r) for r in ((0, 0), (-1, 0), (-1, 1), (-128, 127), (-129, 0), (0, 128))] == [1, 1, 2, 8, 9, 9]


@pytest.mark.parametrize("sizes", [(16, 3), (4096, 64)])
def test_mining_against_all_pairs(spark, sizes):
    g = np.random.default_rng(2)
    base = g.normal(size=(6, 8))
    rows = [(i, [float(c) for c in base[i % 6] + 0.2 * g.normal(size=8)], int(g.integers(0, 4))) for i in range(500)]
    rows += [(500 + i, rows[10][1], i % 3) for i in range(40)]
    got = hn.hard_negatives(spark.createDataFrame(rows, KIND), F.col("vec_id") % 20 == 0, tile=sizes[0], block=sizes[1])
    assert result(got) == expected(rows, 20) and expected(rows, 20)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.5], 1), (0, [0.5, -0.5], 1), (0, [0.5, -0.5], 2), (1, [0.5, -0.5], 1), (2, [0.5, -0.5], 2), (3, None, 1), (4, [nan], 1), (5, [None], 1), (6, [inf, 1.0], 1),
            (7, [1.0, 1.0], None), (None, [1.0, 1.0], 1), (20, [], 1), (40, [0.0, 0.0, 3.0], 1), (41, [0.1, 0.0, 2.9], 2), (42, [0.1, 0.0, 2.8], 1), (60, [-1.0], 3), (61, [1.0], 3)]
    frame = spark.createDataFrame([(*r, 5, "a") for r in rows], KIND + ", score int, block string")
    assert result(hn.hard_negatives(frame, F.col("vec_id") % 20 == 0)) == expected(rows, 20)
    assert hn.hard_negatives(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    alone = spark.createDataFrame([(20, [1.0], 1)], KIND)
    assert hn.hard_negatives(alone, F.col("vec_id") % 20 == 0).collect() == []


def test_a_hot_vector_and_a_hot_label(spark):
    g = np.random.default_rng(4)
    rows = [(i, [0.3, 0.4] if i % 3 == 0 else [float(x) for x in g.normal(size=2)], 0 if i % 2 else int(g.integers(0, 3))) for i in range(400)]
    got = hn.hard_negatives(spark.createDataFrame(rows, KIND), F.col("vec_id") % 100 == 0, tile=32, block=2)
    assert result(got) == expected(rows, 100)
