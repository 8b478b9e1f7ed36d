from math import exp, log

import numpy as np
import pytest

from recsift.llm import queries, soft_mixing
from recsift.llm.soft_mixing import DOMAINS, TARGETS
from tests.llm.brute import WORD, lower
from tests.llm.test_importance import plain_cells

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def result(spark):
    return queries.QUERIES["op1_soft_mixing"](spark, SF).toPandas()


def test_totals_match_targets(result):
    p = result[[f"p_{d}" for d in DOMAINS]].to_numpy()
    n, r = result.tokens.to_numpy(float), result.rate.to_numpy()
    assert len(result) == 1000 and (r >= 0).all() and np.allclose(p.sum(1), 1)
    assert np.allclose((r * n) @ p / n.sum(), [TARGETS[d] for d in DOMAINS], atol=1e-6)


def test_posteriors_follow_labels(result):
    import duckdb
    got = duckdb.sql(f"SELECT quality, toxic, p_clean, p_low, p_toxic FROM result JOIN '{SF}/labels.parquet' USING (doc_id)").fetchall()
    right = [max(DOMAINS, key=lambda d: dict(zip(DOMAINS, r[2:]))[d]) == ("toxic" if r[1] else "clean" if r[0] else "low") for r in got]
    assert np.mean(right) > 0.85


def test_targets_that_push_rates_to_zero(spark):
    g = np.random.default_rng(0)
    p = g.dirichlet([0.2] * 3, 400)
    n = g.integers(0, 500, 400)
    rows = [(i, int(n[i]), *map(float, p[i])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, p_clean double, p_low double, p_toxic double")
    share = {"clean": 0.9, "low": 0.08, "toxic": 0.02}
    got = soft_mixing.with_rates(df, soft_mixing.fit_rates(df, share)).orderBy("doc_id").toPandas().rate.to_numpy()
    assert (got >= 0).all() and (got == 0).any()
    gap = np.abs((got * n) @ p / n.sum() - [share[d] for d in DOMAINS]).max()
    assert gap < 1e-6


def test_edge_rows(spark):
    d = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (2, None, "y"), (None, "d", "y"), (3, "w " * 60_000, "z")], "doc_id long, text string, tokens string")
    lab = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = soft_mixing.mix(d, lab).collect()
    assert len(got) == 5 and sorted(r.tokens for r in got) == [0, 1, 3, 3, 60_000] and all(r.rate >= 0 for r in got)
    assert {r.doc_id for r in got if r.rate == got[0].rate} >= {got[0].doc_id}
    assert len(soft_mixing.mix(d, lab.limit(0)).collect()) == 5
    assert soft_mixing.mix(d.limit(0), lab).collect() == []


def best(p, n, rate, share, most=soft_mixing.MAX_RATE, atol=1e-6):
    """Whether no rates from 0 to ``most`` bring the totals nearer to ``share``: the optimum's conditions, row by row."""
    if not ((rate >= 0) & (rate <= most)).all():
        return False
    slope = p[n > 0] @ ((rate * n) @ p / n.sum() - share)
    own = rate[n > 0]
    return slope[own == 0].min(initial=0) > -atol and slope[own == most].max(initial=0) < atol and np.abs(slope[(own > 0) & (own < most)]).max(initial=0) < atol


def fitted(spark, p, n, share=None, most=soft_mixing.MAX_RATE):
    df = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(len(n))], "doc_id long, tokens long, p_clean double, p_low double, p_toxic double")
    return soft_mixing.with_rates(df, soft_mixing.fit_rates(df, share, most)).orderBy("doc_id").toPandas().rate.to_numpy()


def test_reachable_targets_far_from_the_input_are_met(spark):
    g = np.random.default_rng(1)
    p, n = g.dirichlet([1.0] * 3, 5000), g.integers(0, 500, 5000)
    rate = fitted(spark, p, n)
    assert (rate >= 0).all() and np.allclose((rate * n) @ p / n.sum(), [TARGETS[d] for d in DOMAINS], atol=1e-6)


@pytest.mark.parametrize("floor", [[0.2, 0.5, 0.3], [0.0, 1.0, 0.0]])
def test_unreachable_targets_give_the_least_squared_error(spark, floor):
    g = np.random.default_rng(2)
    p, n = 0.6 * g.dirichlet([1.0] * 3, 300) + 0.4 * np.array(floor), g.integers(1, 500, 300)
    rate = fitted(spark, p, n)
    share = np.array([TARGETS[d] for d in DOMAINS])
    assert np.abs((rate * n) @ p / n.sum() - share).max() > 0.01 and best(p, n, rate, share)
    assert not best(p, n, np.ones(300), share)


def test_prior_counts_only_labels_of_rows_in_the_input(spark):
    d = spark.createDataFrame([(i, f"word{i % 5} and more") for i in range(60)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, int(i < 60), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    prior = soft_mixing.classifier(d, lab).prior
    assert prior[0] > 0.9 and prior[1] == prior[2] and np.isclose(prior.sum(), 1)


def test_rates_end_at_the_bound(spark):
    g = np.random.default_rng(3)
    p, n = g.dirichlet([1.0] * 3, 400), g.integers(1, 500, 400)
    rate = fitted(spark, p, n, {"clean": 0.95, "low": 0.04, "toxic": 0.01}, 3.0)
    assert (rate == 3.0).any() and (rate == 0.0).any() and best(p, n, rate, np.array([0.95, 0.04, 0.01]), 3.0)


def document_by_document(p, n, share, most, steps):
    """Plain projected gradient over the documents' rates, without momentum and without posteriors in common."""
    rate = np.ones(len(n))
    size = 1 / np.linalg.eigvalsh((p * (n / n.sum())[:, None]).T @ p)[-1]
    for _ in range(steps):
        rate = np.clip(rate - size * (p @ ((rate * n) @ p / n.sum() - share)), 0, most)
    return rate


def test_rates_against_steps_document_by_document(result):
    p, n = result[[f"p_{d}" for d in DOMAINS]].to_numpy(), result.tokens.to_numpy(float)
    share = np.array([TARGETS[d] for d in DOMAINS])
    slow = document_by_document(p, n, share, soft_mixing.MAX_RATE, 20_000)
    assert np.abs((slow * n) @ p / n.sum() - share).max() < 1e-6  # both meet the targets,
    assert np.abs(slow - result.rate.to_numpy()).max() < 0.05  # and neither goes farther from rate 1 than the steps took it


def plain_posterior(model, text):
    """The classifier's answer for one text, word by word; not on the grid."""
    cells = plain_cells(text)
    n = len(WORD.findall(lower(text)))
    score, told = [sum(float(t[c]) for c in cells) for t in model.tables], [sum(float(e[c]) for c in cells) for e in model.evidence]
    x = [(score[k] - score[0]) / max(n, 1) ** 0.5 for k in (1, 2)] + [(e / max(n, 1)) ** 0.5 for e in told] + [log(max(n, 1))]
    z = [log(q) + w[0] + sum(v * (a - c) / s for v, a, c, s in zip(w[1:], x, model.centre, model.spread)) for q, w in zip(model.prior, model.weights)]
    e = [exp(v - max(z)) for v in z]
    return [v / sum(e) for v in e] if n else list(model.prior)


def test_posteriors_against_one_text_at_a_time(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = soft_mixing.classifier(docs, labels)
    few = docs.where("doc_id < 25").collect()
    got = {r.doc_id: r for r in soft_mixing.memberships(docs, model).where("doc_id < 25").collect()}
    for d in few:
        own = np.array([got[d.doc_id][f"p_{k}"] for k in DOMAINS])
        assert np.abs(own - plain_posterior(model, d.text)).max() < 1.01 / soft_mixing.GRID and np.isclose(own.sum(), 1)


def test_grid_keeps_sums_and_stays_near():
    p = np.random.default_rng(0).dirichlet([0.3] * 3, 5000)
    q = soft_mixing.on_grid(p)
    assert np.allclose(q.sum(1), 1) and (q >= 0).all() and np.abs(p - q).max() < 1 / soft_mixing.GRID
    rest = q[np.arange(3)[None, :] != p.argmax(1)[:, None]]
    assert np.isin(rest, soft_mixing.LEVELS).all() and len(np.unique(q, axis=0)) <= soft_mixing.CELLS
    small = (p < 1 / soft_mixing.GRID) & (p > 1e-5)  # small posteriors are told apart, not rounded to zero
    assert small.sum() > 500 and np.abs(q[small] / p[small] - 1).max() < 0.1


def test_rare_domains_are_shifted_as_well(spark):
    g = np.random.default_rng(4)
    rare = 10.0 ** g.uniform(-5, -3, (2000, 2))
    p, n = soft_mixing.on_grid(np.c_[1 - rare.sum(1), rare]), g.integers(1, 500, 2000)
    df = spark.createDataFrame([(i, int(n[i]), *map(float, p[i])) for i in range(2000)], "doc_id long, tokens long, p_clean double, p_low double, p_toxic double")
    share = soft_mixing.shifted(df, {"low": 0.5, "toxic": 0.5})
    rate = soft_mixing.with_rates(df, soft_mixing.fit_rates(df, share, 4.0, even=True)).orderBy("doc_id").toPandas().rate.to_numpy()
    want = np.array([share[d] for d in DOMAINS])
    assert np.abs(((rate * n) @ p / n.sum()) / want - 1).max() < 1e-6 and (rate >= 0).all() and (rate <= 4).all() and (rate > 0).mean() > 0.5


def test_recall_of_every_domain_on_labels_never_seen(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    unseen = labels.where("pmod(xxhash64(doc_id, 99), 5) = 0")
    model = soft_mixing.classifier(docs, labels.join(unseen, "doc_id", "left_anti"))
    got = soft_mixing.memberships(docs, model).join(unseen, "doc_id").toPandas()
    truth = np.where(got.toxic == 1, 2, np.where(got.quality == 1, 0, 1))
    top = got[[f"p_{d}" for d in DOMAINS]].to_numpy().argmax(1)
    recall = [(top[truth == k] == k).mean() for k in range(3)]
    assert min(np.bincount(truth)) > 50 and recall[0] > 0.95 and recall[1] > 0.7 and recall[2] >= 0.8, recall


def test_attained_shares(spark):
    rows = [(1, 10, 1.0, 0.0, 0.0, 2.0), (2, 30, 0.5, 0.5, 0.0, 0.0), (3, 0, 0.2, 0.2, 0.6, 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, p_clean double, p_low double, p_toxic double, rate double")
    assert {r.domain: (r.input_share, r.share) for r in soft_mixing.attained(df).collect()} == {"clean": (25 / 40, 20 / 40), "low": (15 / 40, 0.0), "toxic": (0.0, 0.0)}
    assert soft_mixing.attained(df.limit(0)).collect() == []
    assert soft_mixing.shifted(df, {"low": 0.5}) == {"clean": 1 - 7.5 / 40, "low": 7.5 / 40, "toxic": 0.0}
