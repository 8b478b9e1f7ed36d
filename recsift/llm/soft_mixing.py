"""Soft-membership mixing: document rates whose expected token totals per domain match targets.

Domains are what labels say of a document: clean, low (quality) or toxic. A classifier fitted on the
labelled rows gives every document a posterior over the domains: hashed n-gram models tell how much
likelier a text is in a domain, n-grams that are much likelier there than in clean text are weighed by
themselves per word (a few insults hardly move a whole text's sum), and a softmax regression on labelled
rows kept out of the models turns these into probabilities. They are rounded to a grid that is finer near
zero, so that a domain of which little is left still tells documents apart.

Rates r, 0 <= r <= ``MAX_RATE``, minimise the squared error of the expected totals, the sums of r * tokens *
posterior, against the targets, by projected gradient steps from r = 1 with momentum, in the metric of the
tokens. There a step moves a rate by its posterior alone, so documents of one posterior keep one rate:
Spark sums the tokens of each posterior over all documents, a step is a sum over the posteriors, and their
number is bounded by the grid, whatever the number of documents. Documents then take the rate of theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.llm import importance
from recsift.llm.common import staged

DOMAINS = ("clean", "low", "toxic")
POSTERIORS = tuple(f"p_{d}" for d in DOMAINS)
#: Shares of all tokens that the mixture is to have.
TARGETS = {"clean": 0.86, "low": 0.08, "toxic": 0.06}
#: The largest rate: no document is drawn more often, in expectation.
MAX_RATE = 100.0
#: All posteriors of a document but the largest are 0, multiples of 1 / GRID, or, below that, one of FINE levels, each
#: 2 ** (1 / 4) times the one before; the largest is the rest. So there are at most CELLS of them.
GRID, FINE = 500, 40
LEVELS = np.r_[0.0, 2.0 ** (np.arange(-FINE, 0) / 4) / GRID, np.arange(1, GRID // 2 + 1) / GRID]
CELLS = len(DOMAINS) * len(LEVELS) ** (len(DOMAINS) - 1)
#: Steps after which the fit ends in any case; its squared error is then within 8 * MAX_RATE ** 2 / STEPS ** 2 of the least.
STEPS = 200_000
#: Pull of the regression's weights towards zero, that is of the posteriors towards the prior.
RIDGE = 0.1


class Model(NamedTuple):
    """A fitted classifier: log ratios of the n-grams per domain, evidence per domain but the first, a prior, and
    the regression: its features' means and deviations, and a row of weights per domain."""

    tables: np.ndarray
    evidence: np.ndarray
    prior: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray


def evidence(tables: np.ndarray) -> np.ndarray:
    """For every domain but the first, the log ratios to it where they are large, else 0."""
    over = tables[1:] - tables[0]
    return np.where(over >= importance.EVIDENCE, over, 0).astype(np.float32)


def features(tables: np.ndarray, told: np.ndarray, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per text: its features and its number of words."""
    scores, found, words = np.zeros((len(texts), len(tables))), np.zeros((len(texts), len(told))), np.zeros(len(texts), np.int64)
    for first, last, cell, row in importance.cells(texts):
        for k, table in enumerate(tables):
            scores[first:last, k] = np.bincount(row, table[cell], last - first)
        for k, table in enumerate(told):
            found[first:last, k] = np.bincount(row, table[cell], last - first)
        words[first:last] = np.bincount(row[cell < importance.TABLES[0][0]], minlength=last - first)
    n = np.maximum(words, 1)[:, None]
    return np.hstack([(scores[:, 1:] - scores[:, :1]) / np.sqrt(n), np.sqrt(found / n), np.log(n)]), words


def posterior(model: Model, x: np.ndarray) -> np.ndarray:
    """Probabilities of the domains given features."""
    z = np.log(model.prior) + np.hstack([np.ones((len(x), 1)), (x - model.centre) / model.spread]) @ model.weights.T
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def on_grid(p: np.ndarray) -> np.ndarray:
    """Each row with all but its largest entry at the nearest of ``LEVELS``, and that the rest to 1."""
    near = LEVELS[np.searchsorted((LEVELS[:-1] + LEVELS[1:]) / 2, p)]
    top = p.argmax(1)[:, None]
    np.put_along_axis(near, top, 0.0, 1)
    np.put_along_axis(near, top, 1 - near.sum(1, keepdims=True), 1)
    return near


def regression(x: np.ndarray, truth: np.ndarray, prior: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights (domains, 1 + features) of a softmax regression on standardised ``x``, around ``log prior``, by Newton's method."""
    wide, k = np.hstack([np.ones((len(x), 1)), x]), len(prior)
    w, hit = np.zeros((k, wide.shape[1])), np.eye(k)[truth]

    def loss(v: np.ndarray) -> float:
        z = np.log(prior) + wide @ v.T
        top = z.max(1, keepdims=True)
        return float((np.log(np.exp(z - top).sum(1)) + top[:, 0] - (z * hit).sum(1)).sum() + RIDGE / 2 * (v * v).sum())

    for _ in range(rounds):
        z = np.log(prior) + wide @ w.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        grad = (p - hit).T @ wide + RIDGE * w
        curve = np.zeros((k, wide.shape[1], k, wide.shape[1]))
        for a in range(k):
            for b in range(k):
                curve[a, :, b] = (wide * (p[:, a] * ((a == b) - p[:, b]))[:, None]).T @ wide
        step = np.linalg.solve(curve.reshape(w.size, w.size) + RIDGE * np.eye(w.size), grad.ravel()).reshape(w.shape)
        size, now = 1.0, loss(w)
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-8:
            break
    return w


def classifier(docs: DataFrame, labels: DataFrame, max_labels: int = importance.MAX_LABELS) -> Model:
    """Fits the classifier on the labelled rows of ``docs (doc_id, text)``; labels of other documents count for nothing.

    The n-gram models come from four fifths of them, the regression from the rest, the prior from all.
    """
    known = importance.labelled(labels, max_labels)
    domain = np.where(known["toxic"], 2, np.where(known["good"], 0, 1))
    n = importance.counts(docs, known["id"], np.where(known["held_out"], 0, domain + 1).astype(np.int8), len(DOMAINS))
    tables = np.stack([importance.log_ratio(n[k + 1], n[0]) if n[k + 1].sum() else np.zeros(n.shape[1], np.float32) for k in range(len(DOMAINS))])
    del n
    told, ids, held_out = evidence(tables), known["id"], known["held_out"]
    shared = docs.sparkSession.sparkContext.broadcast((tables, told))  # importance.SIZE numbers a domain, twice
    width = 2 * (len(DOMAINS) - 1) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = importance.positions(b.column(0), ids)
            b, at = b.filter(pa.array(at >= 0)), at[at >= 0]
            x = np.zeros((len(at), width))
            use = np.flatnonzero(held_out[at])
            if len(use):
                x[use] = features(*shared.value, b.column(1).take(pa.array(use)))[0]
            yield pa.record_batch([pa.array(at.astype(np.int64)), *(pa.array(x[:, k]) for k in range(width))], names=["at", *(f"x{k}" for k in range(width))])

    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen = pairs.mapInArrow(run, "at long, " + ", ".join(f"x{k} double" for k in range(width)))
    got = seen.groupBy("at").agg(*(F.max(f"x{k}").alias(f"x{k}") for k in range(width))).toArrow()  # at most max_labels rows
    shared.destroy()
    here = got["at"].to_numpy()
    prior = (np.bincount(domain[here], minlength=len(DOMAINS)) + 1.0) / (len(here) + len(DOMAINS))
    use = held_out[here]
    x = np.stack([got[f"x{k}"].to_numpy()[use] for k in range(width)], axis=1)
    centre, spread = (x.mean(0), x.std(0)) if len(x) else (np.zeros(width), np.ones(width))
    spread = np.where(spread > 1e-9, spread, 1.0)
    return Model(tables, told, prior, centre, spread, regression((x - centre) / spread, domain[here][use], prior))


def prior_in(docs: DataFrame, labels: DataFrame, max_labels: int = importance.MAX_LABELS) -> np.ndarray:
    """Shares of the domains among the labelled rows that ``docs`` still has, one added to each count."""
    known = importance.labelled(labels, max_labels)
    domain = np.where(known["toxic"], 2, np.where(known["good"], 0, 1))
    n = np.ones(len(DOMAINS))
    if len(domain):
        table = docs.sparkSession.createDataFrame(pa.table({"id": pa.array(known["id"], pa.int64()), "domain": pa.array(domain, pa.int64())}))
        there = table.join(docs.select(F.col("doc_id").cast("long").alias("id")), "id", "left_semi").groupBy("domain").count()
        for r in there.collect():  # one row a domain
            n[r["domain"]] += r["count"]
    return n / n.sum()


def memberships(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, *keep, tokens, p_clean, p_low, p_toxic)`` for every row of ``docs (doc_id, text, ...)``; posteriors on the grid."""
    shared = docs.sparkSession.sparkContext.broadcast((model.tables, model.evidence))
    rest = model._replace(tables=None, evidence=None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, tokens = features(*shared.value, b.column("text"))
            p = on_grid(np.where(tokens[:, None] > 0, posterior(rest, x), rest.prior))
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", *keep)] + [pa.array(tokens)] + [pa.array(p[:, k]) for k in range(len(DOMAINS))],
                                             names=["doc_id", *keep, "tokens", *POSTERIORS])

    taken = docs.select("doc_id", *dict.fromkeys(("text", *keep)))
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in ("doc_id", *keep))
    return taken.mapInArrow(run, f"{kinds}, tokens long, " + ", ".join(f"{p} double" for p in POSTERIORS))


def projected_gradient(p: np.ndarray, share: np.ndarray, target: np.ndarray, most: float, tolerance: float) -> np.ndarray:
    """Rates of posteriors ``p``, each of a ``share`` of all tokens, that bring the totals nearest to ``target``.

    Steps from rate 1 along the gradient, with momentum that starts anew whenever it points uphill, each
    projected onto 0 to ``most``. Ends where a plain step would move no rate by ``tolerance``, at the latest after
    ``STEPS`` steps.
    """
    step = 1.0 / max(np.linalg.eigvalsh((p * share[:, None]).T @ p)[-1], 1e-300)
    rate, ahead, t = np.ones(len(p)), np.ones(len(p)), 1.0
    for _ in range(STEPS):
        new = np.clip(ahead - step * (p @ ((ahead * share) @ p - target)), 0.0, most)
        if ((ahead - new) * share) @ (new - rate) > 0:
            ahead, t = rate, 1.0
            new = np.clip(rate - step * (p @ ((rate * share) @ p - target)), 0.0, most)
            if np.abs(new - rate).max() <= tolerance:
                return new
        grown = (1 + np.sqrt(1 + 4 * t * t)) / 2
        moved = new - rate
        rate, ahead, t = new, new + (t - 1) / grown * moved, grown
        if np.abs(moved).max() <= tolerance and np.abs(np.clip(rate - step * (p @ ((rate * share) @ p - target)), 0.0, most) - rate).max() <= tolerance:
            break
    return rate


def fit_rates(members: DataFrame, targets: dict[str, float] | None = None, most: float = MAX_RATE, tolerance: float = 1e-9, even: bool = False) -> pa.Table:
    """``(p_clean, p_low, p_toxic, rate)``: the rate of every posterior of ``members``.

    ``members`` has posteriors on a grid, as ``memberships`` gives them; more than ``CELLS`` different ones are
    refused. Where targets can be reached with rates up to ``most`` the totals meet them. Where they cannot,
    the totals' squared error is the least there is. A rate is then within ``tolerance`` of where the next
    step would take it. Without any tokens all rates are 1. ``even``: errors are measured in units of the domain's
    root mean square posterior, so that totals of rare domains weigh as much as those of frequent ones.
    """
    sums = members.groupBy(*POSTERIORS).agg(F.sum("tokens").alias("tokens")).limit(CELLS + 1).toArrow()
    if sums.num_rows > CELLS:
        raise ValueError(f"more than {CELLS} different posteriors: round them to a grid first")
    p, tokens = np.stack([sums[c].to_numpy() for c in POSTERIORS], axis=1), sums["tokens"].to_numpy().astype(float)
    rate = np.ones(len(tokens))
    if tokens.sum() > 0:
        order = np.lexsort(p.T)
        target = np.array([(targets or TARGETS).get(d, 0.0) for d in DOMAINS])
        share = tokens[order] / tokens.sum()
        spread = np.sqrt(share @ p[order] ** 2) if even else np.ones(len(DOMAINS))
        unit = np.where(spread > 0, spread, 1.0)
        rate[order] = projected_gradient(p[order] / unit, share, target / unit, most, tolerance)
    return pa.table([*(sums[c] for c in POSTERIORS), pa.array(rate)], names=[*POSTERIORS, "rate"])


def with_rates(members: DataFrame, rates: pa.Table) -> DataFrame:
    """``members`` with ``rate``, that of their posterior; ``rates`` has at most ``CELLS`` rows."""
    if not rates.num_rows:
        return members.withColumn("rate", F.lit(1.0))
    table = members.sparkSession.createDataFrame(rates)
    return members.join(F.broadcast(table), list(POSTERIORS), "left").select(*members.columns, "rate")


def attained(mixed: DataFrame) -> DataFrame:
    """``(domain, input_share, share)``: each domain's expected share of all tokens before and after drawing by ``rate``.

    Shares are of the input's tokens. No row without tokens.
    """
    sums = mixed.agg(F.sum("tokens").alias("n"), *(F.sum(F.col("tokens") * F.col(p)).alias(f"a_{p}") for p in POSTERIORS),
                     *(F.sum(F.col("tokens") * F.col(p) * F.col("rate")).alias(f"b_{p}") for p in POSTERIORS)).where("n > 0")
    rows = F.explode(F.array(*(F.struct(F.lit(d).alias("domain"), (F.col(f"a_{p}") / F.col("n")).alias("input_share"), (F.col(f"b_{p}") / F.col("n")).alias("share"))
                               for d, p in zip(DOMAINS, POSTERIORS)))).alias("x")
    return sums.select(rows).select("x.*")


def shifted(members: DataFrame, factors: dict[str, float]) -> dict[str, float]:
    """Targets taken from the input: each named domain's expected share times its factor, and the rest for the first other one."""
    row = members.agg(F.sum("tokens"), *(F.sum(F.col("tokens") * F.col(p)) for p in POSTERIORS)).first()
    if not row[0]:
        return dict(TARGETS)
    now = {d: row[k + 1] / row[0] for k, d in enumerate(DOMAINS)}
    out = {d: now[d] * factors.get(d, 1.0) for d in DOMAINS}
    rest = next(d for d in DOMAINS if d not in factors)
    out[rest] += 1.0 - sum(out.values())
    return out


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, keep: tuple[str, ...] = (), max_labels: int = importance.MAX_LABELS,
        most: float = MAX_RATE, factors: dict[str, float] | None = None, even: bool = False,
        train: DataFrame | None = None) -> DataFrame:
    """``(doc_id, *keep, tokens, p_clean, p_low, p_toxic, rate)`` for every row of ``docs (doc_id, text, ...)``.

    ``targets`` are shares of all tokens per domain (default ``TARGETS``); ``factors`` takes them from the input
    instead (``shifted``). No rate is above ``most``; ``even`` is as in ``fit_rates``. The classifier is fitted on at most ``max_labels``
    labelled rows of ``labels (doc_id, quality, toxic)``, a fifth of which only set its regression; posteriors
    and rates cover every row and whole texts. Null or empty texts have no tokens and the prior as
    posterior. Rows with a null id are unlabelled; repeated rows each get the same rate. Ids are integers, or
    texts of integers. Without labels all domains are equally likely for all. Targets that no rates reach give the
    least squared error. An empty table gives no rows. ``keep`` names columns to carry along (their rows
    are scored again on the way rather than stored); others are ignored. ``train (doc_id, text)`` holds the labelled
    texts where ``docs`` has lost most of some domain (default: ``docs``); the prior is that of ``docs`` all the same.
    """
    model = classifier(docs if train is None else train, labels, max_labels)
    if train is not None:
        model = model._replace(prior=prior_in(docs, labels, max_labels))
    narrow = staged(memberships(docs, model), "members")
    rates = fit_rates(narrow, shifted(narrow, factors) if factors else targets, most, even=even)
    return with_rates(memberships(docs, model, keep) if keep else narrow, rates)
