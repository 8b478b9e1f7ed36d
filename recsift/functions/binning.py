"""Edge bucketing of numeric text and the number test used before it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the studied jobs: bucket edges per feature family.
SCORE_EDGES = (0.0, 3.0, 3.9, 4.0, 4.1, 4.2, 4.3, 4.4, 4.5, 4.6, 4.7, 4.8, 4.9, 5.0)
RATE_EDGES = (0.0, 10.0, 20.0, 30.0, 40.0, 50.0, 60.0, 70.0, 80.0, 90.0)
PRICE_EDGES = (0.0, 5.0, 10.0, 15.0, 25.0, 50.0, 70.0, 150.0, 200.0, 250.0, 300.0)
COMMISSION_EDGES = (0.0, 2.0, 4.0, 6.0, 8.0, 10.0, 14.0, 20.0, 40.0)

# Plain decimal numbers only: optional minus, digits with optional fraction, or a bare fraction.
# Exponents, a leading plus and a trailing dot are rejected.
NUMBER_PATTERN = r"^-?([0-9]+([.][0-9]+)?|[.][0-9]+)$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_number(text, default: float = -1.0) -> Column:
    """Double value of plain-number text, ``default`` otherwise."""
    t = _col(text)
    return F.when(t.rlike(NUMBER_PATTERN), t.cast("double")).otherwise(F.lit(default))


def bucketize_number(x, edges) -> Column:
    """Number of ascending ``edges`` <= x (1-based bucket), -1 below the first edge.

    Written as a CASE chain on the position of the last edge <= x: no lambda, so the expression
    stays inside generated code. Pass a column reference: it is compared once per edge.
    """
    es = [float(e) for e in edges]
    if any(b < a for a, b in zip(es, es[1:])):
        raise ValueError("edges must be ascending")
    v = _col(x)
    expr = None
    for i in range(len(es) - 1, -1, -1):
        cond = v >= F.lit(es[i])
        expr = F.when(cond, F.lit(i + 1)) if expr is None else expr.when(cond, F.lit(i + 1))
    return expr.otherwise(F.lit(-1))


def bucketize(value, edges) -> Column:
    """Bucket of plain-number text (non-numbers count as -1.0, hence bucket -1)."""
    return bucketize_number(parse_number(_col(value)), edges)
