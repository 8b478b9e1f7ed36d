"""Catalog and behaviour column expressions: prices, price bands, trigger types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the studied jobs.
# Trigger type per event name (anything else maps to 0).
TRIGGER_TYPES = (("coupon_click", 1), ("buy_detail", 2), ("collect_detail", 3), ("footprint", 4))
# Price bands for re-ranking: (lower bound of the main offer's price, multiplier for the candidate).
PRICE_BANDS = ((100.0, 1.4), (50.0, 1.5), (0.0, 1.6))
MIN_DISCOUNT_RATIO = 1.04


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def effective_price(zk_price="zk_price", raw_price="raw_price") -> Column:
    """Discounted price when positive, else the raw price (a null discounted price takes the raw one)."""
    zk = _col(zk_price)
    return F.when(zk > 0, zk).otherwise(_col(raw_price))


def trigger_type(event_name="event_name", mapping=TRIGGER_TYPES) -> Column:
    expr = None
    for name, code in mapping:
        expr = (F.when(_col(event_name) == name, F.lit(code)) if expr is None
                else expr.when(_col(event_name) == name, F.lit(code)))
    return expr.otherwise(F.lit(0))


def price_limit(main_price, bands=PRICE_BANDS) -> Column:
    """Upper candidate price for a main offer price: main x multiplier of the first band it reaches."""
    p = _col(main_price)
    expr = None
    for lower, mult in bands:
        cond = p >= F.lit(float(lower))
        val = p * F.lit(float(mult))
        if lower <= 0:
            expr = val if expr is None else expr.otherwise(val)
            return expr
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def in_price_band(main_price, cand_price, bands=PRICE_BANDS) -> Column:
    """True when the candidate's discounted price is strictly below the band limit."""
    return _col(cand_price) < price_limit(main_price, bands)


def discount_ratio(raw_price, zk_price) -> Column:
    """raw / discounted, null when the discounted price is zero or null."""
    return F.try_divide(_col(raw_price), _col(zk_price))
