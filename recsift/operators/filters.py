"""Row filters, support thresholds and the servable / valid item sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.functions.catalog import effective_price
from recsift.functions.catalog import trigger_type
from recsift.functions.dates import epoch_seconds_int


def _nonempty(c: str):
    return F.col(c).isNotNull() & (F.col(c) != "")


def valid_interactions(log: DataFrame, start: str | None = None, end: str | None = None,
                       event_name: str | None = "coupon_click", user_col: str = "user_id",
                       item_col: str = "item_id") -> DataFrame:
    """User and item present and non-empty, item not ``'0'``, optional event name and ymd range."""
    # One test for the item, null included, as an item read from JSON is read again by every test.
    cond = _nonempty(user_col) & ~F.col(item_col).isin("", "0")
    if event_name is not None:
        cond = cond & (F.col("event_name") == event_name)
    if start is not None:
        cond = cond & (F.col("ymd") >= start)
    if end is not None:
        cond = cond & (F.col("ymd") <= end)
    return log.where(cond)


def id_length_filter(df: DataFrame, user_col: str = "user_id", offer_col: str = "offer_id",
                     min_user_len: int = 14, min_offer_len: int = 2,
                     sentinel: str = "000000000000000") -> DataFrame:
    """Minimum id lengths and the all-zero device sentinel."""
    return df.where((F.length(user_col) >= min_user_len) & (F.length(offer_col) >= min_offer_len)
                    & (F.col(user_col) != sentinel))


def title_blocklist(df: DataFrame, pattern: str | None, title_col: str = "title") -> DataFrame:
    """Drop rows whose title matches ``pattern``; a null title drops too (three-valued logic)."""
    if not pattern:
        return df
    return df.where(~F.col(title_col).rlike(pattern))


def priced_offers(catalog: DataFrame, low: float = 5.0, high: float = 150.0,
                  min_orders: int = 150) -> DataFrame:
    """Catalog rows with effective price in [low, high] and (recommendable or well sold)."""
    price = effective_price()
    return (catalog.withColumn("price", price)
            .where((F.col("price") >= low) & (F.col("price") <= high)
                   & ((F.col("is_recommend") != 2) | (F.col("order_count") >= min_orders))))


def active_users(interactions: DataFrame, min_rows: int = 2, max_rows: int = 2000,
                 user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Users whose interaction *row* count lies in [min_rows, max_rows]: ``(user_id, n_rows)``."""
    return (interactions.groupBy(user_col).agg(F.count(item_col).alias("n_rows"))
            .where((F.col("n_rows") >= min_rows) & (F.col("n_rows") <= max_rows)))


def item_support(interactions: DataFrame, min_support: int = 5, min_rows: int = 2,
                 max_rows: int = 2000) -> DataFrame:
    """``(item_id, nor)``: distinct active users per item, at least ``min_support``."""
    active = active_users(interactions, min_rows, max_rows).select("user_id")
    ui = interactions.select("user_id", "item_id").distinct()
    return (ui.join(active, "user_id", "left_semi").groupBy("item_id")
            .agg(F.count("user_id").alias("nor")).where(F.col("nor") >= min_support))


def servable_offers(catalog: DataFrame, offer_status: DataFrame, shop: DataFrame) -> DataFrame:
    """``(item_id, offer_id)`` of offers that may be served.

    Recommendable, product type 1, with a ticket, live, offer not deleted and shop not deleted.
    The status tables are joined as left outer joins followed by a null-rejecting filter in the
    studied job; that is an inner join, written as one here.
    """
    c = catalog.where((F.col("is_recommend") != 2) & (F.col("product_type") == 1)
                      & (F.col("ticket_id") != 0) & (F.col("status") != 0)) \
        .select("item_id", "offer_id", "shop_id")
    o = offer_status.select("offer_id", F.col("is_del").alias("offer_is_del"))
    s = shop.select("shop_id", F.col("is_del").alias("shop_is_del"))
    return (c.join(o, "offer_id").join(s, "shop_id")
            .where((F.col("offer_is_del") != 1) & (F.col("shop_is_del") != 1))
            .select("item_id", "offer_id"))


# Fixed values that must equal the studied jobs (category exclusions of the valid-item query).
EXCLUDED_CATE_ID3 = (22432, 22441, 22445, 21017, 20498)
EXCLUDED_SUBCATE = (20764,)


def valid_items(catalog: DataFrame, offer_status: DataFrame, shop: DataFrame, ticket: DataFrame,
                price_range: tuple[float, float] = (5.0, 150.0), min_orders: int = 150,
                excluded_cate_id3: Sequence = EXCLUDED_CATE_ID3,
                excluded_subcate: Sequence = EXCLUDED_SUBCATE,
                min_shop_score: float = 4.5, blocklist: str | None = None) -> DataFrame:
    """``(item_id)`` rows of items valid for user recommendations (four-way star join)."""
    c = priced_offers(catalog, price_range[0], price_range[1], min_orders)
    c = c.where((F.col("product_type") == 1) & (F.col("ticket_id") != 0) & (F.col("status") != 0))
    if excluded_cate_id3:
        c = c.where(~F.col("cate_id3").isin(list(excluded_cate_id3)))
    if excluded_subcate:
        c = c.where(~F.col("subcate_id").isin(list(excluded_subcate)))
    c = title_blocklist(c, blocklist)
    o = offer_status.select("offer_id", F.col("is_del").alias("offer_is_del")).where(F.col("offer_is_del") != 1)
    s = (shop.select("shop_id", F.col("is_del").alias("shop_is_del"), "shop_score_avg")
         .where((F.col("shop_is_del") != 1) & (F.col("shop_score_avg") >= min_shop_score)))
    t = ticket.where(F.col("status") != 0).select("ticket_id")
    return c.join(o, "offer_id").join(s, "shop_id").join(t, "ticket_id").select("item_id")


def behaviour_events(log: DataFrame, external: DataFrame, catalog: DataFrame, start: str,
                     event_names: Sequence[str] = ("coupon_click", "buy_detail", "collect_detail"),
                     external_type: str = "footprint", semi: bool = False) -> DataFrame:
    """Union of app events and external actions: ``(user_id, item_id, event_name, trigger_type, time)``.

    External actions count only for live catalog items. The studied query uses an inner join,
    so duplicate catalog rows multiply actions; ``semi=True`` uses an existence test instead.
    """
    app = (log.where((F.col("ymd") >= start) & (F.col("event_type") == "click")
                     & F.col("event_name").isin(list(event_names))
                     & (F.col("user_id") != "") & (F.col("user_id") != "0") & F.col("item_id").isNotNull())
           .select("user_id", "item_id", "event_name", "event_time"))
    live = catalog.where(F.col("status") != 0).select("item_id")
    ext = external.where((F.col("type") == external_type) & (F.col("ymd") >= start))
    ext = ext.join(live, "item_id", "left_semi" if semi else "inner")
    ext = ext.select("user_id", "item_id", F.lit(external_type).alias("event_name"),
                     F.col("time").alias("event_time"))
    u = app.unionByName(ext)
    return u.select("user_id", "item_id", "event_name", trigger_type().alias("trigger_type"),
                    epoch_seconds_int("event_time").alias("time"))
