"""Training corpora for embeddings: per-user item sentences and a weighted co-click edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.operators.filters import valid_interactions
from recsift.operators.pairs import basket_pairs

# Fixed values that must equal the studied job: app pages and modules excluded from the corpus.
EXCLUDED_PAGES = ("h5_free", "h5_subsidy", "h5_subsidy_v2")
EXCLUDED_MODULES = ("home_free_list",)


def item_sentences(clicks: DataFrame, catalog: DataFrame, start: str, end: str, cap: int = 100,
                   min_len: int = 5, excluded_pages=EXCLUDED_PAGES, excluded_modules=EXCLUDED_MODULES,
                   sentinel: str = "000000000000000") -> DataFrame:
    """Per-user sentence of ``offer:subcate`` tokens: ``(user_id, sentence, n_tokens)``.

    Distinct (user, offer, subcate) click rows in the date range, ranked per user by subcate
    descending (ties by offer id) and capped at ``cap`` *before* the live-offer join; tokens are
    ordered by subcate (then offer) and sentences shorter than ``min_len`` tokens drop. Rows
    without a subcate are dropped (they cannot form a token). Every listed page and module is excluded,
    and with them rows without one; an empty list excludes nothing.
    """
    dated = clicks.where(F.col("ymd").between(start, end))
    known = dated.where(F.col("subcate_id").isNotNull() & (F.length("cate_id3") > 0) & (F.length("offer_id") >= 2)
                        & (F.length("user_id") >= 14) & (F.col("user_id") != sentinel))
    c = known.where((F.col("event_name") == "coupon_click") & (F.col("event_type") == "click"))
    for col, excluded in (("cur_module", excluded_modules), ("cur_page", excluded_pages)):
        if excluded:
            c = c.where(~F.col(col).isin(list(excluded)))
    g = c.select("user_id", "offer_id", "subcate_id").distinct()
    w = Window.partitionBy("user_id").orderBy(F.col("subcate_id").desc(), F.col("offer_id").asc())
    ranked = g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= cap)
    live = catalog.where(F.col("status") == 1).select("offer_id").distinct()
    kept = ranked.join(live, "offer_id")
    toks = F.array_sort(F.collect_list(F.struct("subcate_id", "offer_id")))
    s = kept.groupBy("user_id").agg(toks.alias("t"))
    s = s.select("user_id", F.transform("t", lambda x: F.concat_ws(":", x["offer_id"], x["subcate_id"])).alias("t"))
    return (s.where(F.size("t") >= min_len)
            .select("user_id", F.array_join("t", " ").alias("sentence"), F.size("t").cast("bigint").alias("n_tokens")))


def co_click_edges(log: DataFrame, start: str) -> DataFrame:
    """Undirected co-click graph: ``(src, dst, weight)`` with src < dst and weight = users clicking both."""
    v = valid_interactions(log, start=start, event_name="coupon_click").select("user_id", "offer_id")
    p = basket_pairs(v, ["user_id"], "offer_id")
    return p.groupBy(F.col("item_i").alias("src"), F.col("item_j").alias("dst")).agg(F.count(F.lit(1)).alias("weight"))
