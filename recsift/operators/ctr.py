"""Per-offer click-through rate from the app log, with the four null/zero policies in use."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.operators.filters import valid_interactions

POLICIES = ("zero", "floor", "plain", "supported")


def offer_clicks_views(log: DataFrame, start: str | None = None) -> DataFrame:
    """``(offer_id, click, view)`` over valid log rows (map-side combined aggregation)."""
    v = valid_interactions(log, start=start, event_name=None)
    return v.groupBy("offer_id").agg(
        F.sum(F.when(F.col("event_name") == "coupon_click", 1).otherwise(0)).cast("bigint").alias("click"),
        F.sum(F.when(F.col("event_name") == "coupon_view", 1).otherwise(0)).cast("bigint").alias("view"))


def offer_ctr(log: DataFrame, policy: str = "zero", start: str | None = None, floor: float = 0.0001,
              min_clicks: int = 2, min_views: int = 11) -> DataFrame:
    """``(offer_id, click, view, ctr)``.

    * ``zero``: ctr = clicks/views, 0.0 when undefined; only offers with click < view.
    * ``floor``: ctr = clicks/views, ``floor`` when undefined or zero; all offers.
    * ``plain``: ctr = clicks/views, null when there are no views; offers with >= ``min_clicks``.
    * ``supported``: as ``zero``, offers with 0 < click < view and view >= ``min_views``.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    cv = offer_clicks_views(log, start)
    ratio = F.try_divide(F.col("click"), F.col("view"))
    click, view = F.col("click"), F.col("view")
    if policy == "zero":
        return cv.where(click < view).withColumn("ctr", F.coalesce(ratio, F.lit(0.0)))
    if policy == "floor":
        r = F.coalesce(ratio, F.lit(floor))
        return cv.withColumn("ctr", F.when(r == 0, F.lit(floor)).otherwise(r))
    if policy == "plain":
        return cv.where(click >= min_clicks).withColumn("ctr", ratio)
    return (cv.where((click < view) & (click > 0) & (view >= min_views))
            .withColumn("ctr", F.coalesce(ratio, F.lit(0.0))))
