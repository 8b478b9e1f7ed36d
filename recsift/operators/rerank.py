"""Similarity post-processing: id translation, price and CTR re-ranking, list extension, top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.functions.catalog import MIN_DISCOUNT_RATIO, PRICE_BANDS, discount_ratio, in_price_band
from recsift.operators.ranking import ranked


def translate_and_filter(sim: DataFrame, servable: DataFrame, catalog: DataFrame, distinct: bool = True,
                         symmetric: bool = False, kept: DataFrame | None = None) -> DataFrame:
    """Item pairs to offer pairs: ``(main_offer, sim_offer, score)``.

    The candidate must be servable (``servable`` = ``(item_id, offer_id)``); the main item maps
    through any live catalog row. Both are inner joins, so an item with several offers fans out.
    ``symmetric``: ``sim`` holds every pair in both directions with one score, as ``item_cf`` does; a pair is then
    looked up once for both. ``kept`` (``offer_id``) names the candidates that the job does not drop later
    on, so that others do not meet pairs (existence test).
    """
    cand = servable.select(F.col("item_id").alias("item_j"), F.col("offer_id").alias("sim_offer"))
    main = (catalog.where(F.col("status") != 0)
            .select(F.col("item_id").alias("item_i"), F.col("offer_id").alias("main_offer")))
    if kept is not None:
        cand = cand.join(kept.select(F.col("offer_id").alias("sim_offer")), "sim_offer", "left_semi")
    if symmetric:
        out = _translate_both_ways(sim, main, cand, distinct)
    else:
        if distinct:  # an offer that several rows give to an item would only multiply pairs for the distinct below
            cand, main = cand.distinct(), main.distinct()
        out = sim.join(cand, "item_j").join(main, "item_i").select("main_offer", "sim_offer", "score")
    # Stated explicitly (they hold for any usable pair) so that consumers which would infer them
    # from their own joins or filters all see one plan and share this result's shuffle.
    out = out.where(F.col("main_offer").isNotNull() & F.col("sim_offer").isNotNull()
                    & F.col("score").isNotNull() & ~F.isnan("score"))
    return _distinct_pairs(out) if distinct else out


def _translate_both_ways(sim: DataFrame, main: DataFrame, cand: DataFrame, distinct: bool) -> DataFrame:
    """Offer pairs of symmetric item pairs: the offers of either item, as main and as candidate, meet a pair once."""
    n = lambda m, c: [F.lit(m).cast("bigint").alias("m"), F.lit(c).cast("bigint").alias("c")]
    offers = main.select(F.col("item_i").alias("item"), F.col("main_offer").alias("offer"), *n(1, 0)).unionByName(
        cand.select(F.col("item_j").alias("item"), F.col("sim_offer").alias("offer"), *n(0, 1))).where(F.col("offer").isNotNull())
    rows = F.max if distinct else F.sum  # rows that give the offer to the item
    offers = offers.groupBy("item", "offer").agg(rows("m").alias("m"), rows("c").alias("c"))
    side = lambda s: offers.select(F.col("item").alias(f"item_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in ("offer", "m", "c")])
    met = sim.where(F.col("item_i") < F.col("item_j")).select("item_i", "item_j", "score").join(side("i"), "item_i").join(side("j"), "item_j")
    way = lambda a, b: F.struct(F.col(f"offer_{a}").alias("main_offer"), F.col(f"offer_{b}").alias("sim_offer"),
                                (F.col(f"m_{a}") * F.col(f"c_{b}")).alias("n"))
    out = met.select("score", F.explode(F.array(way("i", "j"), way("j", "i"))).alias("p")).where(F.col("p.n") > 0)
    if not distinct:
        out = out.select("score", "p", F.explode(F.array_repeat(F.lit(0), F.col("p.n").cast("int"))))
    return out.select("p.main_offer", "p.sim_offer", "score")


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    """Distinct ``(main_offer, sim_offer, score)``, dealt and sorted by the main offer, as joins and ranks by it need them.

    Nearly all rows differ, so a hash table of them on either side of the shuffle would only take memory.
    """
    rows = pairs.repartition("main_offer").sortWithinPartitions("main_offer", "sim_offer", "score")
    w = Window.partitionBy("main_offer").orderBy("sim_offer", "score")
    rows = rows.withColumns({"_sim": F.lag("sim_offer").over(w), "_score": F.lag("score").over(w)})
    first = F.col("_sim").isNull() | (F.col("_sim") != F.col("sim_offer")) | (F.col("_score") != F.col("score"))
    return rows.where(first).select("main_offer", "sim_offer", "score")


def _prices(catalog: DataFrame) -> DataFrame:
    return catalog.where((F.col("status") != 0) & (F.col("product_type") == 1)) \
        .select("offer_id", "raw_price", "zk_price", "month_sales")


def price_offers(catalog: DataFrame, min_sales: int = 10, min_discount: float = MIN_DISCOUNT_RATIO) -> DataFrame:
    """``kept`` of ``translate_and_filter``: the candidates that ``price_rerank`` does not drop."""
    sold = F.col("month_sales") > min_sales
    return _prices(catalog).where(sold & (discount_ratio("raw_price", "zk_price") > F.lit(float(min_discount)))).select("offer_id")


def ctr_offers(ctr: DataFrame) -> DataFrame:
    """``kept`` of ``translate_and_filter``: the candidates with a click rate; ``ctr_rerank`` drops others."""
    return ctr.where(F.col("ctr").isNotNull()).select("offer_id")


def price_candidates(sim_offers: DataFrame, catalog: DataFrame, min_sales: int = 10) -> DataFrame:
    """Offer pairs with both prices attached (the scored-list content).

    Output ``(main_offer, sim_offer, score, zk_price, sim_raw_price, sim_zk_price, sim_month_sales)``;
    both offers must be live product-type-1 offers and the candidate's sales > ``min_sales``.
    """
    p = _prices(catalog)
    main = p.select(F.col("offer_id").alias("main_offer"), "zk_price")
    cand = p.select(F.col("offer_id").alias("sim_offer"), F.col("raw_price").alias("sim_raw_price"),
                    F.col("zk_price").alias("sim_zk_price"), F.col("month_sales").alias("sim_month_sales"))
    return (sim_offers.join(main, "main_offer").join(cand, "sim_offer")
            .where(F.col("sim_month_sales") > min_sales)
            .select("main_offer", "sim_offer", "score", "zk_price", "sim_raw_price", "sim_zk_price",
                    "sim_month_sales"))


def rank_by_price(scored: DataFrame, min_discount: float = MIN_DISCOUNT_RATIO, bands=PRICE_BANDS) -> DataFrame:
    """Re-rank scored candidates: ``(main_offer, rank, sim_offer, score, in_band)``.

    Keeps candidates with raw/discounted price > ``min_discount`` (a null price drops the
    candidate). ``in_band`` compares the candidate's discounted price with the main offer's
    discounted price times the band multiplier. Order: in-band first, then score descending,
    ties by offer id.
    """
    j = (scored.where(discount_ratio("sim_raw_price", "sim_zk_price") > F.lit(float(min_discount)))
         .withColumn("in_band", F.when(in_price_band("zk_price", "sim_zk_price", bands), 1).otherwise(0)))
    order = [F.col("in_band").desc(), F.col("score").desc(), F.col("sim_offer").asc()]
    return ranked(j.select("main_offer", "sim_offer", "score", "in_band"), "main_offer", order).select("main_offer", "rank", "sim_offer", "score", "in_band")


def price_rerank(sim_offers: DataFrame, catalog: DataFrame, min_sales: int = 10,
                 min_discount: float = MIN_DISCOUNT_RATIO, bands=PRICE_BANDS) -> DataFrame:
    """Price-aware re-rank of offer pairs (``price_candidates`` then ``rank_by_price``)."""
    return rank_by_price(price_candidates(sim_offers, catalog, min_sales), min_discount, bands)


def ctr_rerank(sim_offers: DataFrame, ctr: DataFrame, catalog: DataFrame, scale: float = 100.0,
               min_sales: int = 10) -> DataFrame:
    """Score x candidate CTR x ``scale``, re-ranked: ``(main_offer, rank, sim_offer, score)``.

    Candidates without a CTR row drop (inner join), as do null products (an offer with no views).
    Main and candidate must be live product-type-1 offers; candidate sales > ``min_sales``.
    """
    c = ctr.select(F.col("offer_id").alias("sim_offer"), F.col("ctr"))
    p = _prices(catalog)
    main = p.select(F.col("offer_id").alias("main_offer"))
    cand = p.select(F.col("offer_id").alias("sim_offer"), F.col("month_sales").alias("sim_month_sales"))
    # Both tables of the candidate in one shuffle; they drop most pairs before the main offer is looked up.
    j = (sim_offers.join(c, "sim_offer")
         .withColumn("score", F.col("score") * F.col("ctr") * F.lit(float(scale)))
         .where(F.col("score").isNotNull())
         .join(cand, "sim_offer").where(F.col("sim_month_sales") > min_sales)
         .join(main, "main_offer"))
    return ranked(j.select("main_offer", "sim_offer", "score"), "main_offer", [F.col("score").desc(), F.col("sim_offer").asc()]).select(
        "main_offer", "rank", "sim_offer", "score")


def extend_lists(base: DataFrame, new: DataFrame, depth: int = 200) -> DataFrame:
    """What a new ranked list adds over a baseline: ``(main_offer, pos, sim_offer, has_base)``.

    For every main offer of ``new``: when the baseline has no list, the first ``depth`` entries
    of the new list with ``has_base = 0``; otherwise the new top ``depth`` minus the baseline top
    ``depth`` in new-list order with ``has_base = 1``. A main whose difference is empty keeps one
    row with null ``pos`` / ``sim_offer``. Inputs are long form ``(main_offer, rank, sim_offer)``, ranked
    from 1; each is read once.
    """
    tagged = new.where(F.col("rank") <= depth).select("main_offer", "sim_offer", F.col("rank").cast("bigint").alias("rank")).unionByName(
        base.where(F.col("rank") <= depth).select("main_offer", "sim_offer", F.lit(None).cast("bigint").alias("rank")))
    # One aggregation says which list holds a pair; what follows sees at most 2 * depth rows a main offer.
    pairs = tagged.groupBy("main_offer", "sim_offer").agg(F.min("rank").alias("rank"), F.max(F.col("rank").isNull()).alias("old"))
    added = F.col("rank").isNotNull() & ~F.col("old")
    main = Window.partitionBy("main_offer")
    placed = pairs.select("main_offer", "sim_offer", added.alias("added"), F.count("rank").over(main).alias("listed"),
                          F.max("old").over(main).cast("int").alias("has_base"), F.count(F.when(added, 1)).over(main).alias("n"),
                          F.row_number().over(main.orderBy(F.when(added, F.col("rank")).asc_nulls_last(), "sim_offer")).cast("bigint").alias("place"))
    kept = placed.where((F.col("listed") > 0) & (F.col("added") | (F.col("n") == 0) & (F.col("place") == 1)))
    return kept.select("main_offer", F.when(F.col("added"), F.col("place")).alias("pos"), F.when(F.col("added"), F.col("sim_offer")).alias("sim_offer"), "has_base")


def top_candidates(sim: DataFrame, valid: DataFrame | None = None, n: int | None = 400, main_col: str = "main_id",
                   sim_col: str = "sim_id", score_col: str = "score") -> DataFrame:
    """Top ``n`` candidates (``None``: all) per main id by numeric score (ties by id): ``(main, rank, sim, score)``.

    Entries with a null or NaN score drop; with ``valid`` (an ``item_id`` frame) only valid
    candidates are kept (existence test, so duplicate valid rows never multiply pairs).
    """
    s = sim.where(F.col(score_col).isNotNull() & ~F.isnan(score_col))
    if valid is not None:
        s = s.join(valid.select(F.col("item_id").alias(sim_col)), sim_col, "left_semi")
    w = Window.partitionBy(main_col).orderBy(F.col(score_col).desc(), F.col(sim_col).asc())
    r = s.withColumn("rank", F.row_number().over(w))
    if n is not None:
        r = r.where(F.col("rank") <= n)
    return r.select(main_col, F.col("rank").cast("bigint").alias("rank"), sim_col, score_col)
