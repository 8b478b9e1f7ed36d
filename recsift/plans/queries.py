"""Named queries over the test tables: one per operator family of the survey.

Each entry is ``name -> fn(spark, sf_dir) -> DataFrame`` and reads whole tables. Every result
column is aliased and cast to a fixed type so that the SQL twin in ``recsift.plans.oracle``
yields the same schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.functions import binning, dates, hashing
from recsift.operators import behaviour as beh
from recsift.operators import corpus
from recsift.operators import evaluate as ev_
from recsift.operators import recommend as rec
from recsift.operators import ctr
from recsift.operators import features as feat
from recsift.operators import filters as flt
from recsift.operators import rerank as rr
from recsift.operators import similarity as sim
from recsift.sources import fixtures as fx
from recsift.sources import tables
from recsift.sources import text_io as tio

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def item_cf(spark: SparkSession, d: str) -> DataFrame:
    return sim.item_cf(fx.orders_log(spark, d), fx.catalog(spark, d))


@query
def item_cf_strict(spark: SparkSession, d: str) -> DataFrame:
    return sim.item_cf(fx.orders_log(spark, d), fx.catalog(spark, d), strict_users=True)


@query
def item_cf_events(spark: SparkSession, d: str) -> DataFrame:
    e = sim.cf_events(fx.interactions(spark, d, _start()), fx.external_actions(spark, d, _start()), fx.catalog(spark, d), _start())
    return sim.item_cf(e, fx.catalog(spark, d))


# ---- parameters of the fixture queries -------------------------------------------------------
AS_OF = "20240131"         # reference day of the behaviour window (the log covers January 2024)
LOOKBACK_DAYS = 21         # window start 20240110
BLOCKLIST = "ring|red"     # title blocklist used with the test catalog
EXCL_CATE_ID3 = (22, 41, 45, 17, 48)
EXCL_SUBCATE = ("Brand#20",)


def _start() -> str:
    return dates.window_start(AS_OF, LOOKBACK_DAYS)


@query
def valid_interactions(spark, d):
    v = flt.valid_interactions(fx.interactions(spark, d, _start()), start=_start())
    return v.select("user_id", "item_id", "offer_id", "event_time", "ymd")


@query
def id_length_filter(spark, d):
    t = flt.id_length_filter(fx.train_log(spark, d, TRAIN_START, TRAIN_END))
    t = t.where(F.col("log_type").isin("home_feed") & F.col("day").between(TRAIN_START, TRAIN_END))
    return t.select("trace_id", "user_id", "offer_id", "label")


@query
def title_blocklist(spark, d):
    return flt.title_blocklist(fx.catalog(spark, d), BLOCKLIST).select("item_id", "title")


@query
def effective_price(spark, d):
    return flt.priced_offers(fx.catalog(spark, d)).select("item_id", "offer_id", "price")


@query
def active_users(spark, d):
    return flt.active_users(fx.orders_log(spark, d))


@query
def item_support(spark, d):
    return flt.item_support(fx.orders_log(spark, d))


def _behaviour(spark, d, fan=False):
    return flt.behaviour_events(fx.interactions(spark, d, _start()), fx.external_actions(spark, d, _start()),
                                fx.catalog(spark, d, fan), _start())


@query
def behaviour_union(spark, d):
    return _behaviour(spark, d)


@query
def latest_behaviour(spark, d):
    return beh.latest_behaviour(_behaviour(spark, d))


def _valid_items(spark, d):
    return flt.valid_items(fx.catalog(spark, d), fx.offer_status(spark, d), fx.shops(spark, d),
                           fx.tickets(spark, d), excluded_cate_id3=EXCL_CATE_ID3,
                           excluded_subcate=EXCL_SUBCATE, blocklist=BLOCKLIST)


@query
def valid_items(spark, d):
    return _valid_items(spark, d)


def _servable(spark, d, fan=False):
    return flt.servable_offers(fx.catalog(spark, d, fan), fx.offer_status(spark, d, fan), fx.shops(spark, d))


@query
def servable_offers(spark, d):
    return _servable(spark, d)


def _ctr(spark, d, policy):
    return ctr.offer_ctr(fx.interactions(spark, d, _start()), policy, start=_start())


for _p in ctr.POLICIES:
    QUERIES[f"ctr_{_p}"] = (lambda p: lambda spark, d: _ctr(spark, d, p))(_p)


# ---- similarity post-processing ---------------------------------------------------------------
def _item_sim(spark, d, fan=False):
    return sim.item_cf(fx.orders_log(spark, d), fx.catalog(spark, d, fan))


def _offers(spark, d, distinct=True, fan=False, item_sim=None, kept=None):
    item_sim = _item_sim(spark, d, fan) if item_sim is None else item_sim
    return rr.translate_and_filter(item_sim, _servable(spark, d, fan), fx.catalog(spark, d, fan), distinct, symmetric=True, kept=kept)


def _price_lists(spark, d, fan=False, offers=None, item_sim=None):
    cat = fx.catalog(spark, d, fan)
    return rr.price_rerank(_offers(spark, d, fan=fan, item_sim=item_sim, kept=rr.price_offers(cat)) if offers is None else offers, cat)


def _ctr_lists(spark, d, item_sim=None):
    c = _ctr(spark, d, "plain")
    return rr.ctr_rerank(_offers(spark, d, distinct=False, item_sim=item_sim, kept=rr.ctr_offers(c)), c, fx.catalog(spark, d))


@query
def item_cf_offers(spark, d):
    return _offers(spark, d)


@query
def price_rerank(spark, d):
    return _price_lists(spark, d)


@query
def ctr_rerank(spark, d):
    return _ctr_lists(spark, d)


def _extensions(spark, d):
    """Both lists come from one stored similarity table, so it is planned and made once."""
    s = tio.stage(_item_sim(spark, d), "item_sim")
    return rr.extend_lists(base=_ctr_lists(spark, d, s), new=_price_lists(spark, d, item_sim=s))


@query
def extend_lists(spark, d):
    return _extensions(spark, d)


def _candidates(spark, d):
    s = _item_sim(spark, d).select(F.col("item_i").alias("main_id"), F.col("item_j").alias("sim_id"), "score")
    return rr.top_candidates(s, _valid_items(spark, d), n=400)


@query
def top_candidates(spark, d):
    return _candidates(spark, d)


# ---- Swing ----------------------------------------------------------------------------------------
SWING_START = "19950101"


def _swing_orders(spark, d, fan=False):
    return sim.order_events(fx.orders_log(spark, d, SWING_START), fx.external_actions(spark, d, SWING_START),
                            fx.catalog(spark, d, fan), SWING_START)


@query
def swing(spark, d):
    return sim.swing(_swing_orders(spark, d), fx.catalog(spark, d))


@query
def swing_same_category(spark, d):
    return sim.swing(_swing_orders(spark, d), fx.catalog(spark, d), same_category=True)


@query
def pair_support_band(spark, d):
    return sim.pair_support(_swing_orders(spark, d))


@query
def category_index(spark, d):
    return feat.frequency_index(fx.catalog(spark, d), "subcate_id")


@query
def item_index(spark, d):
    return feat.frequency_index(_swing_orders(spark, d), "item_id")


# ---- the same jobs where items have several offers and categories ---------------------------------
@query
def item_cf_fan(spark, d):
    return _item_sim(spark, d, fan=True)


@query
def item_cf_offers_fan(spark, d):
    return _offers(spark, d, fan=True)


@query
def price_rerank_fan(spark, d):
    return _price_lists(spark, d, fan=True)


@query
def swing_fan(spark, d):
    return sim.swing(_swing_orders(spark, d, fan=True), fx.catalog(spark, d, fan=True))


@query
def behaviour_union_fan(spark, d):
    return _behaviour(spark, d, fan=True)


@query
def top_candidates_fan(spark, d):
    s = _item_sim(spark, d, fan=True).select(F.col("item_i").alias("main_id"), F.col("item_j").alias("sim_id"), "score")
    valid = flt.valid_items(fx.catalog(spark, d, fan=True), fx.offer_status(spark, d, fan=True), fx.shops(spark, d), fx.tickets(spark, d),
                            excluded_cate_id3=EXCL_CATE_ID3, excluded_subcate=EXCL_SUBCATE, blocklist=BLOCKLIST)
    return rr.top_candidates(s, valid, n=400)


# ---- feature export ---------------------------------------------------------------------------
TRAIN_START, TRAIN_END = "20240105", "20240125"


def _tlog_map(spark, d):
    return fx.train_log(spark, d).withColumn("fmap", feat.feature_map())


@query
def hash_feature(spark, d):
    t = fx.train_log(spark, d)
    return t.select("trace_id", "user_id", "offer_id",
                    hashing.hash_feature("S", F.col("offer_id")).alias("f_s"),
                    hashing.hash_feature("Sd", F.col("user_id")).alias("f_sd"),
                    hashing.hash_feature("Lb", F.col("label")).alias("f_label"))


BUCKET_SPECS = (("Mc", binning.SCORE_EDGES, "b_mc"), ("Sl", binning.RATE_EDGES, "b_sl"),
                ("Sf", binning.PRICE_EDGES, "b_sf"), ("Ss", binning.COMMISSION_EDGES, "b_ss"),
                ("Sq", binning.PRICE_EDGES, "b_sq"))


@query
def bucketize(spark, d):
    t = _tlog_map(spark, d)
    keep = ["trace_id", "user_id", "offer_id"]
    t = t.select(*keep, *[binning.parse_number(F.element_at("fmap", F.lit(k))).alias(f"x_{k}")
                          for k, _, _ in BUCKET_SPECS])
    return t.select(*keep, *[binning.bucketize_number(F.col(f"x_{k}"), e).cast("bigint").alias(o)
                             for k, e, o in BUCKET_SPECS])


JSON_NAMES = ("S", "Sc", "Sd", "Se", "Sm", "Mc", "Sl", "Sf", "Ss")


@query
def json_features(spark, d):
    t = fx.train_log(spark, d).select("trace_id", "user_id", "offer_id", "predictor_json")
    return feat.with_features(t, JSON_NAMES).drop("predictor_json")


@query
def sequence_features(spark, d):
    t = fx.train_log(spark, d).select("trace_id", "user_id", "offer_id", "predictor_json")
    return feat.with_sequence_features(t, ["Sq:sq"]).drop("predictor_json")


@query
def feature_defaults(spark, d):
    """Features read with defaults: ``Se`` and ``Zz`` lack in some or all bags, ``Sm`` is empty in some."""
    t = _tlog_map(spark, d)
    return t.select("trace_id", "user_id", "offer_id", feat.read_feature("Se").alias("s_se"), feat.read_feature("Sm", "int").alias("i_sm"),
                    feat.read_feature("Sf", "float").alias("x_sf"), feat.read_feature("Zz").alias("s_zz"), feat.read_feature("Zz", "float").alias("x_zz"))


@query
def label_dedup(spark, d):
    return feat.label_dedup(fx.train_log(spark, d, TRAIN_START, TRAIN_END), TRAIN_START, TRAIN_END)


@query
def offer_features(spark, d):
    return feat.offer_features(fx.train_log(spark, d, TRAIN_START, TRAIN_END), fx.catalog(spark, d), _ctr(spark, d, "zero"),
                               TRAIN_START, TRAIN_END, feat.BASE_FEATURES)


@query
def offer_features_extended(spark, d):
    return feat.offer_features(fx.train_log(spark, d, TRAIN_START, TRAIN_END), fx.catalog(spark, d), _ctr(spark, d, "floor"),
                               TRAIN_START, TRAIN_END, feat.EXTENDED_FEATURES)


# ---- corpora -------------------------------------------------------------------------------------
CORPUS_START, CORPUS_END = "19960101", "19991231"


@query
def item_sentences(spark, d):
    return corpus.item_sentences(fx.corpus_clicks(spark, d, CORPUS_START, CORPUS_END), fx.catalog(spark, d), CORPUS_START, CORPUS_END)


@query
def co_click_edges(spark, d):
    return corpus.co_click_edges(fx.interactions(spark, d, _start()), _start())


# ---- evaluation ------------------------------------------------------------------------------------
def _ordered_offers(spark, d, offers=None):
    """Offer pairs whose ``rank`` ascends along each list: the evaluation orders only what it keeps."""
    offers = _offers(spark, d) if offers is None else offers
    return offers.select("main_offer", (-F.col("score")).alias("rank"), "sim_offer")


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


SUMMARY = ("mean", "stddev", "min", "max")


def _relevance(spark, d):
    return _ctr(spark, d, "supported")


@query
def ndcg_at_k(spark, d):
    return _rounded(ev_.ndcg_at_k(_ordered_offers(spark, d), _relevance(spark, d), k=40), "ndcg")


@query
def ndcg_summary(spark, d):
    return _rounded(ev_.summary(ev_.ndcg_at_k(_ordered_offers(spark, d), _relevance(spark, d), k=40)), *SUMMARY)


@query
def evaluate_many(spark, d):
    offers = tio.stage(_offers(spark, d), "offers")  # both list sets are made of it
    return _rounded(ev_.evaluate_many({"cf_offers": _ordered_offers(spark, d, offers), "price_rerank": _price_lists(spark, d, offers=offers)},
                                      _relevance(spark, d), k=40), *SUMMARY)


@query
def evaluate_paths(spark, d):
    path = tio.scratch_path(spark, "evaluated")
    tio.write_ranked_lists(_price_lists(spark, d), path)
    return _rounded(ev_.evaluate_paths(spark, {"price_rerank": path}, _relevance(spark, d), k=40), *SUMMARY)


# ---- user recommendations --------------------------------------------------------------------------
def _window_start_s() -> int:
    return dates.window_start_seconds(AS_OF, LOOKBACK_DAYS)


def _stored_candidates(spark, d):
    """Candidates give the triggers and their entries: stored, they are made once."""
    return tio.stage(_candidates(spark, d), "candidates")


def _user_lists(spark, d):
    return rec.user_recommendations(_stored_candidates(spark, d), beh.latest_behaviour(_behaviour(spark, d)),
                                    save_count=300, min_limit=10)


@query
def user_recommendations_by_category(spark, d):
    """Triggers joined on the item's category: a user's items of one category share a list."""
    cat = fx.catalog(spark, d).select("item_id", F.col("subcate_id").alias("category"))
    items = _candidates(spark, d).join(cat, F.col("main_id") == F.col("item_id")).groupBy("category", "sim_id").agg(F.max("score").alias("score"))
    lists = tio.stage(rr.top_candidates(items.withColumnRenamed("category", "main_id"), None, n=60), "category_lists")
    b = beh.latest_behaviour(_behaviour(spark, d)).join(cat, "item_id")
    return rec.user_recommendations(lists, b, save_count=40, min_limit=10, join_key="category")


@query
def trigger_quota(spark, d):
    return rec.trigger_quota(_stored_candidates(spark, d), beh.latest_behaviour(_behaviour(spark, d)),
                             save_count=300, min_limit=10, window_start_s=_window_start_s())


@query
def user_recommendations(spark, d):
    return _user_lists(spark, d)


@query
def user_recommendations_json(spark, d):
    return rec.user_recommendations_json(_user_lists(spark, d))


# ---- bookkeeping, dates, text formats ---------------------------------------------------------------
@query
def stage_counts(spark, d):
    return sim.item_cf_stage_counts(fx.orders_log(spark, d), fx.catalog(spark, d))


@query
def day_shift(spark, d):
    e = dates.window_filter(fx.interactions(spark, d, _start()), "ymd", LOOKBACK_DAYS, AS_OF)
    return e.select("event_id", "ymd", dates.day_shift("ymd", 7).alias("ymd_back"))


@query
def hour_shift(spark, d):
    e = fx.interactions(spark, d)
    return e.select("event_id", "ymdh", dates.hour_shift("ymdh", 5).alias("ymdh_back"))


@query
def ranked_list_roundtrip(spark, d):
    path = tio.scratch_path(spark, "ranked")
    tio.write_ranked_lists(_price_lists(spark, d), path)
    return tio.read_ranked_lists(spark, path)


@query
def sim_pairs_roundtrip(spark, d):
    path = tio.scratch_path(spark, "pairs")
    tio.write_sim_pairs(_offers(spark, d), path)
    return tio.read_sim_pairs(spark, path)


@query
def scored_list_roundtrip(spark, d):
    path = tio.scratch_path(spark, "scored")
    tio.write_scored_lists(rr.price_candidates(_offers(spark, d), fx.catalog(spark, d)), path)
    return rr.rank_by_price(tio.read_scored_lists(spark, path))


@query
def staged_roundtrip(spark, d):
    return tio.stage(_item_sim(spark, d), "item_cf")


@query
def extension_roundtrip(spark, d):
    path = tio.scratch_path(spark, "extension")
    tio.write_extensions(_extensions(spark, d), path)
    return tio.read_extensions(spark, path)


@query
def edge_roundtrip(spark, d):
    path = tio.scratch_path(spark, "edges")
    tio.write_rows(corpus.co_click_edges(fx.interactions(spark, d, _start()), _start()), path, sep=" ")
    return tio.read_rows(spark, path, "src string, dst string, weight bigint", sep=" ")


@query
def sentence_roundtrip(spark, d):
    path = tio.scratch_path(spark, "sentences")
    tio.write_sentences(item_sentences(spark, d), path)
    return spark.read.text(path).select(F.col("value").alias("sentence"))


@query
def dated_table_roundtrip(spark, d):
    """Valid interactions written in folders by day; a range of days read back."""
    path = tio.scratch_path(spark, "dated")
    tables.save(valid_interactions(spark, d), path)
    t = tables.load(spark, path, ["user_id", "item_id", "offer_id", "event_time", "ymd"], "ymd", "20240112", "20240118")
    return t.withColumn("ymd", F.col("ymd").cast("string"))  # folder names are read as numbers


@query
def feature_roundtrip(spark, d):
    path = tio.scratch_path(spark, "features")
    tio.write_rows(offer_features(spark, d), path)
    return tio.read_rows(spark, path, "offer_id string, subcate_id string, month_sales bigint, features string, ctr double")


@query
def user_lists_roundtrip(spark, d):
    path = tio.scratch_path(spark, "users")
    tio.write_user_lists(user_recommendations_json(spark, d), path)
    return tio.read_user_lists(spark, path)
