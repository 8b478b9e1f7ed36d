"""Adapters from the synthetic test tables to the job input contracts.

Each frame has a twin in ``recsift.plans.oracle`` (DuckDB SQL) built from the same definitions,
so both engines see identical inputs. See FIXTURES.md for the definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.functions.dates import epoch_millis
from recsift.sources.tables import load


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, start: str | None, end: str | None) -> DataFrame:
    return load(spark, f"{sf_dir}/events.parquet", date_col="ts", start=start, end=end)


def _k(props="props"):
    return F.get_json_object(F.col(props), "$.k").cast("bigint")


def orders_log(spark, sf_dir, start=None, end=None) -> DataFrame:
    """``tx``: one row per line item, user = customer, item = part; optionally of a date range."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    o = load(spark, f"{sf_dir}/orders.parquet", date_col="o_orderdate", start=start, end=end).select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("user_id"), "o_orderdate")  # made once for an order
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        "user_id",
        F.col("l_partkey").cast("string").alias("item_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_orderdate").alias("ts"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("ymd"),
    )


def external_actions(spark, sf_dir, start=None, end=None) -> DataFrame:
    """``ext``: external action log from ``events``: errors as footprints, purchases as orders."""
    e = _events(spark, sf_dir, start, end)
    et = F.col("event_type")
    return e.select(
        F.col("user_id").cast("string").alias("user_id"),
        _k().cast("string").alias("item_id"),
        F.when(et == "error", "footprint").when(et == "purchase", "order").otherwise("other").alias("type"),
        epoch_millis("ts").alias("time"),
        F.date_format("ts", "yyyyMMdd").alias("ymd"),
    )


def interactions(spark, sf_dir, start=None, end=None) -> DataFrame:
    """``ev``: app log rows from ``events``; item = ``props.k``."""
    e = _events(spark, sf_dir, start, end).withColumn("k", _k())
    k = F.col("k")
    et = F.col("event_type")
    return e.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        k.cast("string").alias("item_id"),
        (k + 1000000).cast("string").alias("offer_id"),
        F.when(et == "click", "coupon_click").when(et == "view", "coupon_view")
         .when(et == "purchase", "buy_detail").when(et == "signup", "collect_detail")
         .when(et == "error", "footprint").alias("event_name"),
        F.when(et == "view", "view").otherwise("click").alias("event_type"),
        epoch_millis("ts").alias("event_time"),
        F.date_format("ts", "yyyyMMdd").alias("ymd"),
        F.date_format("ts", "yyyyMMddHH").alias("ymdh"),
    )


def catalog(spark, sf_dir, fan: bool = False) -> DataFrame:
    """``cat``: one catalog row per part; offer = part key + 1 000 000.

    ``fan`` adds rows: a second offer for every fourth item, a second category for every sixth.
    """
    one = _catalog(spark, sf_dir)
    if not fan:
        return one
    k = F.col("item_id").cast("bigint")
    offers = one.where(k % 4 == 0).withColumn("offer_id", (k + 2000000).cast("string"))
    categories = one.where(k % 6 == 0).withColumn("subcate_id", F.lit("Brand#99"))
    return one.unionByName(offers).unionByName(categories)


def _catalog(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    raw = F.col("p_retailprice") * ((pk % 10) + 1) / F.lit(50.0)
    return p.select(
        pk.cast("string").alias("item_id"),
        (pk + 1000000).cast("string").alias("offer_id"),
        (pk % 10).alias("shop_id"),
        F.when(pk % 20 == 19, 0).otherwise(1).alias("status"),
        F.when(F.col("p_type") == "PROMO", 2).otherwise(1).alias("product_type"),
        F.col("p_brand").alias("subcate_id"),
        F.col("p_size").alias("cate_id3"),
        (pk % 5).alias("is_recommend"),
        raw.alias("raw_price"),
        (raw * (F.lit(1) - (pk % 8) * F.lit(0.05))).alias("zk_price"),
        (F.col("p_size") * 10).alias("order_count"),
        F.col("p_size").alias("month_sales"),
        (pk % 13).alias("ticket_id"),
        F.col("p_name").alias("title"),
    )


def offer_status(spark, sf_dir, fan: bool = False) -> DataFrame:
    """``ost``: status rows for most offers (some have none); ``fan``: for the second offers too."""
    p = table(spark, sf_dir, "part")
    pk = F.col("p_partkey")
    one = p.where(pk % 23 != 22).select(
        (pk + 1000000).cast("string").alias("offer_id"),
        F.when(pk % 17 == 0, 1).otherwise(0).alias("is_del"))
    if not fan:
        return one
    return one.unionByName(p.where(pk % 4 == 0).select((pk + 2000000).cast("string").alias("offer_id"), F.lit(0).alias("is_del")))


def shops(spark, sf_dir) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    sk = F.col("s_suppkey")
    return s.select(sk.alias("shop_id"), F.when(sk % 9 == 8, 1).otherwise(0).alias("is_del"),
                    (F.lit(4.0) + (sk % 5) * F.lit(0.25)).alias("shop_score_avg"))


def tickets(spark, sf_dir) -> DataFrame:
    c = catalog(spark, sf_dir).select("ticket_id").distinct()
    return c.select("ticket_id", F.when(F.col("ticket_id") == 7, 0).otherwise(1).alias("status"))


def train_log(spark, sf_dir, start=None, end=None) -> DataFrame:
    """``tlog``: training-log rows from ``events`` with a flat JSON feature bag."""
    e = _events(spark, sf_dir, start, end).withColumn("k", _k())
    k = F.col("k")
    uid = F.col("user_id")
    n = k % 60
    seq = F.when(n == 0, F.lit("")).otherwise(
        F.array_join(F.sequence(k * 1000, k * 1000 + n - 1).cast("array<string>"), ","))
    js = F.concat(
        F.lit('{"S": '), (k + 1000000).cast("string"),
        F.lit(', "Sc": '), (k % 7).cast("string"),
        F.lit(', "Sd": '), uid.cast("string"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit(', "Se": '), (k % 11).cast("string"))),
        F.lit(', "Sm": '), F.when(k % 13 == 0, F.lit('""')).otherwise((k % 13).cast("string")),
        F.lit(', "Mc": '), (k % 6).cast("string"),
        F.lit(', "Sl": '), k.cast("string"),
        F.lit(', "Sf": '), (k * 3).cast("string"),
        F.lit(', "Ss": '), (k % 45).cast("string"),
        F.when(k % 17 == 5, F.lit("")).otherwise(F.concat(F.lit(', "Sq": "'), seq, F.lit('"'))),
        F.lit("}"),
    )
    et = F.col("event_type")
    return e.select(
        F.when(et.isin("click", "purchase"), "1").otherwise("0").alias("label"),
        js.alias("predictor_json"),
        F.expr("event_id div 4").cast("string").alias("trace_id"),
        F.when(uid % 10 == 3, uid.cast("string")).otherwise(F.lpad(uid.cast("string"), 14, "0")).alias("user_id"),
        (k + 1000000).cast("string").alias("offer_id"),
        F.when(et == "error", "search").otherwise("home_feed").alias("log_type"),
        F.date_format("ts", "yyyyMMdd").alias("day"),
    )


def corpus_clicks(spark, sf_dir, start=None, end=None) -> DataFrame:
    """``cx``: purchase lines as app click rows carrying category columns (for the corpus job)."""
    tx = orders_log(spark, sf_dir, start, end)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    j = tx.join(p, tx.item_id == p.p_partkey.cast("string"))
    ln = F.col("line_no")
    uid = F.col("user_id")
    return j.select(
        F.when(F.col("user_id").cast("bigint") % 10 == 3, uid).otherwise(F.lpad(uid, 14, "0")).alias("user_id"),
        "item_id",
        (F.col("p_partkey") + 1000000).cast("string").alias("offer_id"),
        F.when(F.col("p_partkey") % 50 == 7, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("subcate_id"),
        F.col("p_size").cast("string").alias("cate_id3"),
        F.lit("coupon_click").alias("event_name"),
        F.lit("click").alias("event_type"),
        F.when(ln % 4 == 0, "h5_subsidy").when(ln % 7 == 0, "h5_free").otherwise("home").alias("cur_page"),
        F.when(ln % 5 == 0, "home_free_list").otherwise("feed").alias("cur_module"),
        "ymd",
    )
