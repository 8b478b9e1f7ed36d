"""Hand-made edge cases for the operators (FIXTURES.md part 3)."""

import itertools
import math
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from recsift.operators import corpus, ctr, evaluate, features, filters, pairs, ranking, recommend, rerank, similarity
from recsift.sources import tables, text_io

CAT_SCHEMA = "item_id string, status int, product_type int, subcate_id string"


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _cf_inputs(spark, heavy_rows=0):
    rows = []
    for u in ["u1", "u2", "u3", "u4", "u5"]:
        rows += [(u, "A"), (u, "B"), (u, "C"), (u, "D")]
    rows += [("u6", "A"), ("u7", "A"), ("u7", "B")]
    rows += [("u8", "A" if i % 2 else "B") for i in range(heavy_rows)]
    inter = spark.createDataFrame(rows, "user_id string, item_id string")
    cat = spark.createDataFrame([("A", 1, 1, "c1"), ("A", 1, 1, "c2"), ("B", 1, 1, "c1"), ("C", 1, 1, None),
                                 ("D", 1, 1, None)], CAT_SCHEMA)
    return inter, cat


def test_item_cf_categories_null_group_and_inactive_user(spark):
    inter, cat = _cf_inputs(spark)
    out = similarity.item_cf(inter, cat)
    got = _rows(out, "item_i", "item_j", "co", "nor_i", "nor_j", "score")
    assert got == [("A", "B", 6, 6, 6, 1.0), ("B", "A", 6, 6, 6, 1.0),
                   ("C", "D", 5, 5, 5, 1.0), ("D", "C", 5, 5, 5, 1.0)]


def test_item_cf_activity_bound_only_shapes_norms(spark):
    inter, cat = _cf_inputs(spark, heavy_rows=3000)
    loose = {(r.item_i, r.item_j): r for r in similarity.item_cf(inter, cat).collect()}
    strict = {(r.item_i, r.item_j): r for r in similarity.item_cf(inter, cat, strict_users=True).collect()}
    assert loose[("A", "B")].co == 7 and loose[("A", "B")].nor_i == 6
    assert math.isclose(loose[("A", "B")].score, 7 / 6)
    assert strict[("A", "B")].co == 6 and strict[("A", "B")].score == 1.0


def test_item_cf_is_symmetric_and_bounded_by_norms(spark):
    inter, cat = _cf_inputs(spark)
    rows = similarity.item_cf(inter, cat).collect()
    keyed = {(r.item_i, r.item_j): r for r in rows}
    for (i, j), r in keyed.items():
        assert keyed[(j, i)].co == r.co
        assert r.co <= max(r.nor_i, r.nor_j) + 1


def test_stage_counts_of_full_and_empty_inputs(spark):
    inter, cat = _cf_inputs(spark, heavy_rows=3000)
    got = {r.stage: r.rows for r in similarity.item_cf_stage_counts(inter, cat).collect()}
    assert got == {"interactions": 3023, "active_users": 6, "supported_items": 4, "pair_base": 33, "directed_pairs": 4}
    got = {r.stage: r.rows for r in similarity.item_cf_stage_counts(inter, cat.limit(0)).collect()}
    assert got == {"interactions": 3023, "active_users": 6, "supported_items": 4, "pair_base": 0, "directed_pairs": 0}
    assert {r.rows for r in similarity.item_cf_stage_counts(inter.limit(0), cat).collect()} == {0}


def test_ctr_policies(spark):
    ev = []
    def add(offer, ev_name, n):
        ev.extend([("u1", "7", offer, ev_name, "20240101")] * n)
    add("o1", "coupon_click", 3)
    add("o2", "coupon_click", 2); add("o2", "coupon_view", 2)
    add("o3", "coupon_view", 5)
    add("o4", "coupon_click", 1); add("o4", "coupon_view", 12)
    log = spark.createDataFrame(ev, "user_id string, item_id string, offer_id string, event_name string, ymd string")
    z = _rows(ctr.offer_ctr(log, "zero"), "offer_id", "ctr")
    assert z == [("o3", 0.0), ("o4", 1 / 12)]
    f = dict(_rows(ctr.offer_ctr(log, "floor"), "offer_id", "ctr"))
    assert f == {"o1": 0.0001, "o2": 1.0, "o3": 0.0001, "o4": 1 / 12}
    p = _rows(ctr.offer_ctr(log, "plain"), "offer_id", "ctr")
    assert p == [("o1", None), ("o2", 1.0)]
    s = _rows(ctr.offer_ctr(log, "supported"), "offer_id", "click", "view")
    assert s == [("o4", 1, 12)]


def test_extend_lists(spark):
    schema = "main_offer string, rank bigint, sim_offer string"
    new = spark.createDataFrame([("m1", 1, "a"), ("m1", 2, "b"), ("m1", 3, "c"), ("m2", 1, "a"), ("m2", 2, "b"),
                                 ("m3", 1, "a"), ("m3", 2, "b"), ("m3", 3, "c")], schema)
    base = spark.createDataFrame([("m2", 1, "a"), ("m2", 2, "b"), ("m3", 1, "b")], schema)
    got = sorted(rerank.extend_lists(base, new).collect(), key=lambda r: (r.main_offer, r.pos or 0))
    got = [(r.main_offer, r.pos, r.sim_offer, r.has_base) for r in got]
    assert got == [("m1", 1, "a", 0), ("m1", 2, "b", 0), ("m1", 3, "c", 0), ("m2", None, None, 1),
                   ("m3", 1, "a", 1), ("m3", 2, "c", 1)]


def _cands(spark, lists):
    rows = [(main, r + 1, sim, 1.0 - r / 1000.0) for main, sims in lists.items() for r, sim in enumerate(sims)]
    return spark.createDataFrame(rows, "main_id string, rank bigint, sim_id string, score double")


def _beh(spark, rows):
    return spark.createDataFrame(rows, "user_id string, item_id string, trigger_type int, time int")


def test_user_lists_quota_dedup_cap_and_empty_trigger(spark):
    lists = {"t0": [f"x{i}" for i in range(350)]}
    for t in range(1, 41):
        lists[f"t{t}"] = [f"y{t}_{i}" for i in range(20)]
    lists["s1"] = ["p", "q", "r"]
    lists["s2"] = ["q", "p"]
    cands = _cands(spark, lists)
    beh = [("one", "t0", 1, 100)]
    beh += [("many", f"t{t}", 1, 1000 + t) for t in range(1, 41)]
    beh += [("dup", "s1", 4, 10), ("dup", "s2", 1, 20)]
    out = recommend.user_recommendations(cands, _beh(spark, beh))
    rows = out.collect()
    per_user = {}
    for r in rows:
        per_user.setdefault(r.user_id, []).append(r)
    assert sum(r.item_id is not None for r in per_user["one"]) == 300
    many = [r for r in per_user["many"] if r.item_id is not None]
    assert len(many) == 300  # 40 triggers x quota 9 = 360, cut by the per-user cap
    quota = recommend.trigger_quota(cands, _beh(spark, beh)).where("user_id = 'many'")
    per_trigger = quota.groupBy("trigger_item").count().collect()
    assert len(per_trigger) == 40 and all(r["count"] == 9 for r in per_trigger)
    one_q = recommend.trigger_quota(cands, _beh(spark, beh)).where("user_id = 'one'").count()
    assert one_q == 300
    dup = sorted(per_user["dup"], key=lambda r: (r.tpos, r.pos or 0))
    assert [(r.trigger_item, r.item_id) for r in dup] == [("s1", "p"), ("s1", "q"), ("s1", "r"), ("s2", None)]
    for u, rs in per_user.items():
        items = [r.item_id for r in rs if r.item_id is not None]
        assert len(items) == len(set(items)) and len(items) <= 300


def test_user_lists_cap_across_triggers(spark):
    lists = {f"t{t}": [f"y{t}_{i}" for i in range(20)] for t in range(1, 41)}
    cands = _cands(spark, lists)
    beh = [("cap", f"t{t}", 1, 1000 - t) for t in range(1, 41)]
    out = recommend.user_recommendations(cands, _beh(spark, beh), save_count=300, min_limit=10)
    items = [r for r in out.collect() if r.item_id is not None]
    assert len(items) == 300
    # triggers are visited latest first: t1 (time 999) leads, the last ones are cut
    kept = {r.trigger_item for r in items}
    assert "t1" in kept and "t40" not in kept


def test_ndcg_cases(spark):
    rel = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.1)], "offer_id string, ctr double")
    lists = spark.createDataFrame([("ideal", 1, "a"), ("ideal", 2, "b"), ("ideal", 3, "c"),
                                   ("rev", 1, "c"), ("rev", 2, "b"), ("rev", 3, "a"),
                                   ("gap", 1, "a"), ("gap", 2, "zz"), ("gap", 3, "b")],
                                  "main_offer string, rank bigint, sim_offer string")
    got = dict(_rows(evaluate.ndcg_at_k(lists, rel, k=40), "main_offer", "ndcg"))
    assert got["ideal"] == 1.0 and got["gap"] == 1.0
    assert 0 < got["rev"] < 1
    g = lambda r: 2 ** r - 1
    dcg = g(0.1) / math.log(2) + g(0.3) / math.log(3) + g(0.5) / math.log(4)
    idcg = g(0.5) / math.log(2) + g(0.3) / math.log(3) + g(0.1) / math.log(4)
    assert math.isclose(got["rev"], dcg / idcg)
    summ = evaluate.summary(evaluate.ndcg_at_k(lists, rel, k=40)).first()
    assert summ.n == 3 and summ.max == 1.0


def test_item_sentences_lengths_and_cap(spark):
    rows = []
    def clicks(user, n, offset=0):
        for i in range(n):
            rows.append((user, f"{1000000 + offset + i}", f"s{(offset + i) % 1000:03d}"))
    clicks("u0000000000004", 4)
    clicks("u0000000000005", 5)
    clicks("u0000000000101", 101, offset=100)
    df = spark.createDataFrame(rows, "user_id string, offer_id string, subcate_id string").select(
        "*", F.lit("x").alias("cate_id3"), F.lit("coupon_click").alias("event_name"), F.lit("click").alias("event_type"),
        F.lit("home").alias("cur_page"), F.lit("feed").alias("cur_module"), F.lit("20240101").alias("ymd"))
    live = [(f"{1000000 + i}",) for i in range(300) if i != 200]  # the top-ranked 101-user offer is not live
    cat = spark.createDataFrame(live, "offer_id string").withColumn("status", F.lit(1))
    out = {r.user_id: r for r in corpus.item_sentences(df, cat, "20240101", "20240101").collect()}
    assert "u0000000000004" not in out
    assert out["u0000000000005"].n_tokens == 5
    # the cap of 100 applies before the live-offer join: one of the top 100 is not live
    assert out["u0000000000101"].n_tokens == 99
    toks = out["u0000000000005"].sentence.split(" ")
    assert toks == sorted(toks, key=lambda t: t.split(":")[1])


def test_sim_pairs_text_source(spark, tmp_path):
    p = tmp_path / "pairs"
    p.mkdir()
    (p / "part-0.txt").write_text("a\tb\n" "a\tc\t0.5\n" "a\td\t0.1\textra\n" "a\te\tnot-a-number\n" "a\tf\t\n")
    got = _rows(text_io.read_sim_pairs(spark, str(p)), "main_id", "sim_id", "score")
    assert got == [("a", "c", 0.5)]


def test_ranked_list_text_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("m", 2, "b"), ("m", 1, "a"), ("n", 1, "z")], "main_offer string, rank bigint, sim_offer string")
    path = str(tmp_path / "lists")
    text_io.write_ranked_lists(df, path)
    lines = sorted(r.value for r in spark.read.text(path).collect())
    assert lines == ["m\ta,b", "n\tz"]
    got = _rows(text_io.read_ranked_lists(spark, path), "main_id", "pos", "sim_id")
    assert got == [("m", 1, "a"), ("m", 2, "b"), ("n", 1, "z")]


def test_swing_overlap_chunking_is_exact(spark):
    rows = [(f"u{u}", f"i{(u * 7 + k) % 12}") for u in range(30) for k in range(5)]
    orders = spark.createDataFrame(rows, "user_id string, item_id string")
    a = similarity.swing_scores(orders, max_array=512).select("item_i", "item_j", F.round("score", 9).alias("s"))
    b = similarity.swing_scores(orders, max_array=2).select("item_i", "item_j", F.round("score", 9).alias("s"))
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_swing_overlap_of_a_basket_of_100000_items_is_exact(spark):
    """Chunks nest: a basket of 256 chunks meets one of 1 and one of 2 chunks, each item counted once."""
    items = spark.range(100_000).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("item_id"), "id")
    ui = items.select(F.lit("big").alias("user_id"), "item_id").unionByName(items.where("id % 100 < 1").select(F.lit("mid").alias("user_id"), "item_id"))
    ui = ui.unionByName(items.where("id % 20000 = 3").select(F.lit("few").alias("user_id"), "item_id"))
    needed = spark.createDataFrame([("big", "mid"), ("big", "few"), ("few", "mid"), ("big", "big")], "u string, v string")
    got = _rows(similarity._user_overlaps(needed, ui, 512), "u", "v", "overlap")
    assert got == [("big", "big", 100_000), ("big", "few", 5), ("big", "mid", 1000), ("few", "mid", 0)]


def test_users_of_a_popular_pair_are_cut_not_gathered(spark):
    rows = [(f"u{k:05d}", "A", "B") for k in range(5000)] + [(f"u{k:05d}", "A", "C") for k in range(99)] + [("u1", "B", "C"), ("u2", "B", "C")]
    pu = spark.createDataFrame(rows, "user_id string, item_i string, item_j string").repartition(8)
    users = similarity._pair_users(pu, 3, 99)
    assert [(r.item_i, r.item_j, len(r.us)) for r in users.collect()] == [("A", "C", 99)]
    assert "WindowGroupLimit" in users._jdf.queryExecution().executedPlan().toString()


def test_category_key_shares_a_list_between_triggers(spark):
    cands = _cands(spark, {"c1": ["a", "b"], "c2": ["b", "z"]})
    beh = spark.createDataFrame([("u", "i1", "c1", 2, 50), ("u", "i2", "c1", 2, 40), ("u", "i3", "c2", 1, 60)],
                                "user_id string, item_id string, category string, trigger_type int, time int")
    out = recommend.user_recommendations(cands, beh, join_key="category")
    got = _rows(out, "tpos", "trigger_item", "time", "pos", "item_id")
    assert got == [(1, "c1", 50, 1, "a"), (1, "c1", 50, 2, "b"), (2, "c1", 40, None, None), (3, "c2", 60, 1, "z")]


@pytest.mark.parametrize("modules,kept", [((), {"bad1", "bad2", "ok"}), (("bad1",), {"bad2", "ok"}), (("bad1", "bad2"), {"ok"})])
def test_sentence_exclusion_lists(spark, modules, kept):
    rows = [(f"user{m:>10}", f"10{i}", f"s{i}", m) for m in ("bad1", "bad2", "ok") for i in range(6)]
    df = spark.createDataFrame(rows, "user_id string, offer_id string, subcate_id string, cur_module string").select(
        "*", F.lit("x").alias("cate_id3"), F.lit("coupon_click").alias("event_name"), F.lit("click").alias("event_type"),
        F.lit("home").alias("cur_page"), F.lit("20240101").alias("ymd"))
    cat = spark.createDataFrame([(f"10{i}",) for i in range(6)], "offer_id string").withColumn("status", F.lit(1))
    out = corpus.item_sentences(df, cat, "20240101", "20240101", excluded_modules=modules, excluded_pages=modules)
    assert {r.user_id[4:].strip() for r in out.collect()} == kept


def test_pairs_of_a_hot_group_are_exact_and_spread(spark):
    rows = [("hot", f"i{k:04d}", k) for k in range(600)] + [(f"u{k}", f"i{k % 7:04d}", k % 7) for k in range(50)] + [(None, "i1", 1), ("n", None, 2)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, size int")
    got = pairs.basket_pairs(df, ["user_id"], carry=["size"], block_items=64)
    assert got.where("user_id = 'hot'").count() == 600 * 599 // 2
    assert got.distinct().count() == got.count() and got.where("item_i >= item_j OR size_i >= size_j").count() == 0
    groups = got.where("user_id = 'hot'").groupBy(F.pmod(F.xxhash64("item_i"), F.lit(10)), F.pmod(F.xxhash64("item_j"), F.lit(10))).count()
    assert groups.count() > 50  # many block pairs, each a join key of its own


def test_frequency_index_is_the_global_rank(spark):
    import random
    r = random.Random(3)
    values = [f"{'abcdefgh'[int(r.expovariate(0.5)) % 8] * r.randint(1, 6)}{int(r.expovariate(0.1))}" for _ in range(3000)] + [None] * 5
    got = {x.v: (x.n, x.idx) for x in features.frequency_index(spark.createDataFrame([(v,) for v in values], "v string"), "v").collect()}
    count = {v: values.count(v) for v in set(values)}
    order = sorted(count, key=lambda v: (-count[v], v is not None, v or ""))
    assert got == {v: (count[v], i) for i, v in enumerate(order)}


def test_frequency_index_of_values_seen_once_with_a_common_prefix_spreads(spark):
    values = spark.range(40_000).select(F.concat(F.lit("same-prefix-"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("v"))
    kept = {}
    stage = features.stage
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would be one partition
    try:
        features.stage = lambda df, name: kept.setdefault("t", stage(df, name))
        got = features.frequency_index(values, "v").orderBy("idx").collect()
    finally:
        features.stage = stage
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r.v for r in got] == sorted(r.v for r in got) and [r.idx for r in got] == list(range(40_000))
    sizes = [r["count"] for r in kept["t"].groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 30_000


def test_extension_marks_and_lists_of_one_side(spark):
    schema = "main_offer string, rank bigint, sim_offer string"
    new = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 3, "z")], schema)
    base = spark.createDataFrame([("a", 1, "z"), ("a", 2, "x"), ("only_base", 1, "x")], schema)
    assert _rows(rerank.extend_lists(base, new, depth=2), "main_offer", "pos", "sim_offer", "has_base") == [("a", 1, "y", 1)]
    assert rerank.extend_lists(base, new.limit(0)).collect() == []


def test_quota_of_zero_keeps_the_trigger(spark):
    cands = _cands(spark, {"t1": ["a", "b"], "t2": ["a", "c"]})
    out = recommend.user_recommendations(cands, _beh(spark, [("u", "t1", 1, 10), ("u", "t2", 1, 5)]), save_count=1, min_limit=1)
    assert _rows(out, "tpos", "trigger_item", "pos", "item_id") == [(1, "t1", None, None), (2, "t2", None, None)]


def test_features_read_with_defaults(spark):
    rows = [(1, '{"s": "x", "i": 7, "f": 2.5}'), (2, '{"s": null, "i": null, "f": null}'), (3, "{}"), (4, None), (5, '{"s": "", "i": "no", "f": " 3 "}')]
    t = spark.createDataFrame(rows, "id int, predictor_json string").withColumn("fmap", features.feature_map())
    got = _rows(t.select("id", features.read_feature("s").alias("s"), features.read_feature("i", "int").alias("i"), features.read_feature("f", "float").alias("f")), "id", "s", "i", "f")
    assert got == [(1, "x", 7, 2.5), (2, "null", 0, 0.0), (3, "None", 0, 0.0), (4, "None", 0, 0.0), (5, "", 0, 3.0)]


def test_a_day_is_written_again_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.save(spark.createDataFrame([("20240101", 1), ("20240102", 2)], "ymd string, n int"), path)
    tables.save(spark.createDataFrame([("20240102", 5), ("20240103", 3)], "ymd string, n int"), path)
    got = tables.load(spark, path, ["ymd", "n"], "ymd", "20240101", "20240103")
    assert sorted((str(r.ymd), r.n) for r in got.collect()) == [("20240101", 1), ("20240102", 5), ("20240103", 3)]


def test_ranks_of_a_hot_group_come_from_many_tasks(spark):
    rows = spark.range(300_000).select(F.lit("hot").alias("m"), F.concat(F.lit("o"), F.col("id").cast("string")).alias("o"), (F.col("id") % 7).alias("s"))
    rows = rows.unionByName(spark.range(50_000).select(F.concat(F.lit("warm"), (F.col("id") % 2).cast("string")).alias("m"), F.col("id").cast("string").alias("o"), F.lit(1).alias("s")))
    rows = rows.unionByName(spark.range(3000).select((F.col("id") % 500).cast("string").alias("m"), F.col("id").cast("string").alias("o"), F.lit(2).alias("s")))
    order = [F.col("s").desc(), F.col("o").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    kept, real = {}, ranking.stage
    try:
        ranking.stage = lambda df, name: kept.setdefault(name, real(df, name))
        got = ranking.ranked(rows, "m", order, hot_rows=20_000)
        want = rows.withColumn("rank", F.row_number().over(Window.partitionBy("m").orderBy(*order)).cast("bigint"))
        assert got.count() == 353_000 and got.select("m", "o", "s", "rank").exceptAll(want.select("m", "o", "s", "rank")).count() == 0
    finally:
        ranking.stage = real
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = [r["count"] for r in kept["ranges"].where("m = 'hot'").groupBy(F.shiftright("_at", 33)).count().collect()]
    assert len(ranges) > 2 and max(ranges) < 150_000


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([("m1", 2, "b", 0), ("m1", 1, "a", 0), ("m2", None, None, 1)], "main_offer string, pos bigint, sim_offer string, has_base int")
    text_io.write_extensions(df, str(tmp_path / "x"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "x")).collect()) == ["m1\ta,b\t0", "m2\t\t1"]
    assert sorted(map(tuple, text_io.read_extensions(spark, str(tmp_path / "x")).collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    rows = spark.createDataFrame([("a", None, 1.5), ("b", 3, None)], "a string, n bigint, x double")
    text_io.write_rows(rows, str(tmp_path / "r"))
    assert sorted(map(tuple, text_io.read_rows(spark, str(tmp_path / "r"), "a string, n bigint, x double").collect())) == [("a", None, 1.5), ("b", 3, None)]
    text_io.write_user_lists(rows.limit(0), str(tmp_path / "off"), enabled=False)
    assert not (tmp_path / "off").exists()


def test_load_prunes_by_date(spark, tmp_path):
    df = spark.createDataFrame([(str(20240100 + d), d) for d in range(1, 11)], "ymd string, n int")
    df.write.partitionBy("ymd").parquet(str(tmp_path / "t"))
    got = tables.load(spark, str(tmp_path / "t"), ["n"], "ymd", "20240103", "20240105")
    assert sorted(r.n for r in got.collect()) == [3, 4, 5] and got.columns == ["n"]


def test_staging_needs_a_shared_folder_off_local_masters(monkeypatch):
    from recsift.plans import session

    class Context:
        master = "spark://somewhere:7077"

        class _jsc:
            sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))})())

    fake = type("Session", (), {"conf": type("C", (), {"get": staticmethod(lambda k, d=None: None)}), "sparkContext": Context})
    with pytest.raises(ValueError):
        session.staging_dir(fake)


def _brute_support(rows, lo, hi):
    held = {}
    for u, i in rows:
        held.setdefault(u, set()).add(i)
    n = {}
    for items in held.values():
        for i, j in itertools.combinations(sorted(items), 2):
            n[i, j] = n.get((i, j), 0) + 1
    return sorted((i, j, c) for (i, j), c in n.items() if lo <= c <= hi)


@pytest.mark.parametrize("hot,block", [(200_000, 256), (0, 256), (60, 256), (60, 3), (200_000, 3)])
def test_swing_pairs_with_hot_items_and_blocks(spark, monkeypatch, hot, block):
    """Items that gather, items that do not and baskets of several blocks give every supported pair once."""
    rows = [(f"u{u}", f"i{i}") for u in range(30) for i in range(20) if (u * 7 + i * i * 3 + u * i) % (2 + i % 5) == 0]
    monkeypatch.setattr(similarity, "BLOCK_ITEMS", block)
    ui = similarity._active_baskets(spark.createDataFrame(rows, "user_id string, item_id string"), 1)
    pu = similarity._swing_user_pairs(ui, 3, hot)
    assert pu.count() == pu.distinct().count()
    got = similarity._pair_users(pu, 3, 9).selectExpr("item_i", "item_j", "size(us)").collect()
    assert sorted(map(tuple, got)) == _brute_support(rows, 3, 9)


def test_swing_pairs_ship_only_supported_ones(spark):
    """Pairs held by too few users never become rows, however many a basket makes."""
    rows = [(f"u{u}", f"i{u}_{i}") for u in range(4) for i in range(60)] + [(f"u{u}", x) for u in range(4) for x in ("a", "b")]
    rows += [(f"v{u}", f"i{u % 4}_{i}") for u in range(8) for i in range(60) if (i + u) % 3]
    ui = similarity._active_baskets(spark.createDataFrame(rows, "user_id string, item_id string"), 1)
    support = {(i, j) for i, j, _ in _brute_support(rows, 3, 10**6)}
    got = similarity._swing_user_pairs(ui, 3).collect()
    assert {(r["item_i"], r["item_j"]) for r in got} == support and ("a", "b") in support


def test_swing_pairs_survive_equal_hashes(spark, monkeypatch):
    """Where the hash tells nothing apart, pairs and supports are still exact."""
    rows = [(f"u{u}", f"i{i}") for u in range(12) for i in range(9) if (u + i) % 3]
    monkeypatch.setattr(similarity.F, "hash", lambda *c: F.lit(7))
    for block in (256, 2):
        monkeypatch.setattr(similarity, "BLOCK_ITEMS", block)
        ui = similarity._active_baskets(spark.createDataFrame(rows, "user_id string, item_id string"), 1)
        got = similarity._pair_users(similarity._swing_user_pairs(ui, 3), 3, 99).selectExpr("item_i", "item_j", "size(us)").collect()
        assert sorted(map(tuple, got)) == _brute_support(rows, 3, 99)


def test_cf_activity_counts_rows_not_items(spark):
    """Repeated rows make a user active; an item's support and pairs count the user once."""
    rows = [("r", "a")] * 3 + [("r", "b")] + [("s", "a")] * 2 + [("t", "a"), ("t", "b"), ("t", "b")] + [("one", "b")]
    log = spark.createDataFrame(rows, "user_id string, item_id string")
    cat = spark.createDataFrame([(x, 1, 1, c) for x in "ab" for c in ("c", "c", "d")], "item_id string, status int, product_type int, subcate_id string")
    got = similarity.item_cf(log, cat, min_support=2).orderBy("item_i").select("item_i", "item_j", "co", "nor_i", "nor_j").collect()
    assert [tuple(r) for r in got] == [("a", "b", 4, 3, 2), ("b", "a", 4, 2, 3)]
    strict = similarity.item_cf(log, cat, min_user_rows=4, min_support=1, strict_users=True).collect()
    assert {(r["item_i"], r["co"], r["nor_i"]) for r in strict} == {("a", 2, 1), ("b", 2, 1)}


def test_cf_base_is_shuffled_by_user_and_item_only(spark):
    """The pair base takes no other shuffle of the log, and no hash table of all rows."""
    log = spark.createDataFrame([("u", "a")], "user_id string, item_id string")
    cat = spark.createDataFrame([("a", 1, 1, "c")], "item_id string, status int, product_type int, subcate_id string")
    plan = similarity._cf_base(log, cat, 2, 2000, 5, "subcate_id", True)._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") + plan.count("RepartitionBy") <= 2 and plan.count("HashAggregate") <= 2


def test_pairs_of_small_groups_need_no_second_shuffle(spark):
    """A group of one block gives its pairs where it was counted; the tasks that make them are not merged by bytes."""
    rows = [(g, f"i{k:02d}", k) for g, n in (("one", 1), ("full", 8), ("over", 9), (None, 3)) for k in range(n)] + [("full", "i00", 0)]
    df = spark.createDataFrame(rows, "g string, item_id string, size int")
    got = pairs.basket_pairs(df, ["g"], carry=["size"], distinct=False, nullable_groups=["g"], block_items=9)
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    want = sorted((g or "", f"i{a:02d}", f"i{b:02d}", a, b) for g, n in (("full", 8), ("over", 9), (None, 3)) for b in range(n) for a in range(b)
                  for _ in range(2 if g == "full" and a == 0 else 1))
    for block in (9, 8, 2):
        got = pairs.basket_pairs(df, ["g"], carry=["size"], distinct=False, nullable_groups=["g"], block_items=block).collect()
        assert sorted((r["g"] or "", *r[1:]) for r in got) == want


def _joins(df, col):
    return df._jdf.queryExecution().executedPlan().toString().count(f"hashpartitioning({col}#")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distinct_offers_are_dealt_by_the_main_offer_once(spark, no_broadcast):
    sim = spark.createDataFrame([("a", "b", 0.5), ("a", "c", 0.5), ("a", "d", 0.25), ("a", "b", 0.5), ("b", "a", None), ("c", "a", float("nan"))],
                                "item_i string, item_j string, score double")
    # b, c and d share an offer, which two rows give to b; a has two offers.
    servable = spark.createDataFrame([("b", "x"), ("b", "x"), ("c", "x"), ("d", "x"), ("d", "y"), ("a", "m")], "item_id string, offer_id string")
    cat = spark.createDataFrame([(i, o, 1, 1, 2.0, 1.0, 20) for i, o in (("a", "m"), ("a", "n"), ("b", "x"))],
                                "item_id string, offer_id string, status int, product_type int, raw_price double, zk_price double, month_sales int")
    offers = rerank.translate_and_filter(sim, servable, cat)
    assert sorted(map(tuple, offers.collect())) == sorted((m, *r) for m in "mn" for r in (("x", 0.5), ("x", 0.25), ("y", 0.25)))
    assert _joins(rerank.price_candidates(offers, cat), "main_offer") == 2  # the pairs once, for distinct and price, and the prices


def test_ctr_rerank_takes_both_tables_of_the_candidate_in_one_shuffle(spark, no_broadcast, monkeypatch):
    offers = spark.createDataFrame([("m", "x", 0.5)], "main_offer string, sim_offer string, score double")
    ctr_ = spark.createDataFrame([("x", 0.5)], "offer_id string, ctr double")
    cat = spark.createDataFrame([(o, 1, 1, 2.0, 1.0, 20) for o in "mx"],
                                "offer_id string, status int, product_type int, raw_price double, zk_price double, month_sales int")
    monkeypatch.setattr(rerank, "ranked", lambda df, *a, **k: df.withColumn("rank", F.lit(1)))
    got = rerank.ctr_rerank(offers, ctr_, cat)
    assert _joins(got, "sim_offer") == 3  # the pairs once, click rates, prices
    assert [tuple(r) for r in got.collect()] == [("m", 1, "x", 25.0)]


def test_symmetric_pairs_are_looked_up_once_for_both_directions(spark, no_broadcast):
    """The same offer pairs as from directed pairs, with several, shared, repeated and null offers, and fewer pairs shuffled."""
    half = [("a", "b", 0.5), ("a", "c", 0.25), ("b", "d", 0.5), ("c", "d", float("nan")), ("b", "c", 0.125), ("a", "gone", 0.5)]
    sim = spark.createDataFrame(half + [(j, i, s) for i, j, s in half], "item_i string, item_j string, score double")
    servable = spark.createDataFrame([("b", "x"), ("b", "x"), ("c", "x"), ("d", "y"), ("a", "m"), ("c", None), (None, "z")], "item_id string, offer_id string")
    cat = spark.createDataFrame([("a", "m", 1), ("a", "n", 1), ("b", "x", 1), ("b", "x", 1), ("c", "x", 0), ("c", None, 1), ("d", "y", 1), ("d", "k", 1)],
                                "item_id string, offer_id string, status int")
    some = lambda *ids: spark.createDataFrame([(i,) for i in ids] + [(ids[0],)], "offer_id string")
    for distinct in (True, False):
        rows = lambda **k: sorted(map(tuple, rerank.translate_and_filter(sim, servable, cat, distinct, **k).collect()))
        want = rows()
        assert len(want) > 5 and rows(symmetric=True) == want
        few = [r for r in want if r[1] in ("x", "m")]
        assert few and rows(kept=some("x", "m")) == few == rows(symmetric=True, kept=some("x", "m"))
    plan = rerank.translate_and_filter(sim, servable, cat, symmetric=True)._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Filter .*item_i#\d+ < item_j#\d+", plan)


@pytest.mark.parametrize("table", ["price", "ctr"])
def test_offers_dropped_later_do_not_meet_pairs(spark, table):
    """Ranked lists are the same with and without the offers that the re-rank keeps named beforehand."""
    items = "abcdef"
    half = [(i, j, 1 / (ord(i) + ord(j))) for i in items for j in items if i < j]
    sim = spark.createDataFrame(half + [(j, i, s) for i, j, s in half], "item_i string, item_j string, score double")
    # b is of another type, c sells little, d has no discount, e has a null price, f is off; g gives c's offer better sales.
    cat = spark.createDataFrame([("a", "oa", 1, 1, 2.0, 1.0, 20), ("b", "ob", 1, 2, 2.0, 1.0, 20), ("c", "oc", 1, 1, 2.0, 1.0, 5), ("d", "od", 1, 1, 1.0, 1.0, 20),
                                 ("e", "oe", 1, 1, 2.0, None, 20), ("f", "of", 0, 1, 2.0, 1.0, 20), ("g", "oc", 1, 1, 4.0, 1.0, 30)],
                                "item_id string, offer_id string, status int, product_type int, raw_price double, zk_price double, month_sales int")
    ctr_ = spark.createDataFrame([("oa", 0.5), ("oc", None), ("oc", 0.25), ("od", 0.5), ("oe", None)], "offer_id string, ctr double")
    servable = cat.select("item_id", "offer_id")
    kept = rerank.price_offers(cat) if table == "price" else rerank.ctr_offers(ctr_)
    distinct = table == "price"
    rank = (lambda o: rerank.price_rerank(o, cat)) if distinct else lambda o: rerank.ctr_rerank(o, ctr_, cat)
    want = sorted(map(tuple, rank(rerank.translate_and_filter(sim, servable, cat, distinct)).collect()))
    few = rerank.translate_and_filter(sim, servable, cat, distinct, symmetric=True, kept=kept)
    assert want and sorted(map(tuple, rank(few).collect())) == want
    assert {r["sim_offer"] for r in few.collect()} == ({"oa", "oc"} if distinct else {"oa", "oc", "od"})


def test_ranks_when_groups_share_a_bucket(spark, monkeypatch):
    """A bucket with many rows is not a large group: its groups are counted one by one."""
    rows = spark.createDataFrame([(f"g{k % 9}" if k % 2 else "big", k) for k in range(400)] + [(None, 1)], "m string, x int")
    for buckets, hot in ((1, 100), (1, 300), (65_536, 100), (65_536, 500)):
        monkeypatch.setattr(ranking, "BUCKETS", buckets)
        got = ranking.ranked(rows, "m", [F.col("x").asc()], hot_rows=hot).collect()
        want = {}
        for m in {r["m"] for r in got}:
            want |= {(m, x): n for n, x in enumerate(sorted(r["x"] for r in got if r["m"] == m), 1)}
        assert len(got) == 401 and all(r["rank"] == want[r["m"], r["x"]] for r in got)


def test_wide_groups_are_told_before_rows_are_sorted(spark):
    """Pairs are the same with the mark; both parts read one shuffle."""
    rows = [(g, f"i{k:02d}", n > 4) for g, n in (("one", 1), ("s", 4), ("w", 9), ("v", 3), (None, 7)) for k in range(n)]
    df = text_io.stage(spark.createDataFrame([(g, i, w or g == "v") for g, i, w in rows], "g string, item_id string, w boolean"), "wide")
    for block in (4, 5, 9):
        want = pairs.basket_pairs(df, ["g"], distinct=False, nullable_groups=["g"], block_items=block).collect()
        got = pairs.basket_pairs(df, ["g"], distinct=False, nullable_groups=["g"], block_items=block, wide="w")
        assert sorted((r["g"] or "", *r[1:]) for r in got.collect()) == sorted((r["g"] or "", *r[1:]) for r in want) and len(want) == 6 + 36 + 3 + 21
        # Where no group is large, the plan drops that part once the shuffle is done.
        assert block == 9 or "ReusedExchange" in got._jdf.queryExecution().executedPlan().toString()


def test_user_entries_take_one_shuffle(spark, no_broadcast):
    cand = spark.createDataFrame([("a", 1, "x", 0.5), ("a", 2, "y", 0.5), ("b", 1, "x", 0.5)], "main_id string, rank int, sim_id string, score double")
    beh = spark.createDataFrame([("u", "a", 2, 5), ("u", "b", 1, 5)], "user_id string, item_id string, trigger_type int, time int")
    out = recommend.user_recommendations(cand, beh)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(user_id#") == 2  # behaviour and entries
    assert [(r["trigger_item"], r["pos"], r["item_id"]) for r in out.orderBy("tpos", "pos").collect()] == [("a", 1, "x"), ("a", 2, "y"), ("b", None, None)]


def test_item_of_a_log_row_is_tested_once(spark):
    log = spark.createDataFrame([("u", '{"k": "7"}'), ("u", '{"k": "0"}'), ("u", '{"k": ""}'), ("u", "{}"), ("", '{"k": "7"}'), (None, '{"k": "8"}')], "user_id string, p string")
    got = filters.valid_interactions(log.withColumn("item_id", F.get_json_object("p", "$.k")), event_name=None).select("user_id")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1 and got.count() == 1


def test_swing_baskets_move_once_a_block_not_once_a_pair(spark, monkeypatch):
    """A user with pairs to many users sends the basket to the blocks of those users; scores are those of brute force."""
    rows = [(f"u{u}", f"i{i}") for u in range(40) for i in range(12) if (u * i + u // 3) % 4 != 1] + [("big", f"i{i}") for i in range(12)] + [("big", f"x{i}") for i in range(20)]
    held = {}
    for u, i in rows:
        held.setdefault(u, set()).add(i)
    pairs = {}
    for u in held:
        for p in itertools.combinations(sorted(held[u]), 2):
            pairs.setdefault(p, []).append(u)
    added = lambda us: list(itertools.accumulate(sorted(1 / (1.0 + len(held[u] & held[v])) for u, v in itertools.combinations(us, 2))))[-1]
    want = {p: added(us) for p, us in pairs.items() if 3 <= len(us) <= 99}
    orders = spark.createDataFrame(rows, "user_id string, item_id string")
    ui = similarity._active_baskets(orders, 2)
    lists = similarity._pair_users(similarity._swing_user_pairs(ui, 3), 3, 99).withColumn("pair", F.monotonically_increasing_id())
    for most, combinations in ((512, 400_000), (512, 50), (20, 400_000)):
        monkeypatch.setattr(similarity, "TASK_COMBINATIONS", combinations)
        met = similarity._met_users(similarity.stage(lists, "test_lists").select("pair", "us"), ui, most).collect()
        assert {(r.u, r.v, r.overlap) for r in met} == {(u, v, None if max(len(held[u]), len(held[v])) > most else len(held[u] & held[v]))
                                                       for us in (pairs[p] for p in want) for u, v in itertools.combinations(sorted(us), 2)}
        assert len(met) == sum(len(pairs[p]) * (len(pairs[p]) - 1) // 2 for p in want)
        got = {(r.item_i, r.item_j): r.score for r in similarity.swing_scores(orders, max_array=most).collect()}
        assert got == want


def test_swing_baskets_take_one_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(similarity, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    similarity._active_baskets(spark.createDataFrame([("u", "a"), ("u", "b"), ("u", "a")], "user_id string, item_id string"), 2)
    assert plans[0].count("Exchange") == 1


@pytest.mark.parametrize("short", [0, 1 << 14])
def test_swing_short_and_long_hashes_give_the_same_pairs(spark, monkeypatch, short):
    rows = [(f"u{u}", f"i{i}") for u in range(12) for i in range(9) if (u + i) % 3]
    # The last 16 bits tell nothing apart, the others do.
    monkeypatch.setattr(similarity.F, "hash", lambda c: F.crc32(F.col(c).cast("binary")).bitwiseAND(0x7FFF0000).cast("int"))
    monkeypatch.setattr(similarity, "SHORT_ENTRIES", short)
    for block in (256, 2):
        monkeypatch.setattr(similarity, "BLOCK_ITEMS", block)
        ui = similarity._active_baskets(spark.createDataFrame(rows, "user_id string, item_id string"), 1)
        got = similarity._pair_users(similarity._swing_user_pairs(ui, 3), 3, 99).selectExpr("item_i", "item_j", "size(us)").collect()
        assert sorted(map(tuple, got)) == _brute_support(rows, 3, 99)
