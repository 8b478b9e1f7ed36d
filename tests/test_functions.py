"""Hand-made cases for the column functions (hashing, bucketing, prices, dates)."""

from pyspark.sql import functions as F

from recsift.functions import binning, catalog, dates, hashing


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def fold(s):
    h = 0
    for ch in s:
        h = (h * 131 + ord(ch)) & 0xFFFFFFFF
    h = h - (1 << 32) if h >= (1 << 31) else h   # 32-bit wrap like the JVM int fold
    return (h & 0x7FFFFFFF) % 134217728


def test_hash_known_value(spark):
    assert one(spark, hashing.hash_feature("S", F.lit("12345"))) == "12345:79831756"
    assert hashing.fold_text("S:12345") == 79831756


def test_hash_matches_wrapping_int_fold(spark):
    for s in ["S:12345", "Sd:00000000000149", "sq:0", "Sm:", "x:a:b", "long" * 40]:
        assert hashing.fold_text(s) == fold(s)
        assert one(spark, hashing.bkdr_hash(F.lit(s))) == fold(s)


def test_hash_empty_value_and_colons(spark):
    assert one(spark, hashing.hash_feature("S", F.lit(""))) == f"-1:{fold('S:')}"
    assert one(spark, hashing.hash_feature("S", F.lit("a:b"))) == f"a:{fold('S:a:b')}"
    assert one(spark, hashing.hash_feature("S", F.lit(":::"))) == f"-1:{fold('S::::')}"
    assert one(spark, hashing.hash_feature("S", F.lit(":x"))) == f":{fold('S::x')}"


def test_bucketize_cases(spark):
    edges = binning.SCORE_EDGES
    cases = {"-0.1": -1, "0": 1, "2.9": 1, "4": 4, "5": 14, "9": 14, "abc": -1, "1e5": -1, "5.": -1, ".5": 1}
    for v, want in cases.items():
        assert one(spark, binning.bucketize(F.lit(v), edges)) == want, v


def test_bucket_is_the_number_of_edges_up_to_the_value(spark):
    for edges in (binning.SCORE_EDGES, binning.RATE_EDGES, binning.PRICE_EDGES, binning.COMMISSION_EDGES):
        values = [e + d for e in edges for d in (-0.01, 0.0, 0.01)] + [-5.0, -1.0, 1e6]
        df = spark.createDataFrame([(v,) for v in values], "x double")
        got = {r.x: r.b for r in df.select("x", binning.bucketize_number(F.col("x"), edges).alias("b")).collect()}
        for v in values:
            below = [e for e in edges if e <= v]
            assert got[v] == (len(below) if below else -1), (edges, v)


def test_hash_sequence_padding(spark):
    pad = hashing.hashed_constant("sq", "0")
    empty = one(spark, hashing.hash_sequence(F.lit(""), "sq"))
    assert empty == ",".join([pad] * 50) + ",0"
    assert one(spark, hashing.hash_sequence(F.lit("-1"), "sq")) == empty
    three = one(spark, hashing.hash_sequence(F.lit("7,8,9"), "sq")).split(",")
    assert len(three) == 51 and three[-1] == "3" and three[3:50] == [pad] * 47
    assert three[0] == f"7:{fold('sq:7')}"
    sixty = one(spark, hashing.hash_sequence(F.lit(",".join(str(i) for i in range(60))), "sq")).split(",")
    assert len(sixty) == 51 and sixty[-1] == "50" and sixty[49] == f"49:{fold('sq:49')}"
    # trailing empty pieces are dropped like a Java split
    assert one(spark, hashing.hash_sequence(F.lit("7,8,"), "sq")).endswith(",2")


def test_price_band_limits(spark):
    # strict '<' against main * multiplier; bands switch at 50 and 100
    rows = [(49.99, 49.99 * 1.6, False), (49.99, 49.99 * 1.6 - 0.01, True), (50.0, 75.0, False),
            (50.0, 74.99, True), (99.99, 99.99 * 1.5 - 0.001, True), (100.0, 140.0, False), (100.0, 139.99, True)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "main double, cand double")
    got = [r["x"] for r in df.select(catalog.in_price_band("main", "cand").alias("x")).collect()]
    assert got == [w for _, _, w in rows]


def test_effective_price_and_trigger_type(spark):
    df = spark.createDataFrame([(0.0, 9.0, "coupon_click"), (None, 8.0, "footprint"), (5.0, 9.0, "other")],
                               "zk double, raw double, ev string")
    got = df.select(catalog.effective_price("zk", "raw").alias("p"), catalog.trigger_type("ev").alias("t")).collect()
    assert [(r.p, r.t) for r in got] == [(9.0, 1), (8.0, 4), (5.0, 0)]


def test_dates(spark):
    assert one(spark, dates.day_shift(F.lit("20240301"), 1)) == "20240229"
    assert one(spark, dates.hour_shift(F.lit("2024030102"), 5)) == "2024022921"
    assert dates.window_start("20240131", 30) == "20240101"
    assert one(spark, dates.age_days(F.lit(0), 1000)) == 0
    assert one(spark, dates.age_days(F.lit(1000 + 86400 * 2 + 5), 1000)) == 2
    assert one(spark, dates.age_days(F.lit(1000 - 86400 - 5), 1000)) == -1
