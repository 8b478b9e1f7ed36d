"""Feature export: JSON feature bags to hashed features, label dedup, offer feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recsift.functions.binning import (COMMISSION_EDGES, NUMBER_PATTERN, PRICE_EDGES, RATE_EDGES,
                                       SCORE_EDGES, bucketize_number)
from recsift.functions.hashing import hash_feature, hash_sequence_parts, sequence_parts
from recsift.sources.text_io import stage

# Fixed values that must equal the studied jobs: which features are bucketed, with which edges,
# and the feature-name presets of the two export variants.
FEATURE_EDGES = {"Mc": SCORE_EDGES, "Md": SCORE_EDGES, "Me": SCORE_EDGES, "Sl": RATE_EDGES,
                 "Sj": RATE_EDGES, "Sf": PRICE_EDGES, "Ss": COMMISSION_EDGES}
BASE_FEATURES = ("S", "Sc", "Sd")
EXTENDED_FEATURES = ("S", "Sc", "Sd", "Se", "Sm")

# Characters that a Java-style trim strips from both ends (all code points up to U+0020).
_TRIM = r"^[\x00-\x20]+|[\x00-\x20]+$"


def feature_map(json_col: str = "predictor_json"):
    """Flat JSON object to ``map<string,string>`` (numbers come back as their text)."""
    return F.from_json(F.col(json_col), "map<string,string>")


def java_trim(c):
    return F.regexp_replace(c, _TRIM, "")


def with_features(df: DataFrame, names, out_col: str = "features", json_col: str = "predictor_json",
                  edges: dict | None = None) -> DataFrame:
    """Add comma-joined hashed features for ``names`` from a flat JSON feature bag.

    A missing name takes ``-1``; values are trimmed; names with edges are bucketed first. The
    work is staged in three projections (map values, buckets, hashes) so every intermediate is
    computed once per row even where expressions cannot be code-generated.
    """
    edges = FEATURE_EDGES if edges is None else edges
    keep = df.columns
    m = F.from_json(F.col(json_col), "map<string,string>")
    t = df.select(*keep, m.alias("_fmap"))
    t = t.select(*keep, *[F.coalesce(java_trim(F.element_at(F.col("_fmap"), F.lit(n))), F.lit("-1")).alias(f"_v{i}")
                          for i, n in enumerate(names)])
    t = t.select(*keep, *[(F.when(F.col(f"_v{i}").rlike(NUMBER_PATTERN), F.col(f"_v{i}").cast("double"))
                           .otherwise(F.lit(-1.0)).alias(f"_x{i}") if n in edges else F.col(f"_v{i}"))
                          for i, n in enumerate(names)])
    t = t.select(*keep, *[(bucketize_number(F.col(f"_x{i}"), edges[n]).cast("string").alias(f"_b{i}")
                           if n in edges else F.col(f"_v{i}").alias(f"_b{i}")) for i, n in enumerate(names)])
    return t.select(*keep, F.array_join(F.array(*[hash_feature(n, F.col(f"_b{i}")) for i, n in enumerate(names)]),
                                        ",").alias(out_col))


def with_sequence_features(df: DataFrame, specs, out_col: str = "seq_features", json_col: str = "predictor_json",
                           length: int = 50) -> DataFrame:
    """Add comma-joined padded sequence hashes for ``key:fea`` specs (``-1`` for a missing key)."""
    keep = df.columns
    m = F.from_json(F.col(json_col), "map<string,string>")
    t = df.select(*keep, m.alias("_fmap"))
    pairs = [s.split(":", 1) for s in specs]
    t = t.select(*keep, *[sequence_parts(F.coalesce(F.element_at(F.col("_fmap"), F.lit(k)), F.lit("-1"))).alias(f"_p{i}")
                          for i, (k, _) in enumerate(pairs)])
    return t.select(*keep, F.array_join(F.array(*[hash_sequence_parts(F.col(f"_p{i}"), fea, length)
                                                  for i, (_, fea) in enumerate(pairs)]), ",").alias(out_col))


def label_dedup(train_log: DataFrame, start: str, end: str, log_type: str = "home_feed",
                min_user_len: int = 14, min_offer_len: int = 2) -> DataFrame:
    """One row per (trace, user, offer): the highest label (ties: largest feature text).

    Output ``(trace_id, user_id, offer_id, label, label_bin, predictor_json)`` with ``label_bin``
    0 for label ``"0"`` and 1 otherwise. Computed as a map-side combined max, not a window.
    """
    t = train_log.where((F.col("log_type") == log_type) & (F.length("user_id") >= min_user_len)
                        & (F.length("offer_id") >= min_offer_len) & (F.col("day") <= end)
                        & (F.col("day") >= start))
    g = t.groupBy("trace_id", "user_id", "offer_id").agg(F.max(F.struct("label", "predictor_json")).alias("b"))
    return g.select("trace_id", "user_id", "offer_id", F.col("b.label").alias("label"),
                    F.when(F.col("b.label") == "0", 0).otherwise(1).alias("label_bin"),
                    F.col("b.predictor_json").alias("predictor_json"))


def offer_features(train_log: DataFrame, catalog: DataFrame, ctr: DataFrame, start: str, end: str,
                   names=BASE_FEATURES, edges: dict | None = None) -> DataFrame:
    """Hashed feature row per offer joined with category, sales and CTR.

    Output ``(offer_id, subcate_id, month_sales, features, ctr)``. The offer id is the text before
    the first colon of the first feature. Per offer the smallest feature text is kept. Offers
    without a live catalog row or without a CTR row drop (inner joins).
    """
    d = label_dedup(train_log, start, end).select("predictor_json")
    f = with_features(d, names, "features", edges=edges).select("features")
    per_offer = (f.withColumn("offer_id", F.substring_index("features", ":", 1))
                 .groupBy("offer_id").agg(F.min("features").alias("features")))
    cat = (catalog.where((F.col("status") != 0) & (F.col("product_type") == 1))
           .select("offer_id", "subcate_id", F.col("month_sales").cast("bigint").alias("month_sales")))
    c = ctr.select("offer_id", "ctr")
    return per_offer.join(cat, "offer_id").join(c, "offer_id") \
        .select("offer_id", "subcate_id", "month_sales", "features", "ctr")


def frequency_index(df: DataFrame, col: str) -> DataFrame:
    """Frequency-ordered index of the values of a column: ``(col, n, idx)``, most frequent = 0.

    Ties are broken by value; null is a value of its own and comes first among its ties. The counted values
    are dealt over partitions by sampled ranges of (count, value) and written in order, so an index is the
    place in its partition plus the sizes of those before it, one number each: however many values share a
    count or their first letters, no task holds more than its range.
    """
    order = [F.col("n").desc(), F.col(col).asc_nulls_first()]
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    # The id is the partition's number above 33 bits for the place in it; stored, both stay as they were.
    placed = stage(counts.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "frequency")
    placed = placed.select(col, "n", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_place"))
    first, upto = [], 0
    for r in sorted(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("size")).collect()):  # a row per partition
        first.append((r["_part"], upto))
        upto += r["size"]
    starts = df.sparkSession.createDataFrame(first, "_part bigint, _first bigint")
    return placed.join(F.broadcast(starts), "_part").select(col, "n", (F.col("_first") + F.col("_place")).alias("idx"))


#: What the readers give where a feature is null and where its key is absent; a number that cannot be read counts as null.
DEFAULTS = {"string": ("null", "None"), "int": (0, 0), "float": (0.0, 0.0)}


def read_feature(name: str, kind: str = "string", map_col: str = "fmap"):
    """A feature out of a parsed bag with a default instead of null: ``kind`` is ``string``, ``int`` or ``float``.

    An absent key, or a bag that could not be parsed, gives the second value of ``DEFAULTS``, a null value the first.
    """
    if kind not in DEFAULTS:
        raise ValueError(f"kind must be one of {sorted(DEFAULTS)}")
    null, absent = (F.lit(x) for x in DEFAULTS[kind])
    fmap = F.col(map_col)
    raw = F.element_at(fmap, F.lit(name))
    to = {"string": "string", "int": "int", "float": "double"}[kind]
    value = raw if kind == "string" else java_trim(raw).try_cast(to)
    return F.when(F.coalesce(F.map_contains_key(fmap, F.lit(name)), F.lit(False)), F.coalesce(value, null.cast(to))).otherwise(absent.cast(to))
