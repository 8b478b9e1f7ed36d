"""Per-user recommendation lists from item similarity and recent behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.functions.dates import age_days


def _triggers(candidates: DataFrame, behaviour: DataFrame, save_count: int, min_limit: int, join_key: str) -> DataFrame:
    """``(user_id, trigger_item, trigger_type, time, tpos, quota)``: behaviour rows whose key has a list.

    ``tpos`` numbers a user's triggers in visiting order and identifies them: with a key other than
    the item several triggers of a user can share it. Count and order come from one sort per user.
    """
    keys = candidates.where(F.col("rank") == 1).select(F.col("main_id").alias(join_key)).distinct()
    t = behaviour.join(keys, join_key, "left_semi")
    ties = [F.col(c).asc() for c in dict.fromkeys((join_key, "item_id")) if c in behaviour.columns]
    w = Window.partitionBy("user_id").orderBy(F.col("trigger_type").desc(), F.col("time").desc(), *ties)
    n = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    quota = F.greatest((F.lit(save_count) / n).cast("bigint") + 1, F.lit(min_limit).cast("bigint")) - 1
    return t.select("user_id", F.col(join_key).alias("trigger_item"), "trigger_type", "time",
                    F.row_number().over(w).cast("bigint").alias("tpos"), quota.alias("quota"))


def _entries(candidates: DataFrame, triggers: DataFrame) -> DataFrame:
    c = candidates.select(F.col("main_id").alias("trigger_item"), "rank", F.col("sim_id").alias("item_id"), "score")
    return triggers.join(c, "trigger_item").where(F.col("rank") <= F.col("quota"))


def trigger_quota(candidates: DataFrame, behaviour: DataFrame, save_count: int = 300, min_limit: int = 10,
                  join_key: str = "item_id", window_start_s: int = 0) -> DataFrame:
    """Candidate entries each trigger may contribute.

    ``candidates`` is ``(main_id, rank, sim_id, score)`` (ranked from 1 per main id); ``behaviour`` is
    ``(user_id, <join_key>, trigger_type, time, ...)``. Triggers are behaviour rows whose key has a
    candidate list; with ``n`` such triggers a user's trigger keeps its first
    ``max(1 + save_count div n, min_limit) - 1`` candidates. ``age_days`` is the whole days from
    the window start (0 when time is 0); it shifts every score of a trigger equally, so it never
    changes an order. Output ``(user_id, trigger_item, trigger_type, time, age_days, rank, item_id, score)``.
    """
    e = _entries(candidates, _triggers(candidates, behaviour, save_count, min_limit, join_key))
    return e.select("user_id", "trigger_item", "trigger_type", "time",
                    age_days("time", window_start_s).alias("age_days"), "rank", "item_id", "score")


def user_recommendations(candidates: DataFrame, behaviour: DataFrame, save_count: int = 300,
                         min_limit: int = 10, join_key: str = "item_id") -> DataFrame:
    """Per-user lists, long form: ``(user_id, trigger_item, trigger_type, time, tpos, pos, item_id)``.

    Triggers are visited by type descending, then time descending (ties by key, then item); inside a
    trigger by candidate rank. An item is kept only at its first appearance for the user and at
    most ``save_count`` items are kept per user. A trigger whose entries were all taken keeps one
    row with null ``pos`` / ``item_id``.

    A trigger's entries become one array, at most its quota long; how many items the earlier triggers hold is
    a running sum over one row per trigger, and the array is cut by it. A window thus never holds entries
    of several triggers. Entries take one shuffle, by user, which serves all of these steps.
    """
    c = candidates.select(F.col("main_id").alias("trigger_item"), F.col("rank").cast("bigint").alias("rank"), F.col("sim_id").alias("item_id"))
    e = _triggers(candidates, behaviour, save_count, min_limit, join_key).join(c, "trigger_item").where(F.col("rank") <= F.greatest("quota", F.lit(1)))
    # A trigger with a quota of 0 keeps its first entry here, for its row; such entries take no item.
    allowed = F.col("rank") <= F.col("quota")
    first = F.row_number().over(Window.partitionBy("user_id", "item_id").orderBy(allowed.desc(), "tpos", "rank"))
    own = F.when(F.col("allowed") & (F.col("occ") == 1), F.struct("rank", "item_id"))
    lists = (e.repartition("user_id").withColumn("allowed", allowed).withColumn("occ", first)
             .groupBy("user_id", "trigger_item", "trigger_type", "time", "tpos").agg(F.array_sort(F.collect_list(own)).alias("l")))
    earlier = Window.partitionBy("user_id").orderBy("tpos").rowsBetween(Window.unboundedPreceding, -1)
    left = F.greatest(F.lit(save_count) - F.coalesce(F.sum(F.size("l")).over(earlier), F.lit(0)), F.lit(0)).cast("int")
    cut = lists.withColumn("left", left).withColumn("l", F.slice("l", F.lit(1), F.col("left")))
    return (cut.select("user_id", "trigger_item", "trigger_type", "time", "tpos", F.posexplode_outer("l").alias("p", "x"))
            .select("user_id", "trigger_item", "trigger_type", "time", "tpos", (F.col("p") + 1).cast("bigint").alias("pos"), F.col("x.item_id").alias("item_id")))


def user_recommendations_json(long_form: DataFrame) -> DataFrame:
    """``(user_id, rec_json)``: JSON array of ``{tr, ac, ts, it}`` per user, triggers in visit order."""
    per_trigger = (long_form.groupBy("user_id", "tpos", "trigger_item", "trigger_type", "time")
                   .agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(),
                                                           F.struct("pos", "item_id")))).alias("items")))
    per_trigger = per_trigger.select(
        "user_id", "tpos",
        F.struct(F.col("trigger_item").cast("string").alias("tr"), F.col("trigger_type").cast("string").alias("ac"),
                 F.col("time").cast("string").alias("ts"),
                 F.transform("items", lambda x: x["item_id"]).alias("it")).alias("rec"))
    per_user = per_trigger.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("tpos", "rec"))).alias("r"))
    return per_user.select("user_id", F.to_json(F.transform("r", lambda x: x["rec"])).alias("rec_json"))
