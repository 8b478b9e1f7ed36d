"""Offline evaluation of ranked candidate lists: NDCG@k with CTR as graded relevance."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recsift.sources.text_io import read_ranked_lists


def ndcg_at_k(ranked: DataFrame, relevance: DataFrame, k: int = 40, main_col: str = "main_offer",
              pos_col: str = "rank", sim_col: str = "sim_offer", group_cols=()) -> DataFrame:
    """NDCG@k per list: ``(*group_cols, main, ndcg)``.

    Candidates without a relevance row are removed first and the rest keep their order with
    compacted positions 1..n; the first ``k`` count. ``dcg = sum((2^rel - 1) / ln(p + 1))`` and the
    ideal is the same sum over those k relevances sorted descending. ``relevance`` is
    ``(offer_id, ctr)``. ``pos_col`` may be any column that ascends along a list, a negated score for
    one: relevance is joined first, so only candidates that have one are ordered, and only the
    first ``k`` per list are kept.
    """
    part = list(group_cols) + [main_col]
    rel = relevance.select(F.col("offer_id").alias(sim_col), F.col("ctr").alias("rel"))
    j = ranked.select(*part, pos_col, sim_col).join(rel, sim_col)
    p = F.row_number().over(Window.partitionBy(*part).orderBy(pos_col, sim_col))
    top = j.withColumn("p", p).where(F.col("p") <= k)
    q = F.row_number().over(Window.partitionBy(*part).orderBy(F.col("rel").desc()))
    top = top.withColumn("q", q)
    gain = F.pow(F.lit(2.0), F.col("rel")) - F.lit(1.0)
    agg = top.groupBy(*part).agg(
        F.sum(gain / F.log(F.col("p") + F.lit(1.0))).alias("dcg"),
        F.sum(gain / F.log(F.col("q") + F.lit(1.0))).alias("idcg"))
    return agg.select(*part, F.try_divide(F.col("dcg"), F.col("idcg")).alias("ndcg"))


def summary(df: DataFrame, col: str = "ndcg", group_cols=()) -> DataFrame:
    """count, mean, sample stddev, min, max of a metric column (one row per group)."""
    aggs = [F.count(col).alias("n"), F.avg(col).alias("mean"),
            F.stddev_samp(col).alias("stddev"), F.min(col).alias("min"), F.max(col).alias("max")]
    return df.groupBy(*group_cols).agg(*aggs)


def evaluate_many(lists: Mapping[str, DataFrame], relevance: DataFrame, k: int = 40) -> DataFrame:
    """Evaluate several list sets in one job: ``(list_name, n, mean, stddev, min, max)``.

    Each list set is tagged with its name, all are unioned, and one grouped NDCG and one grouped
    summary run over the union (a single plan instead of a driver-side loop of jobs).
    """
    tagged = None
    for name, df in lists.items():
        t = df.select(F.lit(name).alias("list_name"), "main_offer", F.col("rank").cast("double").alias("rank"), "sim_offer")
        tagged = t if tagged is None else tagged.unionByName(t)
    nd = ndcg_at_k(tagged, relevance, k, group_cols=["list_name"])
    return summary(nd, "ndcg", ["list_name"])


def evaluate_paths(spark: SparkSession, paths: Mapping[str, str], relevance: DataFrame, k: int = 40) -> DataFrame:
    """``evaluate_many`` over ranked-list text outputs, given by name and path."""
    lists = {name: read_ranked_lists(spark, path).select(F.col("main_id").alias("main_offer"), F.col("pos").alias("rank"),
                                                         F.col("sim_id").alias("sim_offer")) for name, path in paths.items()}
    return evaluate_many(lists, relevance, k)
