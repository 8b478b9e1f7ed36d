"""The operators' queries over the tables of a scale-factor folder, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.llm import chat_prefix, filter_audit, hard_negatives, html_main, importance, katz, line_frequency, pivot_search, simhash_gph, simhash_windows, soft_mixing, token_counts, trigram_secrets
from recsift.llm.oracle import ORACLE  # noqa: F401  (read by the entry module)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return soft_mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_frequency.line_rules(_table(spark, sf_dir, "documents"))


#: Added to the conversations by contract: texts that hold another template's control strings.
TRAP = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op3_chat_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame(TRAP, "conv_id long, turn long, role string, text string")
    return chat_prefix.digests(chat_prefix.examples(turns.unionByName(trap)))


def op4_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trigram_secrets.digests(trigram_secrets.scan(_table(spark, sf_dir, "documents")))


def op5_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(_table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item that it holds."""
    return simhash_windows.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("key").withColumn("contaminated", F.lit(True))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_gph.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.katz_scores(_table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_soft_mixing": op1_soft_mixing,
    "op2_line_frequency": op2_line_frequency,
    "op3_chat_prefix": op3_chat_prefix,
    "op4_trigram_secrets": op4_trigram_secrets,
    "op5_importance": op5_importance,
    "op6_html_main": op6_html_main,
    "op7_token_counts": op7_token_counts,
    "op8_simhash_windows": op8_simhash_windows,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_katz": op10_katz,
    "op11_filter_audit": op11_filter_audit,
    "op12_pivot_search": op12_pivot_search,
    "op13_hard_negatives": op13_hard_negatives,
}
