"""The corpus pipeline: five stages over ``documents``, each an operator of ``recsift.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the columns of ``documents``;
the last adds the mixing columns. Other columns of the input are not carried along. Between stages the
rows are written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.llm import importance, simhash_gph, simhash_windows, soft_mixing, trigram_secrets
from recsift.llm.common import staged

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The mixture holds half of the input's expected low and toxic tokens, and draws no document more than four times.
FACTORS, MAX_RATE = {"low": 0.5, "toxic": 0.5}, 4.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that importance resampling does not draw."""
    judged = importance.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=COLUMNS[1:])
    return judged.where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, that with the smallest id, of each SimHash component (shingles of 3, 3 bits).

    Rows that repeat a kept id and its text are one document. A row without an id cannot stand for its
    component and is not named by one; such rows stay.
    """
    found = simhash_gph.near_duplicates(docs, shingle=3, radius=3)
    best = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.where("doc_id IS NOT NULL").join(best, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return simhash_windows.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; ``n_chars`` follows the text where it changed."""
    found = trigram_secrets.scan(docs, keep=("lang", "source", "n_chars"))
    hit = F.size("found") > 0
    clean = found.select("doc_id", "lang", "source", "n_chars", "found", trigram_secrets.redacted(F.col("text"), F.col("found")).alias("text"))
    return clean.withColumn("n_chars", F.when(hit, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds to every document its tokens, domain posteriors and the rate at which to draw it; none is dropped.

    The earlier stages have removed most low and toxic text, so targets are set against what is left, and
    errors of all domains weigh alike however rare they have become. The classifier learns from the labelled
    texts of ``documents``, as no example of a domain may be left here.
    """
    mixed = soft_mixing.mix(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=COLUMNS[1:], most=MAX_RATE, factors=FACTORS, even=True,
                            train=spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return mixed.select(*COLUMNS, "tokens", *(f"p_{d}" for d in soft_mixing.DOMAINS), "rate")


STAGES = [("quality classifier", quality), ("simhash near-dedup", near_dedup), ("benchmark decontamination", decontaminate),
          ("secret scan", secrets), ("mixing", mixing)]

#: Fingerprints, hashed models and fitted rates are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written and read as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = staged(docs, f"stage{k}")
    return docs
