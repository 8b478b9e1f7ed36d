"""Text list formats: ranked lists, similarity pairs, scored lists, user lists, staged tables.

Lists travel as long-form rows inside jobs and are rendered to delimited text only at the sink.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recsift.plans.session import staging_dir


def write_ranked_lists(df: DataFrame, path: str, main_col: str = "main_offer", pos_col: str = "rank",
                       sim_col: str = "sim_offer") -> None:
    """``main \\t id,id,...`` per main id, ids in position order (overwrite)."""
    lists = df.groupBy(main_col).agg(F.array_sort(F.collect_list(F.struct(pos_col, sim_col))).alias("l"))
    lines = lists.select(F.concat_ws("\t", F.col(main_col).cast("string"),
                                     F.array_join(F.transform("l", lambda x: x[sim_col].cast("string")), ","))
                         .alias("value"))
    lines.write.mode("overwrite").text(path)


def read_ranked_lists(spark: SparkSession, path: str) -> DataFrame:
    """``(main_id, pos, sim_id)`` with 1-based positions from ``main \\t id,id,...`` lines."""
    t = spark.read.text(path).select(F.split("value", "\t", -1).alias("f")).where(F.size("f") >= 2)
    t = t.select(F.col("f")[0].alias("main_id"), F.posexplode(F.split(F.col("f")[1], ",")).alias("p", "sim_id"))
    return t.select("main_id", (F.col("p") + 1).cast("bigint").alias("pos"), "sim_id")


def write_sim_pairs(df: DataFrame, path: str, main_col: str = "main_offer", sim_col: str = "sim_offer",
                    score_col: str = "score") -> None:
    """``main \\t sim \\t score`` lines (overwrite)."""
    df.select(F.concat_ws("\t", F.col(main_col).cast("string"), F.col(sim_col).cast("string"),
                          F.col(score_col).cast("string")).alias("value")).write.mode("overwrite").text(path)


def read_sim_pairs(spark: SparkSession, path: str) -> DataFrame:
    """``(main_id, sim_id, score)``; lines without exactly three fields or with a bad score drop."""
    f = spark.read.text(path).select(F.split("value", "\t", -1).alias("f")).where(F.size("f") == 3)
    s = f.select(F.col("f")[0].alias("main_id"), F.col("f")[1].alias("sim_id"),
                 F.expr("try_cast(f[2] AS DOUBLE)").alias("score"))
    return s.where(F.col("score").isNotNull())


SCORED_FIELDS = ("sim_offer", "score", "zk_price", "sim_raw_price", "sim_zk_price", "sim_month_sales")


def write_scored_lists(df: DataFrame, path: str, main_col: str = "main_offer") -> None:
    """``main \\t sim:score:zk:sim_raw:sim_zk:sim_sales,...`` (entries ordered by sim id)."""
    entry = F.concat_ws(":", *[F.col(c).cast("string") for c in SCORED_FIELDS])
    lists = df.groupBy(main_col).agg(F.array_sort(F.collect_list(F.struct("sim_offer", entry.alias("e")))).alias("l"))
    lists.select(F.concat_ws("\t", F.col(main_col).cast("string"),
                             F.array_join(F.transform("l", lambda x: x["e"]), ",")).alias("value")) \
        .write.mode("overwrite").text(path)


def read_scored_lists(spark: SparkSession, path: str) -> DataFrame:
    """Long form of the scored-list text: ``(main_offer, sim_offer, score, zk_price, ...)``."""
    t = spark.read.text(path).select(F.split("value", "\t", -1).alias("f")).where(F.size("f") == 2)
    e = t.select(F.col("f")[0].alias("main_offer"), F.explode(F.split(F.col("f")[1], ",")).alias("e"))
    p = e.select("main_offer", F.split("e", ":", -1).alias("p")).where(F.size("p") == len(SCORED_FIELDS))
    cols = [F.col("p")[0].alias("sim_offer")]
    for i, c in enumerate(SCORED_FIELDS[1:], start=1):
        cols.append(F.expr(f"try_cast(p[{i}] AS DOUBLE)").alias(c))
    return p.select("main_offer", *cols)


def write_extensions(df: DataFrame, path: str) -> None:
    """``main \\t id,id,... \\t flag`` per main id from ``(main_offer, pos, sim_offer, has_base)`` (overwrite).

    A main id without entries has an empty list.
    """
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", "sim_offer"))
    lists = df.groupBy("main_offer", "has_base").agg(F.array_sort(F.collect_list(entry)).alias("l"))
    lists.select(F.concat_ws("\t", F.col("main_offer").cast("string"),
                             F.array_join(F.transform("l", lambda x: x["sim_offer"].cast("string")), ","),
                             F.col("has_base").cast("string")).alias("value")).write.mode("overwrite").text(path)


def read_extensions(spark: SparkSession, path: str) -> DataFrame:
    """``(main_offer, pos, sim_offer, has_base)``; an empty list gives one row with null ``pos``."""
    f = spark.read.text(path).select(F.split("value", "\t", -1).alias("f")).where(F.size("f") == 3)
    ids = F.when(F.col("f")[1] != "", F.split(F.col("f")[1], ","))
    e = f.select(F.col("f")[0].alias("main_offer"), F.col("f")[2].cast("int").alias("has_base"), F.posexplode_outer(ids).alias("p", "sim_offer"))
    return e.select("main_offer", (F.col("p") + 1).cast("bigint").alias("pos"), "sim_offer", "has_base")


def write_rows(df: DataFrame, path: str, sep: str = "\t") -> None:
    """One line per row: the columns in order, joined by ``sep``; null is empty (overwrite).

    For feature rows (tab) and edge lines (space), whose fields never hold the separator.
    """
    df.select(F.array_join(F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]), sep).alias("value")) \
        .write.mode("overwrite").text(path)


def read_rows(spark: SparkSession, path: str, schema: str, sep: str = "\t") -> DataFrame:
    """Rows written by ``write_rows``; ``schema`` is DDL, empty fields are null, lines of another width drop."""
    fields = [c.strip().split(" ") for c in schema.split(",")]
    f = spark.read.text(path).select(F.split("value", f"[{sep}]", -1).alias("f")).where(F.size("f") == len(fields))
    return f.select(*[F.when(F.col("f")[i] != "", F.col("f")[i]).cast(kind).alias(name) for i, (name, kind) in enumerate(fields)])


def write_sentences(df: DataFrame, path: str) -> None:
    """Corpus lines: the sentences of ``(user_id, sentence, ...)``, one per line (overwrite)."""
    df.select(F.col("sentence").alias("value")).write.mode("overwrite").text(path)


def read_user_lists(spark: SparkSession, path: str) -> DataFrame:
    """``(user_id, rec_json)`` from tab-separated lines."""
    at = F.instr("value", "\t")
    return spark.read.text(path).select(F.substring("value", F.lit(1), at - 1).alias("user_id"), F.substring("value", at + 1, F.length("value")).alias("rec_json"))


def write_user_lists(df: DataFrame, path: str, enabled: bool = True) -> None:
    """Tab-separated ``user \\t json`` rows (overwrite), skipped when ``enabled`` is false."""
    if enabled:
        df.select(F.concat_ws("\t", *df.columns).alias("value")).write.mode("overwrite").text(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared staging directory."""
    return f"{staging_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Materialise ``df`` as parquet in the shared staging folder and read it back.

    Cuts the lineage (a lost executor re-reads the table instead of recomputing the plan) and
    lets several consumers share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
