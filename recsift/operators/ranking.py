"""Ranks inside groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recsift.sources.text_io import stage

#: Rows of a group up to which one task numbers them.
HOT_ROWS = 1_000_000
#: Hash buckets of groups that are counted first.
BUCKETS = 65_536


def ranked(df: DataFrame, part: str, order: Sequence[Column], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` with ``rank``, from 1 in each group ``part`` by ``order``, which must leave no ties.

    Rows are stored first, as the job's candidates, and the groups' sizes are read from there: rows are counted by a hash
    of the group, and only groups of hashes with over ``hot_rows`` rows one by one. Groups up to
    ``hot_rows`` are numbered by a window. The rows of larger ones are dealt over partitions by sampled ranges
    of (group, order) and written sorted; a rank is then the place in the range plus the group's rows in
    the ranges before, a number for each range. A group is thus as many tasks as its size asks for.
    """
    stored = stage(df, "candidates")
    number = F.row_number().over(Window.partitionBy(part).orderBy(*order)).cast("bigint")
    large = lambda df, *by: df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*by)
    named = stored.where(F.col(part).isNotNull()).select(part, F.pmod(F.xxhash64(part), F.lit(BUCKETS)).cast("int").alias("_bucket"))
    buckets = [r["_bucket"] for r in large(named, "_bucket").collect()]
    hot = stage(large(named.where(F.col("_bucket").isin(buckets)), part), "hot") if buckets else None
    if hot is None or hot.isEmpty():
        return stored.withColumn("rank", number)
    keys = [F.col(part), *order]
    # The id is the range's number above 33 bits for the place in it; stored, both stay as they were.
    placed = stage(stored.join(hot, part, "left_semi").repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("_at", F.monotonically_increasing_id()), "ranges").withColumn("_range", F.shiftright("_at", 33))
    spans = placed.groupBy(part, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(part).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1
    spans = spans.select(part, "_range", shift.alias("_shift"))  # as many rows as hot groups and ranges together, at most
    large = placed.join(spans, [part, "_range"]).withColumn("rank", F.col("_at") + F.col("_shift"))
    return stored.join(hot, part, "left_anti").withColumn("rank", number).unionByName(large.drop("_at", "_range", "_shift"))
