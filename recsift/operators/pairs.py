"""Co-occurrence pairs inside groups.

Rows are shuffled by group and counted there. In a group of up to ``block_items`` items, as most are, each item
meets the earlier ones in the same task. Every item of a larger group is dealt into one of the group's blocks by
its hash, as many blocks as its size asks for. The items of one block, or of two, are gathered into a list, one for
each pair of blocks, and pairs come from the list. A hot group is thus many lists of bounded length on
many tasks, and no group is ever gathered whole. Only rows of large groups are shuffled again, to their lists, and
nothing is joined.
Aggregations right after are partially combined before the next shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Items per block of a group, on average.
BLOCK_ITEMS = 256


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt by ``cols`` over all shuffle partitions of the session.

    With a number given, Spark does not merge partitions by their bytes. What follows sorts the rows or makes pairs of
    them, which takes many times those bytes, so tasks stay small.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def basket_pairs(df: DataFrame, group_cols: Sequence[str], item_col: str = "item_id",
                 carry: Sequence[str] = (), distinct: bool = True,
                 nullable_groups: Sequence[str] = (), block_items: int = BLOCK_ITEMS, wide: str | None = None) -> DataFrame:
    """Unordered item pairs per group: ``(*group_cols, item_i, item_j, *carry_i, *carry_j)``.

    ``carry`` columns are attributes of the item (functionally dependent on it) copied to both
    sides with suffixes ``_i`` / ``_j``. Rows are deduplicated on (group, item, carry) first when
    ``distinct`` is set, so each pair appears once per group. Group columns listed in
    ``nullable_groups`` compare null-safe (a null is a group of its own); rows with a null in
    another group column, or a null item, pair with nothing. ``wide`` names a boolean column that is the same in all rows
    of a group, and true in every group of more than ``block_items`` rows: other groups are not looked through for large ones.
    """
    there = F.col(item_col).isNotNull()
    for g in group_cols:
        there = there if g in nullable_groups else there & F.col(g).isNotNull()
    mark = [] if wide is None else [F.col(wide).alias("_wide")]
    base = df.where(there).select(*group_cols, item_col, *carry, *mark)
    if distinct:
        base = base.distinct()
    # Rows are dealt by group and sorted once; a group's size comes with its rows, and those that stay alone go no further.
    by_group = Window.partitionBy(*group_cols)
    dealt = spread(base, *group_cols)
    sized = lambda df: df.sortWithinPartitions(*group_cols, item_col).withColumn("_size", F.count(F.lit(1)).over(by_group))
    rows = sized(dealt)
    # A group of one block is complete where it was counted: each item meets the earlier ones.
    earlier = F.collect_list(F.struct(F.col(item_col).alias("_item"), *carry)).over(
        by_group.orderBy(item_col).rowsBetween(Window.unboundedPreceding, -1))
    alone = F.col("_size") <= block_items
    if wide is not None:  # so both parts read the same columns of one shuffle
        alone = alone | ~F.col("_wide")
    small = rows.where((F.col("_size") >= 2) & alone).withColumn("_e", earlier)
    small = small.select(*group_cols, item_col, *carry, F.explode("_e").alias("_a")).where(F.col("_a._item") != F.col(item_col))
    small = small.select(*group_cols, F.col("_a._item").alias("item_i"), F.col(item_col).alias("item_j"),
                         *[F.col(f"_a.{c}").alias(f"{c}_i") for c in carry], *[F.col(c).alias(f"{c}_j") for c in carry])
    if wide is not None:
        # Asked of each row after the shuffle: a plain filter would move below it, and the shuffle would run twice.
        rows = sized(dealt.where(F.when(F.monotonically_increasing_id() >= 0, F.col("_wide"))))
    dealt = rows.where(F.col("_size") > block_items)
    dealt = dealt.withColumn("_blocks", F.ceil(F.col("_size") / F.lit(block_items)).cast("int"))
    dealt = dealt.withColumn("_block", F.pmod(F.xxhash64(item_col), "_blocks").cast("int"))
    # An item is in the list of every pair of blocks that its own is part of.
    pair_of = lambda q: F.struct(F.least("_block", q).alias("p"), F.greatest("_block", q).alias("q"))
    keys = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), pair_of)
    member = dealt.select(*group_cols, F.struct("_block", F.col(item_col).alias("_item"), *carry).alias("_x"), F.explode(keys).alias("_k"))
    # Dealt before they are gathered: lists made of single items on the sending side would be larger rows, and no fewer.
    lists = member.repartition(*group_cols, "_k").groupBy(*group_cols, "_k").agg(F.sort_array(F.collect_list("_x")).alias("_l"))
    one = F.col("_k.p") == F.col("_k.q")
    lists = lists.withColumn("_n", F.when(~one, F.size(F.filter("_l", lambda x: x["_block"] == F.col("_k.p")))))
    left = lists.select(*group_cols, "_l", "_n", F.posexplode("_l").alias("_at", "_a")).where(F.col("_n").isNull() | (F.col("_at") < F.col("_n")))
    later = F.slice("_l", F.coalesce(F.col("_n") + 1, F.col("_at") + 2), F.size("_l"))
    met = left.select(*group_cols, "_a", F.explode(later).alias("_b")).where("_a._item <> _b._item")
    first = F.col("_a._item") < F.col("_b._item")

    def ordered(c: str, i, j):
        x, y = F.col(f"_a.{c}"), F.col(f"_b.{c}")
        return [F.when(first, x).otherwise(y).alias(i), F.when(first, y).otherwise(x).alias(j)]

    carried = [ordered(c, f"{c}_i", f"{c}_j") for c in carry]
    large = met.select(*group_cols, *ordered("_item", "item_i", "item_j"), *[x for x, _ in carried], *[y for _, y in carried])
    return small.unionByName(large)


def symmetrize(df: DataFrame, left: str, right: str, paired: Sequence[tuple[str, str]] = (),
               keep: Sequence[str] = ()) -> DataFrame:
    """Both directions of each pair in one pass (no union, no second scan).

    ``paired`` lists (left_attr, right_attr) columns swapped together with the pair; ``keep``
    columns are copied unchanged.
    """
    fwd = [F.col(left).alias("_l"), F.col(right).alias("_r")]
    rev = [F.col(right).alias("_l"), F.col(left).alias("_r")]
    for i, (a, b) in enumerate(paired):
        fwd += [F.col(a).alias(f"_a{i}"), F.col(b).alias(f"_b{i}")]
        rev += [F.col(b).alias(f"_a{i}"), F.col(a).alias(f"_b{i}")]
    both = F.explode(F.array(F.struct(*fwd), F.struct(*rev))).alias("_p")
    out = df.select(both, *keep)
    sel = [F.col("_p._l").alias(left), F.col("_p._r").alias(right)]
    for i, (a, b) in enumerate(paired):
        sel += [F.col(f"_p._a{i}").alias(a), F.col(f"_p._b{i}").alias(b)]
    return out.select(*sel, *keep)
