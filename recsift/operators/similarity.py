"""Item-to-item similarity: cosine item CF and Swing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recsift.operators.filters import valid_interactions
from recsift.operators.pairs import BLOCK_ITEMS, basket_pairs, symmetrize
from recsift.sources.text_io import stage


def _rows(interactions: DataFrame) -> DataFrame:
    return interactions.select("user_id", "item_id").where(F.col("user_id").isNotNull() & F.col("item_id").isNotNull())


def _categories(catalog: DataFrame, category_col: str) -> DataFrame:
    live = catalog.where((F.col("status") != 0) & (F.col("product_type") == 1))
    return live.select("item_id", F.col(category_col).alias("category"))


def _cf_pairs_base(users: DataFrame, nor: DataFrame, catalog: DataFrame, category_col: str) -> DataFrame:
    return users.join(nor, "item_id").join(_categories(catalog, category_col), "item_id").select("user_id", "category", "item_id", "nor").distinct()


def _cf_base(interactions: DataFrame, catalog: DataFrame, min_user_rows: int, max_user_rows: int,
             min_support: int, category_col: str, strict_users: bool) -> DataFrame:
    # The studied job forms pairs from all users (the activity bounds only shape the norms);
    # strict_users applies them to the pair base too.
    by_user, by_item = Window.partitionBy("user_id").orderBy("item_id"), Window.partitionBy("item_id")
    whole = by_user.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One shuffle, sort and window by user gives rows of a user and distinct items, one by item their support and category.
    rows = _rows(interactions).repartition("user_id").sortWithinPartitions("user_id", "item_id")
    n = F.count(F.lit(1)).over(whole)
    # A user's items of one category are no more than the user's rows.
    rows = rows.withColumns({"_before": F.lag("item_id").over(by_user), "_active": n.between(min_user_rows, max_user_rows), "wide": n > BLOCK_ITEMS})
    rows = rows.where(F.col("_before").isNull() | (F.col("_before") != F.col("item_id")))
    held = (rows.select("user_id", "item_id", "_active", "wide").repartition("item_id").withColumn("nor", F.count(F.when(F.col("_active"), 1)).over(by_item))
            .where(F.col("nor") >= min_support))
    if strict_users:
        held = held.where("_active")
    return held.join(_categories(catalog, category_col).distinct(), "item_id").select("user_id", "category", "item_id", "nor", "wide")


def _cf_scores(base: DataFrame) -> DataFrame:
    pairs = basket_pairs(base, ["user_id", "category"], "item_id", carry=["nor"], distinct=False,
                         nullable_groups=["category"], wide="wide" if "wide" in base.columns else None)
    co = pairs.groupBy("item_i", "item_j", "nor_i", "nor_j").agg(F.count(F.lit(1)).alias("co"))
    both = symmetrize(co, "item_i", "item_j", paired=[("nor_i", "nor_j")], keep=["co"])
    return both.select("item_i", "item_j", "co", "nor_i", "nor_j",
                       (F.col("co") / F.sqrt(F.col("nor_i") * F.col("nor_j"))).alias("score"))


def item_cf(interactions: DataFrame, catalog: DataFrame, min_user_rows: int = 2, max_user_rows: int = 2000,
            min_support: int = 5, category_col: str = "subcate_id", strict_users: bool = False) -> DataFrame:
    """Cosine item CF within (user, category) groups, both directions.

    Output ``(item_i, item_j, co, nor_i, nor_j, score)`` where ``co`` is the number of
    (user, category) groups holding both items, ``nor`` the number of distinct active users of an
    item (kept when >= ``min_support``) and ``score = co / sqrt(nor_i * nor_j)``.
    """
    return _cf_scores(_cf_base(interactions, catalog, min_user_rows, max_user_rows, min_support, category_col, strict_users))


def item_cf_stage_counts(interactions: DataFrame, catalog: DataFrame, min_user_rows: int = 2, max_user_rows: int = 2000, min_support: int = 5,
                         category_col: str = "subcate_id", strict_users: bool = False) -> DataFrame:
    """Row counts of the item-CF stages as a ``(stage, rows)`` table.

    The job runs once, stage by stage, each written for the next; the input is read once. Counts of what is
    stored come from the files' footers, that of the input from the rows that each (user, item) stands for.
    """
    count = F.count(F.lit(1)).alias("rows")
    held = stage(_rows(interactions).groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n")), "held")
    users = held.select("user_id", "item_id")
    active = held.groupBy("user_id").agg(F.sum("n").alias("n")).where(F.col("n").between(min_user_rows, max_user_rows))
    active = stage(active.select("user_id"), "active")
    support = users.join(active, "user_id", "left_semi").groupBy("item_id").agg(F.count(F.lit(1)).alias("nor"))
    nor = stage(support.where(F.col("nor") >= min_support), "support")
    base = stage(_cf_pairs_base(users.join(active, "user_id", "left_semi") if strict_users else users, nor, catalog, category_col), "base")
    parts = [("interactions", held.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))), ("active_users", active.agg(count)),
             ("supported_items", nor.agg(count)), ("pair_base", base.agg(count)), ("directed_pairs", _cf_scores(base).agg(count))]
    out = None
    for name, df in parts:
        c = df.select(F.lit(name).alias("stage"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def pair_support(orders: DataFrame, min_rows: int = 2, min_users: int = 3, max_users: int = 99) -> DataFrame:
    """Swing's first stages: ``(item_i, item_j, support)`` for pairs held by min..max users.

    Users need at least ``min_rows`` rows; support counts distinct users holding both items.
    """
    us = _pair_users(_swing_user_pairs(_active_baskets(orders, min_rows), min_users), min_users, max_users)
    return us.select("item_i", "item_j", F.size("us").cast("bigint").alias("support"))


#: Basket entries met by one item up to which one row gathers them.
HOT_ENTRIES = 200_000
#: Basket entries met by one item up to which 16 bits of their hashes tell them apart well enough.
SHORT_ENTRIES = 1 << 14
#: Combinations of a pair's users in one task of the overlaps, on average, at most.
TASK_COMBINATIONS = 400_000


def _active_baskets(orders: DataFrame, min_rows: int) -> DataFrame:
    """Distinct ``(user_id, item_id, held)`` of users with at least ``min_rows`` rows, written once; ``held``: the user's items.

    Swing reads it for item support, for pairs and for overlaps; stored, its inputs are read and planned
    once, and a lost executor re-reads the table.
    """
    by_user = Window.partitionBy("user_id").orderBy("item_id")
    whole = by_user.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # One shuffle and sort by user gives rows of a user, distinct items and their number.
    rows = _rows(orders).repartition("user_id").sortWithinPartitions("user_id", "item_id")
    rows = rows.withColumns({"_n": F.count(F.lit(1)).over(whole), "_before": F.lag("item_id").over(by_user)}).where(F.col("_n") >= min_rows)
    held = rows.where(F.col("_before").isNull() | (F.col("_before") != F.col("item_id"))).select("user_id", "item_id")
    return stage(held.withColumn("held", F.count(F.lit(1)).over(whole)), "baskets")


def _swing_user_pairs(ui: DataFrame, min_users: int, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """``(user_id, item_i, item_j)`` of every item pair held by ``min_users`` users or more.

    Most pairs of a large log are held by fewer, so pairs are counted before rows are made of them. Every item
    gets from each of its users the later items of the basket, as one array of 32-bit hashes, or of their last
    16 bits for an item that meets up to ``SHORT_ENTRIES`` entries; hashes that fewer ``min_users`` of those arrays hold stand for no supported pair and go. Equal hashes of different items only
    keep more, and the rest is joined with the baskets by user and hash, which gives back the items. Items that meet
    over ``hot_entries`` entries of baskets come last in each order: they gather nothing, and their few pairs
    with each other become rows at once, so no list grows with a popular item.
    """
    if min_users < 2:
        return basket_pairs(ui.select("user_id", "item_id"), ["user_id"], "item_id", distinct=False)
    items = ui.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"), F.sum("held").alias("met")).where(F.col("n") >= min_users)
    marks = items.select("item_id", (F.col("met") > hot_entries).alias("hot"), (F.col("met") <= SHORT_ENTRIES).alias("short"))
    low = lambda h: (h.bitwiseAND(0xFFFF) - F.lit(1 << 15)).cast("short")
    x = ui.join(marks, "item_id").withColumn("h", F.hash("item_id"))
    hot = basket_pairs(x.where("hot").select("user_id", "item_id"), ["user_id"], "item_id", distinct=False)
    # Large baskets are dealt into blocks, as in basket_pairs; a list holds the items of a pair of blocks.
    blocks = F.ceil(F.col("held") / F.lit(BLOCK_ITEMS)).cast("int")
    dealt = x.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("item_id"), "blocks").cast("int"))
    pair_of = lambda q: F.struct(F.least("block", q).alias("p"), F.greatest("block", q).alias("q"))
    member = dealt.select("user_id", F.struct("hot", "item_id", "h", "block", "short").alias("x"),
                          F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), pair_of)).alias("k"))
    lists = member.repartition("user_id", "k").groupBy("user_id", "k").agg(F.sort_array(F.collect_list("x")).alias("l"))
    # Every item of a list gets a copy of what it looks through: of most lists, which are one block, hashes alone.
    lists = lists.select("user_id", "l", F.when(F.col("k.p") != F.col("k.q"), F.col("l")).alias("two"), F.col("l.h").alias("hs")).withColumn("gs", F.transform("hs", low))

    def later(c: str, of):
        other_block = F.filter(F.slice("two", F.col("at") + 2, F.size("hs")), lambda y: y["block"] != F.col("x.block"))
        return F.when(F.col("two").isNull(), F.slice(c, F.col("at") + 2, F.size("hs"))).otherwise(F.transform(other_block, lambda y: of(y["h"])))

    each = lists.select("user_id", "two", "hs", "gs", F.posexplode("l").alias("at", "x")).where(~F.col("x.hot") & (F.col("at") + 1 < F.size("hs")))
    entry = each.select(F.col("x.item_id").alias("item"), F.struct("user_id", F.when(~F.col("x.short"), later("hs", lambda h: h)).alias("hs"),
                                                                    F.when(F.col("x.short"), later("gs", low)).alias("gs")).alias("e"))
    # Sorted inside the aggregation, which no filter passes, so once for each item.
    sorted_all = lambda c: F.sort_array(F.flatten(F.collect_list(c)))
    lists = entry.repartition("item").groupBy("item").agg(F.collect_list("e").alias("es"), sorted_all("e.hs").alias("all_hs"), sorted_all("e.gs").alias("all_gs"))
    again = lambda c: F.array_distinct(F.filter(c, lambda h, i: h == F.get(c, i + (min_users - 1))))
    often = lists.select("item", "es", again("all_hs").alias("often_hs"), again("all_gs").alias("often_gs"))
    often = often.where((F.size("often_hs") > 0) | (F.size("often_gs") > 0))
    left = often.select("item", "often_hs", "often_gs", F.explode("es").alias("e"))
    wide = F.transform(F.array_intersect("e.hs", "often_hs"), lambda h: F.struct(low(h).alias("g"), h.alias("h")))
    short = F.transform(F.array_intersect("e.gs", "often_gs"), lambda g: F.struct(g.alias("g"), F.lit(None).cast("int").alias("h")))
    left = left.select(F.col("e.user_id").alias("user_id"), "item", F.explode(F.coalesce(wide, short)).alias("x"))
    # Equal hashes in two blocks of one basket would come twice.
    left = left.select("user_id", F.col("x.g").alias("g"), "item", F.col("x.h").alias("h")).repartition("user_id", "g").distinct()
    other = x.select("user_id", low(F.col("h")).alias("g"), F.col("h").alias("full"), F.col("item_id").alias("other"), "hot")
    met = left.join(other, ["user_id", "g"]).where((F.col("h").isNull() | (F.col("h") == F.col("full"))) & (F.col("hot") | (F.col("item") < F.col("other"))))
    return met.select("user_id", F.least("item", "other").alias("item_i"), F.greatest("item", "other").alias("item_j")).unionByName(hot)


def _user_overlaps(needed: DataFrame, ui: DataFrame, max_array: int) -> DataFrame:
    """``(u, v, overlap)`` = |I_u & I_v| for the given user pairs.

    A user's items are dealt by hash into chunks of about ``max_array``, a power of two of them, as many as
    the basket's size asks for; every chunk becomes one array. Chunks of two users nest: of a user with
    fewer chunks, each meets only those chunks of the other that hold the same hashes, so a pair costs as
    many array intersections as the larger basket has chunks. Typical users have one chunk.
    """
    if max_array < 1:
        raise ValueError("max_array must be at least 1")
    sizes = ui.groupBy("user_id").agg(F.pow(F.lit(2), F.ceil(F.log2(F.ceil(F.count(F.lit(1)) / F.lit(max_array))))).cast("int").alias("chunks"))
    chunked = ui.join(sizes, "user_id").withColumn("chunk", F.pmod(F.xxhash64("item_id"), F.col("chunks")).cast("int"))
    chunks = chunked.groupBy("user_id", "chunks", "chunk").agg(F.collect_list("item_id").alias("items"))
    cu = chunks.select(F.col("user_id").alias("u"), F.col("chunks").alias("nu"), F.col("chunk").alias("ku"), F.col("items").alias("iu"))
    cv = chunks.select(F.col("user_id").alias("v"), F.col("chunks").alias("nv"), F.col("chunk").alias("kv"), F.col("items").alias("iv"))
    fewer = F.least("nu", "nv")
    met = needed.join(cu, "u").join(cv, "v").where(F.pmod("ku", fewer) == F.pmod("kv", fewer))
    return met.groupBy("u", "v").agg(F.sum(F.size(F.array_intersect("iu", "iv"))).cast("bigint").alias("overlap"))


def _pair_users(pu: DataFrame, min_users: int, max_users: int) -> DataFrame:
    """``(item_i, item_j, us)``: the sorted users of every item pair whose support is in the band.

    Of each pair one user more than the band allows is kept, already before the shuffle; those that have
    that many are out, so no list grows with a popular pair, and pairs are shuffled once for band and users.
    """
    w = Window.partitionBy("item_i", "item_j").orderBy("user_id")
    few = pu.withColumn("n", F.row_number().over(w)).where(F.col("n") <= max_users + 1)
    users = few.groupBy("item_i", "item_j").agg(F.array_sort(F.collect_list("user_id")).alias("us"))
    return users.where(F.size("us").between(min_users, max_users))


def _met_users(lists: DataFrame, ui: DataFrame, max_array: int) -> DataFrame:
    """``(pair, u, v, overlap)`` for the 2-combinations of the users ``us`` of every pair of ``lists (pair, us)``; overlap = |I_u & I_v|.

    Users are dealt by hash into groups, and a block is a group of u and one of v. A user's basket, one array, goes once to
    every block where the user has pairs, not to each pair, so it moves as often as there are such blocks at most. In the block, sorted by u,
    the basket stands before the user's pairs and is handed to the first row of each (u, v); sorted by v, likewise, the two
    meet, and the other rows of (u, v) take the number. Windows stream, so nothing grows with a user's pairs. Baskets of over
    ``max_array`` items do not move: their overlap is null here.
    """
    combined = lists.agg(F.sum(F.size("us") * (F.size("us") - 1) / 2)).first()[0] or 0
    n = max(int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + int(combined // TASK_COMBINATIONS))
    groups = max(1, round((2 * n) ** 0.5))
    group = lambda c: F.pmod(F.xxhash64(c), F.lit(groups))
    first = lists.select("pair", "us", F.posexplode("us").alias("p", "u"))
    pairs = first.select("pair", "u", F.explode(F.slice("us", F.col("p") + 2, F.size("us"))).alias("v"))
    pairs = pairs.select((group("u") * groups + group("v")).cast("int").alias("block"), F.col("u").alias("k"), "v", "pair")
    there = pairs.select("block", F.explode(F.array("k", "v")).alias("k")).distinct()
    baskets = ui.where(F.col("held") <= max_array).groupBy("user_id").agg(F.collect_list("item_id").alias("items"))
    there = there.join(baskets.withColumnRenamed("user_id", "k"), "k", "left")
    dealt = pairs.unionByName(there, allowMissingColumns=True).repartition(n, "block")

    def upto(*keys: str):
        return Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    pair, by_u = F.col("v").isNotNull(), Window.partitionBy("block", "k").orderBy("v")  # nulls, the baskets, come first
    rows = dealt.withColumns({"own": F.first("items").over(upto("block", "k", "v")), "before": F.lag("v").over(by_u)})
    again = F.coalesce(F.col("before") == F.col("v"), F.lit(False))
    rows = rows.select("block", F.coalesce("v", "k").alias("v"), F.when(pair, F.col("k")).alias("u"), again.alias("again"), "pair",
                       F.when(~again, F.col("own")).alias("items"))
    by_v = Window.partitionBy("block", "v").orderBy("u", "again").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("own", F.first("items").over(by_v))
    known = F.col("u").isNotNull() & F.col("items").isNotNull() & F.col("own").isNotNull()
    rows = rows.select("block", "v", "u", "again", "pair", F.when(known, F.size(F.array_intersect("items", "own"))).cast("bigint").alias("overlap"))
    rows = rows.withColumn("overlap", F.first("overlap").over(upto("block", "v", "u", "again")))
    return rows.where(F.col("u").isNotNull()).select("pair", "u", "v", "overlap")


def swing_scores(orders: DataFrame, min_rows: int = 2, min_users: int = 3, max_users: int = 99,
                 alpha: float = 1.0, max_array: int = 512) -> DataFrame:
    """``(item_i, item_j, score)``: Swing score sum over user pairs ``1 / (alpha + |I_u & I_v|)``.

    In-band item pairs are stored with their users, at most ``max_users``; the overlap of two users is computed in
    a block of users (see ``_met_users``), or in chunks where a basket has over ``max_array`` items (see
    ``_user_overlaps``); popular items are never self-joined. The terms of a pair, at most one per two of its users, are added in ascending order, so the
    score does not depend on how rows were shuffled.
    """
    if max_array < 1:
        raise ValueError("max_array must be at least 1")
    ui = _active_baskets(orders, min_rows)
    lists = _pair_users(_swing_user_pairs(ui, min_users), min_users, max_users)
    lists = stage(lists.withColumn("pair", F.monotonically_increasing_id()), "pair_users")
    met = _met_users(lists.select("pair", "us"), ui, max_array)
    if not ui.where(F.col("held") > max_array).isEmpty():
        met = stage(met, "met_users")
        open_ = met.where(F.col("overlap").isNull()).drop("overlap")
        overlap = _user_overlaps(open_.select("u", "v").distinct(), ui, max_array)
        met = met.where(F.col("overlap").isNotNull()).unionByName(open_.join(overlap, ["u", "v"]).select("pair", "u", "v", "overlap"))
    terms = met.groupBy("pair").agg(F.collect_list("overlap").alias("overlaps"))
    terms = terms.select("pair", F.array_sort(F.transform("overlaps", lambda n: F.lit(1.0) / (F.lit(float(alpha)) + n))).alias("terms"))
    named = terms.join(lists.select("pair", "item_i", "item_j"), "pair")
    return named.select("item_i", "item_j", F.aggregate("terms", F.lit(0.0), lambda s, t: s + t).alias("score"))


def swing(orders: DataFrame, catalog: DataFrame, min_rows: int = 2, min_users: int = 3, max_users: int = 99,
          alpha: float = 1.0, depth: int = 200, min_len: int = 3, same_category: bool = False,
          max_array: int = 512) -> DataFrame:
    """Swing similarity lists per offer: ``(main_offer, rank, sim_offer, score)``.

    Item pairs are mapped to offers of live catalog rows (optionally only within one category),
    made symmetric, deduplicated per (main, sim) keeping the highest score, ranked by score
    (ties by offer id), cut at ``depth``; lists with fewer than ``min_len`` entries are dropped.
    """
    s = swing_scores(orders, min_rows, min_users, max_users, alpha, max_array)
    live = catalog.where(F.col("status") != 0).select("item_id", "offer_id", "subcate_id")
    m = live.select(F.col("item_id").alias("item_i"), F.col("offer_id").alias("main_offer"),
                    F.col("subcate_id").alias("sub_i"))
    c = live.select(F.col("item_id").alias("item_j"), F.col("offer_id").alias("sim_offer"),
                    F.col("subcate_id").alias("sub_j"))
    j = s.join(m, "item_i").join(c, "item_j")
    if same_category:
        j = j.where(F.col("sub_i") == F.col("sub_j"))
    both = symmetrize(j, "main_offer", "sim_offer", keep=["score"])
    best = both.groupBy("main_offer", "sim_offer").agg(F.max("score").alias("score"))
    w = Window.partitionBy("main_offer").orderBy(F.col("score").desc(), F.col("sim_offer").asc())
    # The length counts up to what decides, so a popular offer's list is cut before it is shuffled.
    ranked = (best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max(depth, min_len))
              .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("main_offer"))))
    return (ranked.where((F.col("rank") <= depth) & (F.col("n") >= min_len))
            .select("main_offer", F.col("rank").cast("bigint").alias("rank"), "sim_offer", "score"))


def order_events(orders: DataFrame, external: DataFrame, catalog: DataFrame, start: str,
                 external_type: str = "order") -> DataFrame:
    """Swing input: valid order rows plus external order actions on live catalog items."""
    o = orders.where(F.col("user_id").isNotNull() & (F.col("user_id") != "") & F.col("item_id").isNotNull()
                     & (F.col("item_id") != "") & (F.col("item_id") != "0") & (F.col("ymd") >= start)) \
        .select("user_id", "item_id")
    live = catalog.where(F.col("status") != 0).select("item_id")
    e = (external.where((F.col("ymd") >= start) & (F.col("type") == external_type))
         .join(live, "item_id").select("user_id", "item_id"))
    return o.unionByName(e)


def cf_events(log: DataFrame, external: DataFrame, catalog: DataFrame, start: str,
              external_type: str = "footprint") -> DataFrame:
    """Item-CF input: ``(user_id, item_id)`` of valid app clicks plus external actions on live catalog items."""
    clicks = valid_interactions(log, start=start).select("user_id", "item_id")
    live = catalog.where(F.col("status") != 0).select("item_id")
    e = (external.where((F.col("ymd") >= start) & (F.col("type") == external_type))
         .join(live, "item_id").select("user_id", "item_id"))
    return clicks.unionByName(e)
