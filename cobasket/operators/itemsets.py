"""Frequent itemsets of any size, level by level, and their support in held-out data.

Baskets of a block of items at most, as most are, are short lists: the sets in one are made where it is read, item by item
along those that are wanted, and only their counts are shuffled. Larger baskets stay rows (basket, item) and have
*occurrences*, rows (set, basket): those of a smaller set joined with the rows of the one item that is missing. So no list
is longer than a block, a set of any support is spread over tasks, and no list of items is kept on the driver. The driver
counts levels only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cobasket.operators.mining import BLOCK, bitmap_of, counted_pairs, frequent_items, in_frequent_buckets, kept_rows, \
    pair_groups, pairs_of
from cobasket.session import stored

BUCKETS = 1 << 23  # hash buckets of a bitmap of sets: 131,072 words at most


def _numbered(sets: DataFrame, name: str) -> DataFrame:
    """The sets with a number each, stored."""
    return stored(sets.withColumn("set", F.monotonically_increasing_id()), name)


def extended(occurrences: DataFrame, by: DataFrame, rows: DataFrame, basket: str) -> DataFrame:
    """Occurrences (set, basket) of larger sets, stored. ``by`` says which set, with which item, makes which larger one:
    set, item, larger. Both joins are between stored tables or projections of them, so the skew join splits a hot set."""
    grown = occurrences.join(by, "set").select(F.col("larger").alias("set"), basket, "item")
    return stored(grown.join(rows, [basket, "item"], "left_semi").select("set", basket), "occurrences")


def set_bitmap(sets: DataFrame, size: int) -> DataFrame:
    """A stored bitmap of the first ``size`` items of each set (items)."""
    begun = sets.filter(F.size("items") >= size).select(F.slice("items", 1, size).alias("items"))
    return stored(bitmap_of(begun, BUCKETS), "set-buckets")


def counted_sets(lists: DataFrame, bitmaps: list[DataFrame]) -> DataFrame:
    """How many lists (items; short, sorted, distinct) hold a set: items, n; of all sets in the last of ``bitmaps``, and of
    a few more that share a bucket with one.

    ``bitmaps`` are those of two items, of three and so on. A set grows item by item and goes on while its beginning is in
    the bitmap of its size; what it may go on with comes after its last item. All that in the task that reads the list.
    """
    size = len(bitmaps) + 1
    grown = lists.select(F.slice("items", 1, 0).alias("_set"), F.col("items").alias("_rest"))
    for n in range(1, size + 1):
        usable = F.slice("_rest", F.lit(1), F.greatest(F.size("_rest") - (size - n), F.lit(0)))  # enough must come after it
        grown = grown.select("_set", "_rest", F.posexplode(usable).alias("_at", "_item")).select(
            F.concat("_set", F.array("_item")).alias("_set"), F.slice("_rest", F.col("_at") + 2, F.size("_rest")).alias("_rest"))
        if n > 1:
            grown = in_frequent_buckets(grown, bitmaps[n - 2], BUCKETS, "_set")
    return grown.groupBy(F.col("_set").alias("items")).agg(F.count("*").alias("n"))


def candidates(sets: DataFrame, size: int) -> DataFrame:
    """Sets of ``size`` + 1 items all of whose subsets are among ``sets`` (set, items, support): larger, items, and the
    rarest subset (set) with the item that it lacks.

    Two sets that agree but for their last items make a candidate; then all its subsets are looked up.
    """
    prefix = F.slice("items", 1, size - 1)
    one = sets.select(prefix.alias("prefix"), "items", F.element_at("items", -1).alias("last"))
    two = sets.select(prefix.alias("prefix"), F.element_at("items", -1).alias("new"))
    made = _numbered(one.join(two, "prefix").filter(F.col("last") < F.col("new"))
                     .select(F.concat("items", F.array("new")).alias("whole")), "candidates")
    parts = made.select("set", "whole", F.explode("whole").alias("item")).select(
        F.col("set").alias("larger"), "whole", "item", F.array_remove("whole", F.col("item")).alias("items"))
    found = parts.join(sets, "items").groupBy("larger").agg(
        F.count("*").alias("_n"), F.first("whole").alias("items"),
        F.min(F.struct("support", "set", "item")).alias("_rarest"))
    return stored(found.filter(F.col("_n") == size + 1).select("larger", "items", "_rarest.set", "_rarest.item"),
                  "checked-candidates")


def frequent_itemsets(baskets: DataFrame, min_count: int | Column, basket: str = "customer_id",
                      max_size: int | None = None, block: int = BLOCK) -> DataFrame:
    """Itemsets in at least ``min_count`` baskets, of any size or of ``max_size`` at most: items (sorted), support.

    ``baskets`` are rows or lists, and ``min_count`` may be a share of them (``mining.count_of_share``). Pairs are counted
    as in ``mining.frequent_pairs``. Each further level makes candidates of frequent sets, checks their subsets, and
    counts the baskets that hold a candidate: those of one block in place, larger ones among those of its rarest subset.
    """
    items = stored(frequent_items(baskets, min_count, basket), "items")
    levels = [items.select(F.array("item").alias("items"), "support")]
    if max_size == 1:
        return levels[0]
    rows = kept_rows(baskets, min_count, basket)
    groups = stored(pair_groups(rows, basket, block), "pair-groups")
    sets = _numbered(counted_pairs(groups, min_count, basket).select(F.array("item1", "item2").alias("items"), "support"),
                     "sets")
    lists = groups.filter("_blocks = 1").select(F.col("_items.item").alias("items"))
    large = groups.filter("_blocks > 1")
    known = sets.select("set", F.get("items", F.lit(0)).alias("item1"), F.get("items", F.lit(1)).alias("item2"))
    occurrences = None if large.isEmpty() else pairs_of(large, basket).join(known, ["item1", "item2"]).select("set", basket)
    size, bitmaps = 2, []
    while not sets.isEmpty():
        levels.append(sets.select("items", "support"))
        if size == max_size:
            break
        bitmaps.append(set_bitmap(sets, size))
        made = candidates(sets, size)
        numbers = made.select(F.col("larger").alias("set"), "items")
        counts = counted_sets(lists, [*bitmaps, set_bitmap(made, size + 1)]).join(numbers, "items").select("set", "n")
        if occurrences is not None:
            occurrences = extended(occurrences, made.select("set", "item", "larger"), rows, basket)
            counts = counts.unionByName(occurrences.groupBy("set").agg(F.count("*").alias("n")))
        counts = stored(counts.groupBy("set").agg(F.sum("n").alias("support")).filter(F.col("support") >= min_count),
                        "supports")
        sets = stored(numbers.join(counts, "set"), "sets")
        size += 1
    return reduce(DataFrame.unionByName, levels)


def _paths(sets: DataFrame, counts: DataFrame) -> DataFrame:
    """set, path: the items of each set, the rarest first. Sets with an item that has no row are left out."""
    items = sets.select("set", F.size("items").alias("_n"), F.explode("items").alias("item")).join(counts, "item")
    return items.groupBy("set", "_n").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("_by")) \
        .filter(F.size("_by") == F.col("_n")).select("set", F.col("_by.item").alias("path"))


def set_support(sets: DataFrame, rows: DataFrame, basket: str = "customer_id", block: int = BLOCK) -> DataFrame:
    """In how many baskets of ``rows`` (basket, item; distinct) each set (set, items) is contained: set, n; only sets that
    are in one.

    Baskets of ``block`` wanted items at most become lists, in which sets are made along their own beginnings
    (:func:`counted_sets`), all sets of one size at a time; larger baskets go along an index (:func:`_large_support`).
    """
    sets = stored(sets.select("set", F.array_sort(F.array_distinct("items")).alias("items")), "wanted-sets")
    wanted = sets.select(F.explode("items").alias("item")).distinct()
    rows = stored(rows.select(basket, "item").join(wanted, "item", "left_semi"), "wanted-rows")
    counts = stored(rows.groupBy("item").agg(F.count("*").alias("n")), "item-counts")
    sizes = stored(rows.groupBy(basket).agg(F.count("*").alias("_n")).filter("_n >= 2"), "basket-sizes")
    few = rows.join(sizes.filter(F.col("_n") <= block), basket, "left_semi")
    # Another key than the join's: so the skew join can split a large basket, which goes no further.
    lists = stored(few.groupBy(F.struct(basket)).agg(F.array_sort(F.collect_list("item")).alias("items")).select("items"),
                   "basket-lists")
    found = [sets.filter("size(items) = 1").join(counts, F.get("items", F.lit(0)) == F.col("item")).select("set", "n")]
    most = sets.agg(F.coalesce(F.max(F.size("items")), F.lit(0))).first()[0]
    bitmaps = [set_bitmap(sets, size) for size in range(2, most + 1)]
    for size in range(2, most + 1):
        found.append(counted_sets(lists, bitmaps[:size - 1]).join(sets, "items").select("set", "n"))
    large = stored(rows.join(sizes.filter(F.col("_n") > block), basket, "left_semi"), "large-rows")
    if not large.isEmpty():
        found.append(_large_support(sets.filter("size(items) > 1"), large, counts, basket))
    return stored(reduce(DataFrame.unionByName, found).groupBy("set").agg(F.sum("n").alias("n")), "set-counts")


def _large_support(sets: DataFrame, rows: DataFrame, counts: DataFrame, basket: str) -> DataFrame:
    """:func:`set_support` for baskets of any size. ``counts`` are the rows of each item: item, n.

    The sets form an index: each is a path of its items from its rarest one on, and sets that begin alike share the
    beginning. Baskets enter at the items that lead a path and go on item by item, all paths at a time.
    """
    paths = stored(_paths(sets, counts), "paths")
    prefixes = paths.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("path")), lambda n: F.slice("path", F.lit(1), n)))
                            .alias("path")).distinct()
    nodes = stored(prefixes.withColumn("node", F.monotonically_increasing_id()), "index-nodes")
    above = nodes.select(F.col("path").alias("_above"), F.col("node").alias("parent"))
    size = F.size("path")
    index = stored(nodes.join(above, F.slice("path", F.lit(1), size - 1) == F.col("_above"), "left").select(
        "node", "parent", size.alias("depth"), F.element_at("path", -1).alias("item")), "index")
    depth = index.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    lead = index.filter("depth = 1").select("node", "item")
    found = [stored(rows.join(lead, "item").select(F.col("node").alias("set"), basket), "occurrences")]
    for level in range(2, depth + 1):
        by = index.filter(F.col("depth") == level).select(F.col("parent").alias("set"), "item",
                                                          F.col("node").alias("larger"))
        found.append(extended(found[-1], by, rows, basket))
    counted = reduce(DataFrame.unionByName, [o.groupBy("set").agg(F.count("*").alias("n")) for o in found])
    ends = paths.join(nodes, "path").select("set", "node")
    return ends.join(counted.withColumnRenamed("set", "node"), "node").select("set", "n")


def validate_itemsets(itemsets: DataFrame, reviews: DataFrame, min_test_support: int = 1, dataset: str = "test",
                      basket: str = "customer_id", item: str = "product_id") -> DataFrame:
    """Training itemsets (items, support) of any size that are in at least ``min_test_support`` baskets of the held-out
    rows: items, n_items, train_support, test_support, total_support."""
    sets = _numbered(itemsets.select("items", "support"), "training-sets")
    rows = (reviews.filter((F.col("dataset") == dataset) & F.col(basket).isNotNull())
            .select(basket, F.col(item).alias("item")).distinct())
    counts = set_support(sets, rows, basket)
    return sets.join(counts, "set").filter(F.col("n") >= min_test_support).select(
        "items", F.size("items").alias("n_items"), F.col("support").alias("train_support"),
        F.col("n").alias("test_support"), (F.col("support") + F.col("n")).alias("total_support"))
