"""Frequent pairs, association rules and their check on held-out data. Sets of any size are in ``itemsets``.

Pairs come from basket rows of any number: a basket is dealt out in blocks of some products, and pairs are made within
two blocks at a time, so a customer with a third of all rows is spread over many groups of bounded size and nothing is
left out.
"""

from __future__ import annotations

from math import ceil

from pyspark import StorageLevel
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window, functions as F

from cobasket.functions.ranking import top_ranked, with_rank
from cobasket.session import checkpointed, stored
from cobasket.operators.baskets import basket_count, basket_rows, sample_baskets

__all__ = ["basket_count"]

# Thresholds of the mining and validation jobs.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.1
MIN_TEST_SUPPORT = 5
TOP_VALIDATED = 10

BLOCK = 64  # products of a basket in a block
BUCKETS = 1 << 20  # hash buckets that pairs are counted in first


def pair_order(support: str = "support") -> list[Column]:
    """Highest support first; equal supports in item order."""
    return [F.desc(support), F.asc("item1"), F.asc("item2")]


def min_count_of(n_baskets: int, min_support: float) -> int:
    """The smallest number of baskets that reaches a relative support."""
    return max(1, ceil(min_support * n_baskets))


def item_rows(baskets: DataFrame, basket: str = "customer_id") -> DataFrame:
    """(basket, item), from baskets as rows or as lists."""
    item = F.explode("items") if "items" in baskets.columns else F.col("product_id")
    return baskets.select(basket, item.alias("item"))


def count_of_share(baskets: DataFrame, min_support: float, basket: str = "customer_id", at_least: int = 2) -> Column:
    """The number of baskets that reaches a relative support, as a scalar subquery: a threshold that grows with the data
    and needs no action of its own. What is in one basket alone is no pattern, so it is ``at_least`` two."""
    return F.greatest(F.lit(at_least), F.ceil(F.lit(float(min_support)) * basket_count(baskets, basket)))


def frequent_items(baskets: DataFrame, min_count: int | Column, basket: str = "customer_id") -> DataFrame:
    return (item_rows(baskets, basket).groupBy("item").agg(F.count("*").alias("support"))
            .filter(F.col("support") >= min_count))


def pair_groups(rows: DataFrame, basket: str = "customer_id", block: int = BLOCK) -> DataFrame:
    """Groups that together hold every pair of every basket: basket, _blocks, _i, _j, _items, from distinct rows (basket,
    item).

    A basket of n items has ceil(n / block) blocks by the hash of the item. An item goes to the groups of its block
    with each block, so a group holds two blocks: some 2 x ``block`` items, whatever the basket. Pairs inside one block
    are made in its group with itself. The numbers of blocks are stored before they are joined (see ``session.stored``);
    ``rows`` must not be dealt out by basket yet: those of a stored table or of a distinct are not.
    """
    sizes = stored(rows.groupBy(basket).agg(F.ceil(F.count("*") / block).cast("int").alias("_blocks")), "basket-blocks")
    placed = rows.join(sizes, basket).withColumn("_own", F.pmod(F.xxhash64("item"), F.col("_blocks")).cast("int"))
    dealt = placed.select(basket, "_blocks", "item", "_own", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_with"))
    # One key instead of three: rows that are dealt out by basket already would otherwise stay where they are.
    key = F.struct(basket, "_blocks", F.least("_own", "_with").alias("_i"), F.greatest("_own", "_with").alias("_j")).alias("_key")
    return dealt.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("item", "_own"))).alias("_items")) \
        .filter(F.size("_items") > 1).select("_key.*", "_items")


def pairs_of(groups: DataFrame, basket: str = "customer_id") -> DataFrame:
    """Every pair of :func:`pair_groups` once: basket, item1 < item2. A projection."""
    firsts = groups.select(basket, "_i", "_j", "_items", F.posexplode("_items").alias("_at", "_first"))
    later = F.slice("_items", F.col("_at") + 2, F.size("_items"))
    wanted = F.filter(later, lambda x: (F.col("_i") == F.col("_j")) | (x["_own"] != F.col("_first._own")))
    return firsts.select(basket, F.col("_first.item").alias("item1"), F.explode(wanted).alias("_second")) \
        .select(basket, "item1", F.col("_second.item").alias("item2"))


def pair_rows(rows: DataFrame, basket: str = "customer_id", block: int = BLOCK) -> DataFrame:
    """Every pair of every basket once: basket, item1 < item2, from distinct rows (basket, item)."""
    return pairs_of(pair_groups(rows, basket, block), basket)


def _bucket(buckets: int, *key: str) -> Column:
    return F.pmod(F.xxhash64(*(key or ("item1", "item2"))), F.lit(buckets))


def _bitmap(buckets: DataFrame) -> DataFrame:
    """Numbers of buckets (_bucket) as bits of words: word, bits."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_bucket") % 64).cast("int"))
    return buckets.groupBy((F.col("_bucket") / 64).cast("long").alias("word")).agg(F.bit_or(bit).alias("bits"))


def bitmap_of(keys: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """A bitmap of the hash buckets that hold a key, a row of all columns: word, bits; at most ``buckets`` / 64 rows."""
    return _bitmap(keys.select(_bucket(buckets, *keys.columns).alias("_bucket")))


def frequent_buckets(pairs: DataFrame, min_count: int | Column, buckets: int = BUCKETS) -> DataFrame:
    """A bitmap of the hash buckets whose pairs are, all together, in ``min_count`` baskets: word, bits. At most
    ``buckets`` / 64 rows. A frequent pair is in a frequent bucket; a bucket may be frequent without one."""
    counts = pairs.groupBy(_bucket(buckets).alias("_bucket")).agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_count)
    return _bitmap(counts)


def in_frequent_buckets(pairs: DataFrame, bitmap: DataFrame, buckets: int = BUCKETS, *key: str) -> DataFrame:
    """The pairs, or rows with another ``key``, whose bucket is in the bitmap; the rest is left out in the tasks that make
    them."""
    at = pairs.withColumn("_bucket", _bucket(buckets, *key)).withColumn("word", (F.col("_bucket") / 64).cast("long"))
    found = at.join(F.broadcast(bitmap), "word")  # at most `buckets` / 64 rows
    bit = F.call_function("getbit", "bits", (F.col("_bucket") % 64).cast("int"))
    return found.filter(bit == 1).select(pairs.columns)


def kept_rows(baskets: DataFrame, min_count: int | Column, basket: str = "customer_id") -> DataFrame:
    """Rows (basket, item) of frequent items: no other item is in a frequent set. Stored."""
    rows = item_rows(baskets, basket)
    return stored(rows.join(stored(frequent_items(baskets, min_count, basket).select("item"), "frequent-items"), "item",
                            "left_semi"), "kept-rows")


def counted_pairs(groups: DataFrame, min_count: int | Column, basket: str = "customer_id",
                  buckets: int = BUCKETS) -> DataFrame:
    """Pairs of stored groups in at least ``min_count`` baskets: item1 < item2, support."""
    pairs = pairs_of(groups, basket)
    bitmap = stored(frequent_buckets(pairs, min_count, buckets), "frequent-buckets")
    return (in_frequent_buckets(pairs, bitmap, buckets).groupBy("item1", "item2").agg(F.count("*").alias("support"))
            .filter(F.col("support") >= min_count))


def frequent_pairs(baskets: DataFrame, min_count: int | Column, basket: str = "customer_id", block: int = BLOCK,
                   buckets: int = BUCKETS) -> DataFrame:
    """Item pairs in at least ``min_count`` baskets: item1 < item2, support.

    Infrequent items are taken out first, as no frequent pair holds one. Pairs are then made twice from stored groups:
    first only counted by hash bucket, which shuffles at most ``buckets`` numbers a task, then those of frequent buckets
    are counted themselves. So the pairs that are shuffled are few beside those that are not frequent.
    """
    kept = kept_rows(baskets, min_count, basket)
    return counted_pairs(stored(pair_groups(kept, basket, block), "pair-groups"), min_count, basket, buckets)


def fpgrowth_itemsets(baskets: DataFrame, min_count: int, n_baskets: int | None = None,
                      num_partitions: int | None = None) -> DataFrame:
    """Itemsets of any size in at least ``min_count`` baskets, by MLlib's FP-Growth: items (sorted), support.

    For baskets as lists that are short, and items that fit the driver: MLlib keeps the frequent ones there.
    ``itemsets.frequent_itemsets`` needs neither. The baskets are kept on disk while the trees are built, and the
    itemsets are checkpointed, so that using them does not mine again. ``min_count - 0.5`` keeps the relative support
    clear of rounding.
    """
    kept = baskets.select("items").persist(StorageLevel.DISK_ONLY)
    try:
        total = kept.count() if n_baskets is None else n_baskets
        growth = FPGrowth(itemsCol="items", minSupport=min((min_count - 0.5) / max(total, 1), 1.0))
        if num_partitions:
            growth = growth.setNumPartitions(num_partitions)
        itemsets = growth.fit(kept).freqItemsets
        return checkpointed(itemsets.select(F.sort_array("items").alias("items"), F.col("freq").alias("support")))
    finally:
        kept.unpersist()


def itemsets_of_size(itemsets: DataFrame, size: int) -> DataFrame:
    """Itemsets of one size as flat columns item1, item2, ..."""
    return itemsets.filter(F.size("items") == size).select(
        *[F.get("items", F.lit(i)).alias(f"item{i + 1}") for i in range(size)], "support")


def association_rules(itemsets: DataFrame, n_baskets: Column | int, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules with one consequent from all itemsets: antecedent, consequent, confidence, lift, support.

    Each itemset is joined with the itemset of its antecedent and that of its consequent. Both exist, as every part of
    a frequent itemset is frequent.
    """
    n = F.lit(n_baskets) if isinstance(n_baskets, int) else n_baskets
    candidates = (itemsets.filter(F.size("items") >= 2)
                  .select("items", F.col("support").alias("_both"), F.explode("items").alias("consequent"))
                  .withColumn("antecedent", F.array_remove("items", F.col("consequent"))).drop("items"))
    antecedents = itemsets.select(F.col("items").alias("antecedent"), F.col("support").alias("_if"))
    consequents = (itemsets.filter(F.size("items") == 1)
                   .select(F.get("items", F.lit(0)).alias("consequent"), F.col("support").alias("_then")))
    rules = candidates.join(antecedents, "antecedent").join(consequents, "consequent")
    confidence = F.col("_both") / F.col("_if")
    return (rules.select("antecedent", "consequent", confidence.alias("confidence"),
                         (confidence / (F.col("_then") / n)).alias("lift"), (F.col("_both") / n).alias("support"))
            .filter(F.col("confidence") >= min_confidence))


def pair_rules(pairs: DataFrame, items: DataFrame, n_baskets: Column | int,
               min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules between single items, in both directions, from frequent pairs and all items of theirs."""
    n = F.lit(n_baskets) if isinstance(n_baskets, int) else n_baskets
    both = F.array(F.struct(F.col("item1").alias("antecedent"), F.col("item2").alias("consequent")),
                   F.struct(F.col("item2").alias("antecedent"), F.col("item1").alias("consequent")))
    directed = pairs.select(F.inline(both), F.col("support").alias("_both"))
    rules = (directed
             .join(items.select(F.col("item").alias("antecedent"), F.col("support").alias("_if")), "antecedent")
             .join(items.select(F.col("item").alias("consequent"), F.col("support").alias("_then")), "consequent"))
    confidence = F.col("_both") / F.col("_if")
    return (rules.select("antecedent", "consequent", confidence.alias("confidence"),
                         (confidence / (F.col("_then") / n)).alias("lift"), (F.col("_both") / n).alias("support"))
            .filter(F.col("confidence") >= min_confidence))


def rule_order() -> list[Column]:
    return [F.desc("confidence"), F.desc("lift"), F.asc("antecedent"), F.asc("consequent")]


def ranked_patterns(pairs: DataFrame, n_baskets: Column | int, items: DataFrame | None = None,
                    top: int | None = None) -> DataFrame:
    """Pairs numbered by support: rank, item1, item2, support, confidence [, rule_confidence].

    ``confidence`` is the share of baskets that hold the pair. With ``items``, ``rule_confidence`` is the larger of the
    two conditional probabilities. ``top`` keeps the first patterns only, which needs no checkpoint.
    """
    ranked = with_rank(pairs, *pair_order()) if top is None else top_ranked(pairs, top, *pair_order())
    n = F.lit(n_baskets) if isinstance(n_baskets, int) else n_baskets
    out = ranked.select("rank", "item1", "item2", "support", (F.col("support") / n).alias("confidence"))
    if items is None:
        return out
    one, two = [items.select(F.col("item").alias(f"item{i}"), F.col("support").alias(f"_n{i}")) for i in (1, 2)]
    return (out.join(one, "item1").join(two, "item2")
            .select(*out.columns, (F.col("support") / F.least("_n1", "_n2")).alias("rule_confidence")))


def train_rows(reviews: DataFrame, dataset: str = "train") -> DataFrame:
    """The basket rows of one dataset. Store them: its patterns, items, rules and number of baskets all read them."""
    return basket_rows(reviews.filter(F.col("dataset") == dataset))


def train_patterns(reviews: DataFrame, min_count: int, dataset: str = "train",
                   max_baskets: int | None = None) -> DataFrame:
    """Frequent pairs of one dataset's baskets; of about ``max_baskets`` of them if that is given."""
    rows = train_rows(reviews, dataset)
    return frequent_pairs(rows if max_baskets is None else sample_baskets(rows, max_baskets), min_count)


def validate_patterns(train_pairs: DataFrame, reviews: DataFrame, min_test_support: int = MIN_TEST_SUPPORT,
                      dataset: str = "test") -> DataFrame:
    """Count all training pairs in the held-out rows: item1, item2, train_support, test_support, total_support.

    The held-out rows that hold an item of a training pair give their pairs, as in mining; those that aren't training
    pairs are left out before they are counted.
    """
    wanted = train_pairs.select(F.explode(F.array("item1", "item2")).alias("item")).distinct()
    rows = (reviews.filter((F.col("dataset") == dataset) & F.col("customer_id").isNotNull())
            .select("customer_id", F.col("product_id").alias("item")).join(wanted, "item", "left_semi").distinct())
    counts = (pair_rows(rows).join(train_pairs.select("item1", "item2"), ["item1", "item2"], "left_semi")
              .groupBy("item1", "item2").agg(F.count("*").alias("test_support")))
    return (train_pairs.join(counts, ["item1", "item2"]).filter(F.col("test_support") >= min_test_support)
            .select("item1", "item2", F.col("support").alias("train_support"), "test_support",
                    (F.col("support") + F.col("test_support")).alias("total_support")))


def top_validated(validated: DataFrame, k: int = TOP_VALIDATED) -> DataFrame:
    return validated.orderBy(*pair_order("total_support")).limit(k)


def mining_stats(reviews: DataFrame, validated: DataFrame) -> DataFrame:
    """One row: reviews in all, per dataset, and the number of validated patterns."""
    return reviews.agg(
        F.count("*").alias("total_reviews"),
        F.count_if(F.col("dataset") == "train").alias("train_reviews"),
        F.count_if(F.col("dataset") == "test").alias("test_reviews"),
    ).withColumn("num_patterns", validated.agg(F.count("*")).scalar())


def similar_items(similar_pairs: DataFrame) -> DataFrame:
    """The products of similar pairs, in the order they first appear, strongest pair first: position, asin, title,
    support. ``similar_pairs`` comes from ``summary.similar_pair_support``; an item's support is its review count."""
    ranked = with_rank(similar_pairs, F.desc("support"), F.asc("asin1"), F.asc("asin2"))
    ends = F.array(*[F.struct((F.col("rank") * 2 + (i - 2)).alias("_at"), F.col(f"asin{i}").alias("asin"),
                              F.col(f"title{i}").alias("title"), F.col(f"reviews{i}").alias("support"))
                     for i in (1, 2)])
    once = ranked.select(F.inline(ends)).groupBy("asin").agg(
        F.min("_at").alias("_at"), F.max("title").alias("title"), F.max("support").alias("support"))
    return with_rank(once, "_at", name="position").select("position", "asin", "title", "support")


def similar_rules(similar_pairs: DataFrame) -> DataFrame:
    """Rules in both directions from all similar pairs, with review counts as item supports.

    lift = confidence / (support of the consequent / sum of all item supports); items without support give no rule.
    """
    ends = F.array(*[F.struct(F.col(f"asin{i}").alias("asin"), F.col(f"reviews{i}").alias("n")) for i in (1, 2)])
    total = similar_pairs.select(F.inline(ends)).groupBy("asin").agg(F.max("n").alias("n")).agg(F.sum("n")).scalar()
    known = similar_pairs.filter((F.col("reviews1") > 0) & (F.col("reviews2") > 0))
    both = F.array(*[F.struct(F.col(f"asin{a}").alias("antecedent"), F.col(f"asin{b}").alias("consequent"),
                              F.col(f"reviews{a}").alias("_if"), F.col(f"reviews{b}").alias("_then"))
                     for a, b in ((1, 2), (2, 1))])
    confidence = F.col("support") / F.col("_if")
    return (known.select(F.inline(both), "support")
            .select("antecedent", "consequent", confidence.alias("confidence"),
                    (confidence / (F.col("_then") / total)).alias("lift"), "support")
            .orderBy(F.desc("confidence"), "antecedent", "consequent"))
