"""Baskets, splits, frequent itemsets, rules and their check: against brute force on small random data."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from cobasket.functions.ranking import with_rank
from cobasket.operators import baskets as bk, mining
from conftest import tuples

SCHEMA = "customer_id string, product_id string, rating int"


def random_reviews(seed=7, customers=60, products=15, n=700):
    """Reviews with one customer and one product that hold about a third of all rows each."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        customer = "c00" if rng.random() < 0.33 else f"c{rng.randrange(customers):02}"
        product = "p00" if rng.random() < 0.33 else f"p{rng.randrange(products):02}"
        rows.append((customer, product, rng.randint(1, 5)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return random_reviews()


@pytest.fixture(scope="module")
def reviews(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def brute_baskets(rows, max_items):
    items = defaultdict(set)
    for customer, product, _ in rows:
        items[customer].add(product)
    return {c: sorted(p)[:max_items] for c, p in items.items() if len(p) >= 2}


def brute_counts(baskets, size):
    return Counter(combo for items in baskets.values() for combo in combinations(items, size))


@pytest.mark.parametrize("max_items", [2, 4, 30])
def test_baskets(reviews, rows, max_items):
    assert {r.customer_id: r["items"] for r in bk.baskets(reviews, max_items).collect()} == \
        brute_baskets(rows, max_items)


def test_baskets_skip_missing_keys(spark):
    found = spark.createDataFrame([("c", "a", 1), ("c", None, 1), (None, "a", 1), (None, "b", 1)], SCHEMA)
    assert bk.baskets(found).count() == 0


def test_sampled_items_do_not_depend_on_partitions(spark, rows):
    one = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    many = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), SCHEMA).repartition(13, "rating")
    found = [tuples(bk.baskets_sampled_items(df, 4).withColumn("items", F.array_join("items", ","))) for df in (one, many)]
    assert found[0] == found[1]
    assert all(2 <= len(items.split(",")) <= 4 for _, items in found[0])
    assert found[0] != tuples(bk.baskets(one, 4).withColumn("items", F.array_join("items", ",")))


def test_basket_sample_is_near_its_budget(spark):
    baskets = spark.range(4000).select(F.col("id").alias("customer_id"))
    assert bk.sample_baskets(baskets, 5000).count() == 4000
    assert 850 < bk.sample_baskets(baskets, 1000).count() < 1150


def test_split_is_by_row_and_near_its_share(spark):
    rows = spark.range(5000).select((F.col("id") % 50).alias("customer_id"), F.col("id").alias("product_id"))
    counts = dict(tuples(bk.split_counts(bk.train_test_split(rows))))
    assert 3350 < counts["train"] < 3650 and counts["train"] + counts["test"] == 5000
    by_customer = bk.train_test_split(rows, split_by="customer_id")
    assert by_customer.select("customer_id", "dataset").distinct().count() == 50


def test_split_that_exists_is_kept(spark):
    rows = spark.createDataFrame([("c", "a", "test"), ("d", "a", None)],
                                 "customer_id string, product_id string, dataset string")
    found = {r.customer_id: r.dataset for r in bk.train_test_split(rows).collect()}
    assert found["c"] == "test" and found["d"] in {"train", "test"}
    fresh = bk.train_test_split(rows.withColumn("dataset", F.lit(None).cast("string")))
    assert {r.dataset for r in fresh.collect()} <= {"train", "test"}


def test_partial_split_loses_no_row(spark):
    rows = spark.range(400).select("id", F.when(F.col("id") == 7, "test").alias("dataset"))
    found = dict(tuples(bk.split_counts(bk.train_test_split(rows))))
    assert set(found) == {"train", "test"} and sum(found.values()) == 400


def test_only_a_dataset_without_rows_stands_for_all_unless_asked(spark):
    rows = spark.range(400).select("id", F.when(F.col("id") < 99, "a").otherwise("b").alias("dataset"))
    assert bk.dataset_or_all(rows, "a").count() == 99
    assert bk.dataset_or_all(rows, "none").count() == 400
    assert bk.dataset_or_all(rows, "a", min_rows=100).count() == 400


def test_small_training_set_is_not_mixed_with_test_rows(spark):
    rows = spark.createDataFrame([("c", p, 1, "train") for p in "ab"] + [("d", p, 1, "test") for p in "xyz"],
                                 SCHEMA + ", dataset string")
    assert tuples(mining.train_patterns(rows, 1)) == [("a", "b", 1)]


@pytest.mark.parametrize("block", [1, 2, 8, 64])
def test_pairs_of_whole_baskets(spark, reviews, rows, block):
    """One customer holds a third of all rows; blocks change the groups, not the pairs."""
    found = mining.frequent_pairs(bk.basket_rows(reviews), 2, block=block)
    want = {pair: n for pair, n in brute_counts(brute_baskets(rows, None), 2).items() if n >= 2}
    assert {(r.item1, r.item2): r.support for r in found.collect()} == want


def test_large_basket_is_spread(spark):
    rows = spark.range(1000).select(F.lit("c").alias("customer_id"), F.col("id").alias("item"))
    pairs = mining.pair_rows(rows, block=50)
    assert pairs.count() == pairs.distinct().count() == 1000 * 999 // 2
    assert pairs.filter("item1 >= item2").isEmpty()


def test_no_rows_no_pairs(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert mining.frequent_pairs(bk.basket_rows(none), 1).isEmpty()


def test_basket_rows_are_sampled_by_basket(spark):
    rows = spark.range(4000).select((F.col("id") % 1000).alias("customer_id"), F.col("id").alias("product_id"))
    kept = bk.sample_baskets(rows, 300)
    sizes = kept.groupBy("customer_id").count()
    assert 230 < sizes.count() < 370 and sizes.filter("count != 4").isEmpty()
    assert rows.select(bk.basket_count(rows)).first()[0] == 1000


@pytest.mark.parametrize("min_count", [1, 3, 8])
def test_pairs(reviews, rows, min_count):
    want = {pair: n for pair, n in brute_counts(brute_baskets(rows, 6), 2).items() if n >= min_count}
    found = mining.frequent_pairs(bk.baskets(reviews, 6), min_count)
    assert {(r.item1, r.item2): r.support for r in found.collect()} == want


def test_itemsets_by_both_ways(reviews, rows):
    baskets = bk.baskets(reviews, 6)
    itemsets = mining.fpgrowth_itemsets(baskets, 4)
    brute = brute_baskets(rows, 6)
    want = {combo: n for size in range(1, 7) for combo, n in brute_counts(brute, size).items() if n >= 4}
    assert {tuple(r["items"]): r.support for r in itemsets.collect()} == want
    assert tuples(mining.itemsets_of_size(itemsets, 2)) == tuples(mining.frequent_pairs(baskets, 4))
    assert tuples(mining.itemsets_of_size(itemsets, 1)) == tuples(mining.frequent_items(baskets, 4))


def test_share_of_baskets_as_threshold(spark):
    rows = spark.createDataFrame([(c, p) for c in range(10) for p in ("a", "b", "c")[:2 + (c < 3)]],
                                 "customer_id int, product_id string")
    found = {share: tuples(mining.frequent_items(rows, mining.count_of_share(rows, share))) for share in (0.0, 0.3, 0.31)}
    assert rows.select(mining.count_of_share(rows, 0.01)).first()[0] == 2
    assert found[0.0] == found[0.3] == [("a", 10), ("b", 10), ("c", 3)] and found[0.31] == [("a", 10), ("b", 10)]


def test_rules_are_those_of_the_library(reviews):
    baskets = bk.baskets(reviews, 6).persist()
    n = baskets.count()
    model = FPGrowth(itemsCol="items", minSupport=3.5 / n, minConfidence=0.2).fit(baskets)
    want = {(tuple(sorted(r.antecedent)), r.consequent[0]): (r.confidence, r.lift, r.support)
            for r in model.associationRules.collect()}
    rules = mining.association_rules(mining.fpgrowth_itemsets(baskets, 4), n, 0.2).collect()
    got = {(tuple(r.antecedent), r.consequent): (r.confidence, r.lift, r.support) for r in rules}
    assert got.keys() == want.keys() and len(rules) == len(want) > 20
    for key, values in want.items():
        assert got[key] == pytest.approx(values)
    pairs, items = mining.frequent_pairs(baskets, 4), mining.frequent_items(baskets, 4)
    single = {(k[0][0], k[1]) for k in want if len(k[0]) == 1}
    assert {(r.antecedent, r.consequent) for r in mining.pair_rules(pairs, items, n, 0.2).collect()} == single
    baskets.unpersist()


def test_pair_support_is_no_larger_than_that_of_its_items(reviews):
    baskets = bk.baskets(reviews, 6)
    items = {r.item: r.support for r in mining.frequent_items(baskets, 1).collect()}
    for row in mining.frequent_pairs(baskets, 1).collect():
        assert row.support <= min(items[row.item1], items[row.item2])


def test_rank_is_the_position_in_the_total_order(spark):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 5]), i, rng.randrange(9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "support int, item1 int, item2 int").repartition(7)
    ranked = with_rank(df, *mining.pair_order()).collect()
    want = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    assert [(r.support, r.item1, r.item2) for r in sorted(ranked, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in ranked) == list(range(1, 3001))


def test_rank_of_nothing(spark):
    assert with_rank(spark.createDataFrame([], "support int, item1 int, item2 int"), "item1").count() == 0


def test_ranked_patterns(reviews):
    baskets = bk.baskets(reviews, 6)
    pairs, items = mining.frequent_pairs(baskets, 2), mining.frequent_items(baskets, 2)
    n = baskets.count()
    every = sorted(mining.ranked_patterns(pairs, mining.basket_count(baskets), items).collect(), key=lambda r: r["rank"])
    top = sorted(mining.ranked_patterns(pairs, n, top=5).collect(), key=lambda r: r["rank"])
    assert [r[:5] for r in every[:5]] == [r[:5] for r in top]
    support = {r.item: r.support for r in items.collect()}
    for row in every:
        assert row.confidence == pytest.approx(row.support / n)
        assert row.rule_confidence == pytest.approx(
            max(row.support / support[row.item1], row.support / support[row.item2]))


def test_validation_counts_customers_with_both_items(spark, reviews, rows):
    split = bk.train_test_split(reviews)
    train = mining.frequent_pairs(bk.baskets(split.filter("dataset = 'train'"), 6), 2)
    found = mining.validate_patterns(train, split, min_test_support=2)
    test = defaultdict(set)
    for r in split.filter("dataset = 'test'").collect():
        test[r.customer_id].add(r.product_id)
    want = set()
    for r in train.collect():
        n = sum(r.item1 in items and r.item2 in items for items in test.values())
        if n >= 2:
            want.add((r.item1, r.item2, r.support, n, r.support + n))
    assert set(tuples(found)) == want and want
    best = mining.top_validated(found, 2).collect()
    assert [r.total_support for r in best] == sorted((w[4] for w in want), reverse=True)[:2]
    stats = mining.mining_stats(split, found).collect()[0]
    assert stats.total_reviews == len(rows) == stats.train_reviews + stats.test_reviews
    assert stats.num_patterns == len(want)


def test_rules_from_similar_pairs(spark):
    pairs = spark.createDataFrame([("A", "a", 10, "B", "b", 20, 5), ("B", "b", 20, "C", None, 4, 4),
                                   ("D", "d", 0, "A", "a", 10, 3)],
                                  "asin1 string, title1 string, reviews1 bigint, asin2 string, title2 string, "
                                  "reviews2 bigint, support bigint")
    items = [tuple(r) for r in mining.similar_items(pairs).orderBy("position").collect()]
    assert items == [(1, "A", "a", 10), (2, "B", "b", 20), (3, "C", None, 4), (4, "D", "d", 0)]
    rules = {(r.antecedent, r.consequent): (r.confidence, r.lift) for r in mining.similar_rules(pairs).collect()}
    assert set(rules) == {("A", "B"), ("B", "A"), ("B", "C"), ("C", "B")}
    assert rules["A", "B"] == pytest.approx((0.5, 0.5 / (20 / 34)))
    assert rules["C", "B"] == pytest.approx((1.0, 1.0 / (20 / 34)))
