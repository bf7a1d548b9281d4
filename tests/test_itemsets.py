"""Itemsets of any size and their held-out support, against brute force and against MLlib."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cobasket.operators import baskets as bk, itemsets as it, mining
from conftest import tuples

ROWS = "order_id int, product_id string"


def orders(seed=3, n=120, items=14):
    """Orders of some items that like each other, and one order that holds a third of all rows."""
    rng = random.Random(seed)
    out = []
    for order in range(1, n):
        base = rng.randrange(items)
        out += {(order, f"i{(base + rng.choice([0, 1, 2, 3, 5])) % items:02}") for _ in range(rng.randrange(2, 8))}
    hot = [(0, f"i{i:02}") for i in range(items)] + [(0, f"x{i:03}") for i in range(len(out) // 2 - items)]
    return sorted(out) + hot


def brute_sets(rows, least, largest=None):
    baskets = defaultdict(set)
    for order, item in rows:
        baskets[order].add(item)
    baskets = [b for b in baskets.values() if len(b) >= 2]
    frequent = {x for x, n in Counter(i for b in baskets for i in b).items() if n >= least}
    found, size = {(x,): sum(x in b for b in baskets) for x in frequent}, 2
    while size <= (largest or 99):
        counts = Counter(c for b in baskets for c in combinations(sorted(b & frequent), size))
        more = {c: n for c, n in counts.items() if n >= least}
        if not more:
            break
        found |= more
        size += 1
    return found


def as_dict(frame):
    rows = frame.collect()
    assert len({tuple(r["items"]) for r in rows}) == len(rows)
    return {tuple(r["items"]): r.support for r in rows}


@pytest.mark.parametrize("least, block", [(3, 64), (8, 2), (14, 3)])
def test_sets_of_any_size(spark, least, block):
    rows = orders()
    found = bk.basket_rows(spark.createDataFrame(rows, ROWS), "order_id")
    want = brute_sets(rows, least)
    assert as_dict(it.frequent_itemsets(found, least, "order_id", block=block)) == want
    assert max(map(len, want)) >= (4 if least == 3 else 2)
    lists = bk.baskets(spark.createDataFrame(rows, ROWS), basket="order_id")
    assert as_dict(mining.fpgrowth_itemsets(lists, least)) == want


def test_limit_share_and_lists(spark):
    rows = orders(seed=4)
    frame = spark.createDataFrame(rows, ROWS)
    found, lists = bk.basket_rows(frame, "order_id"), bk.baskets(frame, basket="order_id")
    for size in (1, 2, 3):
        assert as_dict(it.frequent_itemsets(found, 4, "order_id", max_size=size)) == brute_sets(rows, 4, size)
    n = lists.count()
    share = mining.count_of_share(found, 0.05, "order_id")
    assert as_dict(it.frequent_itemsets(found, share, "order_id")) == brute_sets(rows, mining.min_count_of(n, 0.05))
    assert as_dict(it.frequent_itemsets(lists, 6, "order_id")) == brute_sets(rows, 6)


def test_nothing_frequent(spark):
    frame = spark.createDataFrame(orders(), ROWS)
    assert it.frequent_itemsets(bk.basket_rows(frame, "order_id"), 10_000, "order_id").isEmpty()
    assert it.frequent_itemsets(bk.basket_rows(frame.limit(0), "order_id"), 1, "order_id").isEmpty()


def test_a_hot_order_is_spread_over_bounded_groups(spark):
    """One order with 2,000 items, a third of all rows; no group holds more than two blocks of it, with room for chance."""
    rows = spark.range(2000).select(F.lit(0).alias("order_id"), F.col("id").alias("product_id")).unionByName(
        spark.range(4000).select((F.col("id") / 4 + 1).cast("int").alias("order_id"), F.col("id").alias("product_id")))
    groups = mining.pair_groups(mining.item_rows(rows, "order_id"), "order_id", block=50)
    sizes = [r[0] for r in groups.filter("order_id = 0").select(F.size("_items")).collect()]
    assert max(sizes) < 2 * 50 * 2 and len(sizes) == 40 * 41 // 2
    pairs = mining.pairs_of(groups, "order_id").filter("order_id = 0")
    assert pairs.count() == pairs.distinct().count() == 2000 * 1999 // 2


def test_candidates_have_frequent_subsets_only(spark):
    sets = spark.createDataFrame([(0, ["a", "b"], 5), (1, ["a", "c"], 4), (2, ["b", "c"], 3), (3, ["a", "d"], 9),
                                  (4, ["b", "e"], 9), (5, ["b", "d"], 2)], "set long, items array<string>, support long")
    found = {tuple(r["items"]): (r.set, r.item) for r in it.candidates(sets, 2).collect()}
    assert found == {("a", "b", "c"): (2, "a"), ("a", "b", "d"): (5, "a")}  # the rarest subset and what it lacks


def test_support_of_sets_in_other_rows(spark):
    rng = random.Random(8)
    rows = orders(seed=9)
    items = sorted({i for _, i in rows}) + ["never"]
    sets = [tuple(sorted(rng.sample(items[:15] + ["never"], n))) for n in (1, 2, 2, 3, 3, 4, 5, 6) for _ in range(25)]
    sets = sorted(set(sets))
    baskets = defaultdict(set)
    for order, item in rows:
        baskets[order].add(item)
    want = {s: n for s in sets if (n := sum(set(s) <= b for b in baskets.values()))}
    frame = spark.createDataFrame([(i, list(s)) for i, s in enumerate(sets)], "set long, items array<string>")
    test = spark.createDataFrame(rows, "order_id int, item string")
    found = {sets[r.set]: r.n for r in it.set_support(frame, test, "order_id").collect()}
    assert found == want and max(map(len, want)) >= 4


def test_validation_counts_sets_of_every_size_without_a_job_each(spark):
    split = bk.train_test_split(spark.createDataFrame(orders(n=300), ROWS), split_by="order_id")
    train = split.filter("dataset = 'train'")
    sets = it.frequent_itemsets(bk.basket_rows(train.drop("dataset"), "order_id"), 5, "order_id").filter("size(items) > 1")
    found = it.validate_itemsets(sets, split, 2, basket="order_id").collect()
    baskets = defaultdict(set)
    for r in split.filter("dataset = 'test'").collect():
        baskets[r.order_id].add(r.product_id)
    supports = as_dict(sets)
    want = {s: (n, c, n + c) for s, n in supports.items() if (c := sum(set(s) <= b for b in baskets.values())) >= 2}
    assert {tuple(r["items"]): (r.train_support, r.test_support, r.total_support) for r in found} == want
    assert {r.n_items for r in found} >= {2, 3} and all(r.n_items == len(r["items"]) for r in found)
    none = split.filter("dataset = 'train'")
    assert it.validate_itemsets(sets, none, basket="order_id").isEmpty()


def test_pairs_are_the_validated_pairs(spark):
    rows = spark.createDataFrame([(f"c{o}", i, 1) for o, i in orders(n=200)],
                                 "customer_id string, product_id string, rating int")
    split = bk.train_test_split(rows)
    train = mining.train_patterns(split, 2)
    as_sets = train.select(F.array("item1", "item2").alias("items"), "support")
    one = mining.validate_patterns(train, split, 1)
    two = it.validate_itemsets(as_sets, split, 1).select(F.get("items", F.lit(0)), F.get("items", F.lit(1)), "train_support",
                                                        "test_support", "total_support")
    assert tuples(one) == tuples(two) and len(tuples(one)) > 20
