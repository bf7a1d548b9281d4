"""What itemset counting stores: no more rows than the baskets have, however many sets are in them."""

from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from cobasket.operators import baskets as bk, itemsets as it
from test_itemsets import as_dict, brute_sets


@pytest.fixture
def written(monkeypatch):
    """Rows of each table that itemset counting stores."""
    rows, keep = Counter(), it.stored

    def stored(df, name):
        table = keep(df, name)
        rows[name] += table.count()
        return table

    monkeypatch.setattr(it, "stored", stored)
    return rows


def orders(n, first=0):
    """Orders of eight of twelve items: 56 triples each."""
    return [(first + o, f"i{(o * 5 + k * (1 + o % 2)) % 12:02}") for o in range(n) for k in range(12)
            if (o + k) % 3 and (o * 5 + k) % 13]


def test_sets_of_small_baskets_are_not_stored_basket_by_basket(spark, written):
    rows = sorted(set(orders(200)))
    frame = spark.createDataFrame(rows, "order_id int, product_id string")
    found = it.frequent_itemsets(bk.basket_rows(frame, "order_id"), 5, "order_id", max_size=3)
    assert as_dict(found) == brute_sets(rows, 5, 3)
    assert "occurrences" not in written and max(written.values()) <= len(rows)


def test_sets_are_looked_up_in_small_baskets_without_storing_them(spark, written):
    rows = sorted(set(orders(200)))
    sets = [list(s) for n in (1, 2, 3, 4) for s in combinations(sorted({i for _, i in rows}), n)]
    frame = spark.createDataFrame([(s, 1) for s in sets], "items array<string>, support long")
    split = spark.createDataFrame([(o, i, "test") for o, i in rows], "order_id int, product_id string, dataset string")
    found = {tuple(r["items"]): r.test_support for r in it.validate_itemsets(frame, split, basket="order_id").collect()}
    assert found == brute_sets(rows, 1, 4)
    assert "occurrences" not in written and max(written.values()) <= max(len(rows), len(sets))


@pytest.mark.parametrize("block", [1, 4, 64])
def test_support_in_small_and_large_baskets_together(spark, block):
    """Sets in any order, one twice, one with an item twice, in baskets on both sides of the block's size."""
    rows = sorted({(o, f"i{(o * 3 + k) % 9}") for o in range(60) for k in range(1 + o % 7)}) + [(99, None)]
    sets = [["i1"], ["i2", "i1"], ["i1", "i2"], ["i3", "i1", "i2"], ["i4", "i4", "i5"], ["i5", "i6", "i7", "i8"], ["no", "i1"], []]
    baskets = {o: {i for p, i in rows if p == o} for o, _ in rows}
    want = {at: n for at, s in enumerate(sets) if s and (n := sum(set(s) <= b for b in baskets.values()))}
    frame = spark.createDataFrame(list(enumerate(sets)), "set long, items array<string>")
    found = it.set_support(frame, spark.createDataFrame(rows, "order_id int, item string"), "order_id", block)
    assert {r.set: r.n for r in found.collect()} == want and len(want) == 6


def test_small_baskets_and_a_large_one(spark):
    rows = sorted(set(orders(60))) + [(1000, f"i{i:02}") for i in range(12)] + [(1000, f"x{i}") for i in range(30)]
    frame = spark.createDataFrame(rows, "order_id int, product_id string")
    found = it.frequent_itemsets(bk.basket_rows(frame, "order_id"), 4, "order_id", block=10)
    assert as_dict(found) == brute_sets(rows, 4)
    assert found.agg(F.max(F.size("items"))).first()[0] >= 4
