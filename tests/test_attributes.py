"""Pairs of order attributes and their rules, counted in plain loops."""

import math
from collections import Counter
from itertools import combinations

import pytest

from cobasket.plans import catalog
from conftest import tuples


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """400 orders: a pair must be in one; attributes in fewer than four orders, one per cent of them, have pairs too."""
    lines = [(k, 1 + (k * 7 + n * n) % 11) for k in range(400) for n in range(3)] + [(5, 20), (6, 21), (7, 21), (8, 22)]
    parts = [(p, f"Brand#{p % 4}", p) for p in range(1, 12)] + [(20, "Brand#8", 50), (21, "Brand#9", 3), (22, "Brand#9", 50)]
    folder = tmp_path_factory.mktemp("orders")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int").write.parquet(f"{folder}/part.parquet")
    brand = {p: (b, f"Size {s}") for p, b, s in parts}
    baskets = {}
    for order, part in lines:
        baskets.setdefault(order, set()).update(brand[part])
    items, pairs = Counter(), Counter()
    for basket in baskets.values():
        items.update(basket)
        pairs.update(combinations(sorted(basket), 2))
    least = max(1, math.ceil(0.002 * len(baskets)))
    return str(folder), len(baskets), items, {p: n for p, n in pairs.items() if n >= least}


def test_pairs_of_a_fifth_of_a_percent(spark, orders):
    folder, _, _, pairs = orders
    assert min(pairs.values()) == 1
    assert tuples(catalog.queries()["attribute_pairs"](spark, folder)) == sorted((*p, n) for p, n in pairs.items())


def test_rules_of_rare_items(spark, orders):
    folder, n, items, pairs = orders
    want = [(a, b, round(f / items[a], 6), round(f / items[a] / (items[b] / n), 6), round(f / n, 6))
            for p, f in pairs.items() for a, b in (p, p[::-1]) if f / items[a] >= 0.1]
    assert any(items[a] < 0.01 * n for a, *_ in want)
    assert tuples(catalog.queries()["attribute_rules"](spark, folder)) == sorted(want)
