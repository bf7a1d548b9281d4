"""Enrichment and the views of served patterns."""

import random
from collections import defaultdict

import pytest

from cobasket.operators import enrich, views
from cobasket.schemas import PATTERN
from cobasket.sources import patterns as files
from conftest import tuples
from test_mining import SCHEMA, random_reviews

PRODUCT = "asin string, title string, avg_rating double"


def brute_samples(pairs, rows, limit):
    found = []
    by_product = defaultdict(list)
    for customer, product, rating in rows:
        by_product[product].append((customer, rating))
    for a, b in pairs:
        both = [(c, r1, r2) for c, r1 in by_product[a] for d, r2 in by_product[b] if c == d]
        found += [(a, b, *sample) for sample in sorted(both)[:limit]]
    return sorted(found)


@pytest.mark.parametrize("limit", [1, 3, 10, 1000])
def test_sample_customers(spark, limit):
    rows = random_reviews(seed=11)
    pairs = [("p00", "p01"), ("p01", "p02"), ("p00", "p14"), ("p03", "zzz"), ("p05", "p06")]
    found = enrich.sample_customers(spark.createDataFrame(pairs, "item1 string, item2 string"),
                                    spark.createDataFrame(rows, SCHEMA).repartition(6), limit)
    assert sorted(tuple(r) for r in found.collect()) == brute_samples(pairs, rows, limit)


def test_sample_customers_of_a_hot_customer(spark):
    rows = [("c", "a", i % 2) for i in range(400)] + [("c", "b", 3) for _ in range(300)] + [("d", "a", 1), ("d", "b", 2)]
    found = enrich.sample_customers(spark.createDataFrame([("a", "b")], "item1 string, item2 string"),
                                    spark.createDataFrame(random.Random(0).sample(rows, len(rows)), SCHEMA))
    assert tuples(found) == [("a", "b", "c", 0, 3)] * 10


@pytest.fixture
def patterns(spark):
    ranked = spark.createDataFrame([(1, "a", "b", 4, 0.4), (2, "a", "x", 3, 0.3), (3, "b", "c", 2, 0.25)],
                                   "rank bigint, item1 string, item2 string, support bigint, confidence double")
    products = spark.createDataFrame([("a", "t" * 70, 4.0), ("b", None, 3.256), ("c", "C", None)], PRODUCT)
    samples = spark.createDataFrame(
        [("a", "b", f"c{i}", 5, 1 + i % 2) for i in range(7)] + [("b", "c", "c1", 2, 2)],
        "item1 string, item2 string, customer_id string, rating1 int, rating2 int")
    return enrich.nested_patterns(enrich.with_products(ranked, products), samples)


def test_nested_pattern(patterns):
    rows = {r["rank"]: r.asDict(recursive=True) for r in patterns.collect()}
    assert rows[1]["products"] == {"asin1": "a", "asin2": "b", "title1": "t" * 70, "title2": "Unknown",
                                   "avgRating1": 4.0, "avgRating2": 3.256}
    assert rows[2]["products"]["title2"] == "Unknown" and rows[2]["sample_customers"] == []
    assert rows[3]["sample_customers"] == [{"customer_id": "c1", "rating1": 2.0, "rating2": 2.0}]


def test_json_round_trip(spark, patterns, tmp_path):
    files.write_patterns(patterns, str(tmp_path), "pairs")
    back = files.read_patterns(spark, str(tmp_path))
    assert back.schema.simpleString() == spark.createDataFrame([], PATTERN).schema.simpleString()
    assert tuples(back) == tuples(patterns)
    metadata = files.read_metadata(spark, str(tmp_path)).collect()
    assert [(m.total_patterns, m.algorithm) for m in metadata] == [(3, "pairs")]
    assert len(metadata[0].generated_at) == 19


def test_list_and_report(patterns):
    listed = {r["rank"]: r for r in views.pattern_list(patterns).collect()}
    assert listed[1].title1 == "t" * 40 and listed[1].confidence == "0.4000"
    report = {r["rank"]: r for r in views.top_patterns(patterns, 2).collect()}
    assert set(report) == {1, 2} and report[1].title1 == "t" * 60
    assert (report[1].rating1, report[1].rating2, report[2].rating2) == ("4.00", "3.26", "N/A")
    assert (report[1].n_samples, report[2].n_samples) == (7, 0)


def test_detail_shows_five_samples(patterns):
    rows = views.pattern_detail(patterns, 1).orderBy("position").collect()
    assert [(r.position, r.customer_id, r.rating1, r.rating2) for r in rows] == [
        (i + 1, f"c{i}", "5.0", f"{1 + i % 2}.0") for i in range(5)]
    bare = views.pattern_detail(patterns, 2).collect()
    assert len(bare) == 1 and bare[0].customer_id is None
    assert views.pattern_detail(patterns, 9).count() == 0


def test_overview(patterns):
    assert tuples(views.pattern_overview(patterns, 1)) == [(1, 4, 40.0)]


def test_rating_distribution(patterns):
    rows = {(r["rank"], r["product"], r.rating): r for r in views.rating_distribution(patterns).collect()}
    assert set(rows) == {(1, 1, 5.0), (1, 2, 1.0), (1, 2, 2.0), (3, 1, 2.0), (3, 2, 2.0)}
    assert rows[1, 2, 1.0].n_ratings == 4 and rows[1, 2, 1.0].percent == pytest.approx(400 / 7)
    assert rows[1, 2, 2.0].mean_rating == pytest.approx(10 / 7)


def test_enriched_validated(spark):
    validated = spark.createDataFrame([("a", "b", 9, 5, 14), ("b", "x", 8, 6, 14)],
                                      "item1 string, item2 string, train_support bigint, test_support bigint, "
                                      "total_support bigint")
    products = spark.createDataFrame([("a", "A", 4.0), ("b", None, 3.0)], PRODUCT)
    rows = sorted(enrich.enriched_validated(validated, products).collect(), key=lambda r: r.products)
    assert [(r.products, r.titles, r.ratings, r.confidence) for r in rows] == [
        (["a", "b"], ["A", "Unknown"], [4.0, 3.0], 0.0), (["b", "x"], ["Unknown", "Unknown"], [3.0, 0.0], 0.0)]
    assert enrich.enriched_validated(validated.limit(0), products).count() == 0
