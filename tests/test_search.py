"""Product searches, their listing, and the summaries over edges."""

import pytest

from cobasket.operators import search, summary
from conftest import tuples

PRODUCT = ("asin string, title string, product_group string, salesrank bigint, avg_rating double, "
           "total_reviews bigint")


@pytest.fixture(scope="module")
def products(spark):
    return spark.createDataFrame([
        ("A", "a", "Book", 10, 4.5, 200), ("B", "b", "Book", -1, 4.5, 300), ("C", "c", "Music", 0, 5.0, 0),
        ("D", None, "Book", 5, 4.9, 500), ("E", "e", None, 5, 4.8, 400), ("F", "f", "DVD", 7, None, 100),
        ("G", "g", "DVD", 60000, 4.0, None), ("H", "h", "Music", None, 4.2, 60), ("I", "", "Book", 0, 0.0, 1),
    ], PRODUCT)


def keys(df):
    return [row.asin for row in df.collect()]


def test_form_leaves_out_what_is_missing(products):
    assert keys(search.search_form(products)) == ["B", "A", "H", "I"]
    assert keys(search.search_form(products, group="All")) == ["B", "A", "H", "I"]


@pytest.mark.parametrize("bounds, found", [
    ({"group": "Music"}, ["H"]),
    ({"min_reviews": 0}, ["C", "B", "A", "H", "I"]),
    ({"max_reviews": 250}, ["C", "A", "H", "I"]),
    ({"min_rating": 0.0, "max_rating": 4.2}, ["H", "I"]),
    ({"max_salesrank": 10}, ["B", "A", "I"]),
    ({"min_salesrank": 0, "max_salesrank": 10}, ["A", "I"]),
    ({"limit": 1}, ["B"]),
])
def test_form_bounds(products, bounds, found):
    assert keys(search.search_form(products, **bounds)) == found


def test_open_search_puts_missing_ratings_first(products):
    assert keys(search.search_conditions(products)) == ["F", "C", "D", "E", "B", "A", "H", "G", "I"]


@pytest.mark.parametrize("conditions, found", [
    ({"max_salesrank": 10}, ["F", "D", "E", "A"]),
    ({"min_rating": 4.5, "max_rating": 4.8}, ["E", "B", "A"]),
    ({"group": "Book", "min_reviews": 250}, ["D", "B"]),
])
def test_conditions(products, conditions, found):
    assert keys(search.search_conditions(products, conditions)) == found


def test_presets(products):
    assert keys(search.preset(products, "high_rated")) == ["D", "E", "B", "A"]
    assert keys(search.preset(products, "books")) == ["D", "A"]
    assert keys(search.preset(products, "music")) == ["H"]
    assert keys(search.preset(products, "music", group="Book", min_reviews=1)) == ["D", "B", "A"]


def test_filter_and_top(products):
    assert sorted(keys(search.filter_high_rated(products))) == ["A", "B", "D", "E"]
    assert keys(search.top_products(products, 3)) == ["D", "E", "B"]


def test_listing_shows_text_for_missing_values(products):
    rows = {r.asin: r for r in search.listing(products, 9).collect()}
    assert [r.asin for r in sorted(rows.values(), key=lambda r: r.position)][:2] == ["F", "C"]
    assert (rows["D"].title, rows["E"].product_group, rows["I"].title) == ("Unknown", "Unknown", "Unknown")
    assert (rows["F"].rating, rows["I"].rating, rows["A"].rating) == ("N/A", "N/A", "4.5")
    assert (rows["I"].salesrank, rows["H"].salesrank, rows["B"].salesrank) == ("N/A", "N/A", "-1")
    assert rows["G"].reviews == 0


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [("c1", "A", 5), ("c1", "B", 4), ("c1", "B", 2), ("c2", "A", 4), ("c2", "B", 5), ("c3", "A", 4),
            ("c3", "B", 1), ("c3", "H", 5), ("c4", "H", 3)]
    return spark.createDataFrame(rows, "customer_id string, product_id string, rating int")


def test_active_customers_count_once_per_product(reviews):
    assert [tuple(r) for r in search.active_customer_products(reviews, 3).collect()] == [("A", 2), ("B", 2), ("H", 1)]


def test_categories_count_edges(spark, products):
    edges = spark.createDataFrame([("A", "x"), ("A", "x"), ("F", "x"), ("C", "y"), ("F", "z"), ("Q", "z")],
                                  "product_id string, category string")
    assert tuples(summary.category_analysis(edges, products)) == [("x", 3, 4.5), ("y", 1, 5.0), ("z", 1, None)]
    assert [tuple(r) for r in summary.top_categories(edges, 2).collect()] == [("x", 3), ("z", 2)]


def test_reviewers_count_reviews(reviews):
    assert [tuple(r) for r in summary.top_reviewers(reviews).collect()] == [("c1", 2), ("c2", 2), ("c3", 2)]


def test_similarity_network_asks_for_both_ends(spark, products):
    edges = spark.createDataFrame([("A", "B"), ("A", "B"), ("B", "F"), ("D", "A")], "src string, dst string")
    assert [tuple(r) for r in summary.similarity_network(edges, products).collect()] == [
        ("A", "a", "B", "b"), ("A", "a", "B", "b"), ("D", None, "A", "a")]


def test_similar_pairs_count_distinct_customers(spark, products, reviews):
    edges = spark.createDataFrame([("A", "B"), ("A", "B"), ("B", "A"), ("A", "H"), ("H", "H")],
                                  "src string, dst string")
    found = summary.similar_pair_support(edges, products, reviews, min_support=2)
    assert [(r.asin1, r.asin2, r.support) for r in found.collect()] == [("A", "B", 3), ("B", "A", 3), ("H", "H", 2)]
    assert [(r.reviews1, r.title2) for r in found.collect()][:1] == [(200, "b")]
