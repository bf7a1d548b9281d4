"""Normalising, cleaning, loading, and the CSV form of the graph."""

import pytest
from pyspark.sql import functions as F

from cobasket.operators import clean, load, normalize
from cobasket.schemas import Graph, RECORD
from cobasket.sources import tables, typed_csv
from conftest import tuples


@pytest.fixture(scope="module")
def records(spark):
    rows = [
        (1, "A", 'say "hi", twice', "Book", 5, ["B", "Z"], [["Books", "Art"], ["Books", ""]], 2, 2, 4.5,
         [("2000-1-1", "C1", 5, 1, 0), ("2000-1-2", "C2", 4, 1, 1), ("2000-1-3", "C1", 3, 0, 0)]),
        (2, "B", None, None, None, [], None, None, None, None, []),
        (3, "A", "later copy", "Book", 6, ["B"], [["Books"]], 9, 9, 1.0, [("2001-1-1", "C3", 1, 0, 0)]),
        (None, "B", "no id", "DVD", 7, None, [], 0, 0, 0.0, []),
        (4, "", "empty key", "DVD", 7, ["A"], [["Art"]], 0, 0, 0.0, []),
        (5, None, "no key", "DVD", 7, ["A"], [["Art"]], 0, 0, 0.0, []),
    ]
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture(scope="module")
def graph(records):
    return normalize.normalize(records)


def test_edges_repeat_with_the_input(graph):
    assert tuples(graph.similar.filter("src = 'A'")) == [("A", "B"), ("A", "B"), ("A", "Z")]
    per_name = tuples(graph.belongs_to.filter("product_id = 'A'").groupBy("category").count())
    assert per_name == [("", 1), ("Art", 1), ("Books", 3)]
    assert graph.reviewed.filter("customer_id = 'C1'").count() == 2


def test_node_lists_are_distinct(graph):
    assert tuples(graph.customers) == [("C1",), ("C2",), ("C3",)]
    assert tuples(graph.categories) == [("",), ("Art",), ("Books",)]


def test_first_record_of_a_key_wins(graph):
    kept = tuples(clean.clean_products(graph.products).select("asin", "title"))
    assert kept == [("A", 'say "hi", twice'), ("B", None)]


def test_clean_edges_have_both_ends(graph):
    cleaned = clean.clean(graph)
    assert tuples(cleaned.similar) == [("A", "B"), ("A", "B")]
    assert tuples(cleaned.categories) == [("Art",), ("Books",)]
    assert tuples(cleaned.belongs_to.groupBy("category").count()) == [("Art", 1), ("Books", 3)]


def test_cleaning_twice_changes_nothing(graph):
    once = clean.clean(graph)
    again = clean.clean(Graph(once.products.withColumn("id", F.lit(1)), once.customers, once.categories,
                              once.belongs_to, once.similar, once.reviewed))
    compared = load.compare_snapshots(once, again).collect()
    assert len(compared) == 6 and all(row.same_count and row.same_rows for row in compared)


def test_kept_and_rejected_rows_make_up_the_input(spark, graph):
    stray = spark.createDataFrame([("C9", "A", 1, "d", 0, 0), ("C1", "Q", 1, "d", 0, 0), (None, "A", 1, "d", 0, 0)],
                                  graph.reviewed.schema)
    dirty = Graph(graph.products, graph.customers, graph.categories, graph.belongs_to, graph.similar,
                  graph.reviewed.unionByName(stray))
    cleaned = clean.clean(dirty)
    report = clean.reject_report(dirty, cleaned)
    rejected = {row.table_name: row.n for row in report.groupBy("table_name").agg(F.sum("n_rows").alias("n")).collect()}
    for name, table in dirty.tables().items():
        assert cleaned.tables()[name].count() + rejected.get(name, 0) == table.count(), name
    assert ("reviewed", "unknown customer_id", 2) in tuples(report)
    assert ("products", "duplicate key", 2) in tuples(report)


def test_snapshots_differ_by_count_or_content(graph):
    cleaned = clean.clean(graph)
    swapped = Graph(cleaned.products, cleaned.customers, cleaned.categories, cleaned.belongs_to,
                    cleaned.similar.select(F.col("dst").alias("src"), F.col("src").alias("dst")),
                    cleaned.reviewed.limit(1))
    found = {row.label: (row.same_count, row.same_rows) for row in load.compare_snapshots(cleaned, swapped).collect()}
    assert found["SIMILAR"] == (True, False) and found["REVIEWED"] == (False, False)
    assert found["Product"] == (True, True)


def test_defaults_or_nulls(spark):
    rows = spark.createDataFrame([("A", "", "x", None), ("B", "7", "4.5", "3"), ("", "1", "1", "1")],
                                 "asin string, salesrank string, avg_rating string, total_reviews string")
    assert tuples(load.load_products(rows)) == [("A", -1, 0.0, 0), ("B", 7, 4.5, 3)]
    assert tuples(load.load_products(rows, fill_defaults=False)) == [("A", None, None, None), ("B", 7, 4.5, 3)]


def test_resolving_repeats_an_edge_per_matching_node(spark):
    products = spark.createDataFrame([("A",), ("A",), ("B",)], "asin string")
    edges = spark.createDataFrame([("A", "B"), ("B", "Z")], "src string, dst string")
    assert tuples(load.resolve_similar(edges, products)) == [("A", "B"), ("A", "B")]


def test_merge_adds_new_names_once(spark):
    old = spark.createDataFrame([("x",)], "name string")
    new = spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "name string")
    assert tuples(load.merge_categories(old, new)) == [("x",), ("y",)]


def test_counts(graph):
    assert [tuple(r) for r in load.counts_by_label(graph).collect()] == [
        ("Category", 3), ("Customer", 3), ("Product", 6)]
    assert dict(tuples(load.verify_counts(graph)))["REVIEWED"] == 4


def test_csv_round_trip(spark, graph, tmp_path):
    cleaned = clean.clean(graph)
    typed_csv.write_graph_csv(cleaned, str(tmp_path))
    header = next(p for p in (tmp_path / "products").glob("*.csv")).read_text().splitlines()[0]
    assert header == "asin:ID(Product),title,group,salesrank:int,avg_rating:float,total_reviews:int"
    back = typed_csv.read_graph_csv(spark, str(tmp_path))
    assert all(row.same_rows for row in load.compare_snapshots(cleaned, back).collect())
    assert dict(back.products.dtypes)["avg_rating"] == "double"


def test_csv_value_of_the_wrong_type_is_null(spark, tmp_path):
    (tmp_path / "p.csv").write_text("asin:ID(Product),title,group,salesrank:int,avg_rating:float,total_reviews:int\n"
                                    'A,"a ""quoted"" title",Book,many,4.5,\n')
    assert tuples(typed_csv.read_typed_csv(spark, str(tmp_path), "products")) == [
        ("A", 'a "quoted" title', "Book", None, 4.5, None)]


def test_stored_graph_is_replaced(spark, graph, tmp_path):
    cleaned = clean.clean(graph)
    for _ in range(2):
        tables.write_graph(cleaned, str(tmp_path))
    assert all(row.same_rows for row in load.compare_snapshots(cleaned, tables.read_graph(spark, str(tmp_path)))
               .collect())


def test_relationship_scan_carries_both_ends(graph):
    cleaned = clean.clean(graph)
    rows = tables.scan_relationship(cleaned, "reviewed").filter("source_customer_id = 'C2'").collect()
    assert [(r.target_asin, r.target_title, r.rel_rating) for r in rows] == [("A", 'say "hi", twice', 4)]
    with pytest.raises(ValueError):
        tables.scan_relationship(cleaned, "products")


def test_review_scan_needs_both_keys(spark):
    rows = spark.createDataFrame([("C", "A", 1), (None, "A", 1), ("C", None, 1)],
                                 "customer_id string, product_id string, rating int")
    assert tuples(tables.scan_reviews(rows)) == [("C", "A", 1)]
    assert tuples(tables.scan_reviews(rows, with_dataset=True)) == [("C", "A", 1, None)]
