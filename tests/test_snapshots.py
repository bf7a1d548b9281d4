"""Replacing a stored graph, and finding the rows in which copies differ."""

import random

import pytest
from pyspark.sql import functions as F

from cobasket.operators import load
from cobasket.schemas import Graph
from cobasket.sources import tables
from conftest import tuples


def graph_of(spark, n, title="t"):
    products = spark.range(n).select(F.concat(F.lit("P"), "id").alias("asin"), F.lit(title).alias("title"),
                                     F.lit("Book").alias("product_group"), F.lit(1).alias("salesrank"),
                                     F.lit(4.0).alias("avg_rating"), F.lit(2).alias("total_reviews"))
    customers = spark.range(5).select(F.concat(F.lit("C"), "id").alias("customer_id"))
    categories = spark.range(2).select(F.concat(F.lit("K"), "id").alias("name"))
    belongs = products.select(F.col("asin").alias("product_id"), F.lit("K0").alias("category"))
    similar = products.select(F.col("asin").alias("src"), F.lit("P0").alias("dst"))
    reviewed = products.select(F.lit("C1").alias("customer_id"), F.col("asin").alias("product_id"), F.lit(3).alias("rating"),
                               F.lit("2001-1-1").alias("date"), F.lit(1).alias("votes"), F.lit(0).alias("helpful"))
    return Graph(products, customers, categories, belongs, similar, reviewed)


def test_readers_get_the_old_graph_until_the_new_one_is_whole(spark, tmp_path):
    root = str(tmp_path / "graph")
    first = tables.write_graph(graph_of(spark, 30, "old"), root)
    before = tables.read_graph(spark, root)
    broken = graph_of(spark, 40, "new")
    broken = Graph(**{**broken.tables(), "reviewed": broken.reviewed.withColumn(
        "rating", F.when(F.col("product_id") == "P33", F.raise_error(F.lit("disk full")).cast("int")).otherwise(1))})
    with pytest.raises(Exception, match="disk full"):
        tables.write_graph(broken, root)
    assert tables.current_snapshot(spark, root) == first
    assert {r.title for r in tables.read_graph(spark, root).products.collect()} == {"old"}
    second = tables.write_graph(graph_of(spark, 40, "new"), root)
    assert tables.current_snapshot(spark, root) == second > first
    assert {r.title for r in tables.read_graph(spark, root).products.collect()} == {"new"}
    # What was opened before, or by name, stays the old graph.
    assert {r.title for r in before.products.collect()} == {"old"} and before.similar.count() == 30
    assert {r.title for r in tables.read_graph(spark, root, first).products.collect()} == {"old"}
    assert tables.remove_snapshots(spark, root) == 2 and tables.snapshots(spark, root) == [second]
    assert tables.read_graph(spark, root).reviewed.count() == 40


def test_a_wrong_count_is_not_published(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "graph")
    first = tables.write_graph(graph_of(spark, 3), root)
    honest = tables.Observation

    class Wrong(honest):
        @property
        def get(self):
            return {"n": 99}

    monkeypatch.setattr(tables, "Observation", Wrong)
    with pytest.raises(RuntimeError, match="99 rows written"):
        tables.write_graph(graph_of(spark, 3), root)
    assert tables.current_snapshot(spark, root) == first


def brute_differences(left, right, keys):
    def by_key(df):
        out = {}
        for row in df.collect():
            out.setdefault(tuple(row[k] for k in keys), []).append(tuple(row))
        return {k: sorted(v, key=str) for k, v in out.items()}

    a, b = by_key(left), by_key(right)
    return sorted(((*k, "added" if k not in a else "removed" if k not in b else "changed", len(a.get(k, [])), len(b.get(k, [])))
                   for k in a.keys() | b.keys() if a.get(k) != b.get(k)), key=str)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_differences(spark, buckets):
    """Repeated rows, nulls in keys and values, an empty text for a null, rows only here or there."""
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, *range(12)]), rng.choice([None, "", "x"])) for _ in range(300)]
    other = [r for r in rows if rng.random() < 0.95] + [("e", 1, "new"), ("a", None, "")]
    other = [(a, b, "" if c is None and b == 3 else c) for a, b, c in other]
    one, two = (spark.createDataFrame(x, "k string, j int, v string") for x in (rows, other))
    found = sorted((tuple(r) for r in load.table_differences(one, two, ["k", "j"], buckets).collect()), key=str)
    assert found == brute_differences(one, two, ["k", "j"])
    assert {r[2] for r in found} >= {"added", "changed"}
    assert load.table_differences(one, one, ["k", "j"], buckets).isEmpty()


def test_only_rows_of_unequal_buckets_meet(spark):
    left = spark.range(20_000).select(F.col("id").alias("asin"), F.lit("t").alias("title"))
    right = left.withColumn("title", F.when(F.col("asin").isin(5, 77), "u").otherwise(F.col("title")))
    found = load.unequal_buckets(left, right, ["asin"], 4096)
    assert 1 <= found.count() <= 2
    assert load.rows_in_buckets(left, ["asin"], found, 4096).count() < 40
    assert tuples(load.table_differences(left, right, ["asin"])) == [(5, "changed", 1, 1), (77, "changed", 1, 1)]


def test_differences_of_graphs(spark):
    old, new = graph_of(spark, 4, "old"), graph_of(spark, 5, "new")
    found = load.snapshot_differences(old, new).collect()
    assert {(r.label, r.key, r.change) for r in found} == {
        *(("Product", f"P{i}", "changed") for i in range(4)), ("Product", "P4", "added"), ("BELONGS_TO", "P4|K0", "added"),
        ("SIMILAR", "P4|P0", "added"), ("REVIEWED", "C1|P4", "added")}


def test_buckets_give_the_rows_of_plain_joins(spark, tmp_path):
    graph = graph_of(spark, 50)
    prefix = tables.write_buckets(graph, str(tmp_path / "buckets"), 4)
    for table, ends in tables.ENDPOINTS.items():
        assert tuples(tables.scan_both_ends(spark, prefix, table).select(
            sorted(tables.scan_relationship(graph, table).columns))) == tuples(tables.scan_relationship(graph, table).select(
                sorted(tables.scan_relationship(graph, table).columns)))
        for column, nodes, key in ends:
            found = tables.scan_end(spark, prefix, table, column)
            node = graph.tables()[nodes].select(F.col(key).alias("node_key"))
            want = graph.tables()[table].join(node, F.col(column) == F.col("node_key"))
            assert tuples(found.select(f"rel_{column}", f"node_{key}")) == tuples(want.select(column, "node_key")) != []
