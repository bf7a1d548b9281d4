"""The registered queries: every operator applied to the order database's tables.

Thresholds are set for these tables, whose products have mean ratings around 3 and some tens of reviews.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cobasket.operators import baskets as bk, clean as cl, enrich as en, itemsets as it, load as ld, mining as mi, \
    search as se, summary as su, views as vw
from cobasket.plans import jobs, staging
from cobasket.plans.staging import MAX_ITEMS, SAMPLED_SHARE, SETS_SHARE
from cobasket.schemas import Graph
from cobasket.session import scratch_path
from cobasket.sources import patterns as pt, records as rc, tables as tb

Query = Callable[[SparkSession, str], DataFrame]

TEST_MIN = 1  # held-out baskets that a pair must be in
TOP = 20  # patterns shown
SAMPLE_MAX = 500  # baskets in the sample

_queries: dict[str, Query] = {}


def query(f: Query) -> Query:
    _queries[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    return dict(_queries)


def rounded(column: str | Column, name: str | None = None) -> Column:
    return F.round(column, 6).alias(name or column)


def joined(column: str, name: str | None = None) -> Column:
    return F.array_join(F.transform(column, lambda x: x.cast("string")), ",").alias(name or column)


# ---- raw text -> records

@query
def parse_records(spark, sf):
    """How many records each part of the key space has: the split alone."""
    records = staging.parsed(spark, sf)
    return records.groupBy("asin").agg(F.count("*").alias("n_records"), F.min("id").alias("first_id"),
                                       F.max("id").alias("last_id"))


@query
def parse_products(spark, sf):
    return staging.parsed(spark, sf).select("id", "asin", "title", "product_group", "salesrank", "total_reviews",
                                            "downloaded_reviews", "avg_rating")


@query
def parse_similar(spark, sf):
    return staging.parsed(spark, sf).select("id", "asin", joined("similar"))


@query
def parse_categories(spark, sf):
    paths = F.array_join(F.transform("categories", lambda path: F.array_join(path, "/")), ";")
    return staging.parsed(spark, sf).select("id", "asin", paths.alias("categories"))


@query
def parse_reviews(spark, sf):
    rows = staging.parsed(spark, sf).select("id", "asin", F.posexplode_outer("reviews").alias("position", "r"))
    rows = rows.filter(F.col("r").isNotNull())
    return rows.select("id", "asin", "position", "r.date", "r.customer", "r.rating", "r.votes", "r.helpful",
                       F.try_to_date("r.date", "yyyy-M-d").cast("string").alias("day"))


@query
def parse_nested(spark, sf):
    def size(column: str, name: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.size(column)).alias(name)

    return staging.parsed(spark, sf).select(
        "id", "asin", "title", size("similar", "n_similar"), size("categories", "n_paths"),
        size("reviews", "n_reviews"),
        F.array_join(F.transform("reviews", lambda r: F.concat_ws(":", r["customer"], r["rating"].cast("string"))),
                     ";").alias("ratings"))


# Text with junk, undecodable bytes, quotes, and numbers that can't be read.

@query
def parse_rejects(spark, sf):
    """What of the text was not taken over, line by line, without the file's name."""
    return rc.rejects_of(staging.parsed_dirty(spark, sf)).drop("file")


@query
def parse_counts(spark, sf):
    """Blocks and review lines that were taken over, and what was not, by reason: all of the text."""
    return rc.parse_counts(staging.parsed_dirty(spark, sf))


@query
def parse_dirty(spark, sf):
    """Records of the dirty text, which keep what could be read."""
    paths = F.array_join(F.transform("categories", lambda path: F.array_join(path, "/")), ";")
    return rc.records_of(staging.parsed_dirty(spark, sf)).select(
        "id", "asin", "title", "total_reviews", "downloaded_reviews", "avg_rating", paths.alias("categories"),
        F.size("reviews").alias("n_reviews"))


@query
def dirty_products_csv(spark, sf):
    """Products of the dirty text, quotes and all, after typed CSV and back."""
    return staging.dirty_csv(spark, sf).products


@query
def dirty_categories_csv(spark, sf):
    return staging.dirty_csv(spark, sf).belongs_to


# ---- records -> nodes and edges

@query
def norm_products(spark, sf):
    return staging.normalized(spark, sf).products


@query
def norm_similar(spark, sf):
    return staging.normalized(spark, sf).similar


@query
def norm_belongs_to(spark, sf):
    return staging.normalized(spark, sf).belongs_to


@query
def norm_reviews(spark, sf):
    return staging.normalized(spark, sf).reviewed


@query
def norm_customers(spark, sf):
    return staging.normalized(spark, sf).customers.orderBy("customer_id")


@query
def norm_categories(spark, sf):
    return staging.normalized(spark, sf).categories.orderBy("name")


# ---- cleaning

@query
def clean_products(spark, sf):
    return cl.clean_products(staging.normalized(spark, sf).products)


def _doubtful(nodes: DataFrame, key: str) -> DataFrame:
    """Nodes twice, and once more each with an empty key and with none."""
    empty = [nodes.select(F.lit(value).cast("string").alias(key)) for value in ("", None)]
    return nodes.unionByName(nodes).unionByName(empty[0]).unionByName(empty[1])


@query
def clean_customers(spark, sf):
    return cl.clean_keys(_doubtful(staging.normalized(spark, sf).customers, "customer_id"), "customer_id")


@query
def clean_categories(spark, sf):
    return cl.clean_keys(_doubtful(staging.normalized(spark, sf).categories, "name"), "name")


@query
def clean_similar(spark, sf):
    return cl.clean_similar(staging.normalized(spark, sf).similar, staging.clean_nodes(spark, sf).products)


@query
def clean_belongs_to(spark, sf):
    """All edges, and for each one more of a product that there isn't, or without one."""
    nodes = staging.clean_nodes(spark, sf)
    edges = staging.normalized(spark, sf).belongs_to
    strays = edges.select(F.when(F.length("category") % 2 == 1, F.concat(F.lit("X"), "product_id")).alias("product_id"),
                          "category")
    return cl.clean_belongs_to(edges.unionByName(strays), nodes.products, nodes.categories)


@query
def clean_reviews(spark, sf):
    nodes = staging.clean_nodes(spark, sf)
    return cl.clean_reviewed(_with_strays(spark, sf).reviewed, nodes.customers, nodes.products)


def _with_strays(spark: SparkSession, sf: str) -> Graph:
    """The normalised graph plus one review in five of a product, and one in seven by a customer, that is unknown."""
    graph = staging.normalized(spark, sf)
    strays = graph.reviewed.select(
        F.when(F.col("votes") % 7 == 0, F.concat(F.lit("X"), "customer_id")).otherwise(F.col("customer_id"))
        .alias("customer_id"),
        F.when(F.col("votes") % 5 == 0, F.concat(F.lit("X"), "product_id")).otherwise(F.col("product_id"))
        .alias("product_id"), "rating", "date", "votes", "helpful")
    return Graph(graph.products, graph.customers, graph.categories, graph.belongs_to, graph.similar, strays)


@query
def clean_rejects(spark, sf):
    return cl.reject_report(_with_strays(spark, sf), staging.clean_nodes(spark, sf))


# ---- typed load and counts

@query
def load_products(spark, sf):
    """A label scan with its count: all stored products."""
    return tb.scan_label(staging.clean_nodes(spark, sf), "products")


@query
def load_products_defaults(spark, sf):
    return ld.load_products(staging.csv(spark, sf).products)


@query
def load_products_nulls(spark, sf):
    return ld.load_products(staging.csv(spark, sf).products, fill_defaults=False)


@query
def load_customers(spark, sf):
    """Stored customers, some of them twice and some without a key: the load keeps repeated rows and no keyless one."""
    nodes = staging.csv(spark, sf).customers
    again = nodes.select(F.when(F.col("customer_id").endswith("7"), F.col("customer_id")).alias("customer_id"))
    return ld.load_customers(nodes.unionByName(again))


@query
def merge_categories(spark, sf):
    """Categories of the order database merged with those of the text: brands and sizes are in both."""
    existing = staging.categories(spark, sf)
    new = staging.normalized(spark, sf).belongs_to.select(F.col("category").alias("name"))
    return ld.merge_categories(existing, new)


@query
def resolve_belongs_to(spark, sf):
    """All edges, and for each one more of a product, or to a category, that there isn't."""
    edges = staging.belongs_to(spark, sf)
    odd = F.col("product_id") % 2 == 1
    strays = edges.select(F.when(odd, -F.col("product_id") - 1).otherwise(F.col("product_id")).alias("product_id"),
                          F.when(odd, F.col("category")).otherwise(F.concat(F.lit("no "), "category")).alias("category"))
    return ld.resolve_belongs_to(edges.unionByName(strays), staging.products(spark, sf), staging.categories(spark, sf))


@query
def resolve_similar(spark, sf):
    """All links, and for each one more to a product that there isn't."""
    links = staging.similar(spark, sf)
    strays = links.select("src", (-F.col("dst") - 1).alias("dst"))
    return ld.resolve_similar(links.unionByName(strays), staging.products(spark, sf))


@query
def resolve_reviews(spark, sf):
    """All reviews, and for each one more by a customer, or of a product, that there isn't."""
    reviews = staging.reviewed(spark, sf)
    odd = F.col("votes") % 2 == 1
    strays = reviews.withColumns({
        "customer_id": F.when(odd, -F.col("customer_id") - 1).otherwise(F.col("customer_id")),
        "product_id": F.when(odd, F.col("product_id")).otherwise(-F.col("product_id") - 1)})
    return ld.resolve_reviewed(reviews.unionByName(strays), staging.customers(spark, sf), staging.products(spark, sf))


@query
def counts_by_label(spark, sf):
    return ld.counts_by_label(staging.graph(spark, sf))


@query
def verify_counts(spark, sf):
    return ld.verify_counts(staging.graph(spark, sf))


@query
def compare_snapshots(spark, sf):
    """The graph before and after cleaning. Products lose their record id first, as only keys are compared."""
    before = staging.normalized(spark, sf)
    before = Graph(before.products.drop("id"), before.customers, before.categories, before.belongs_to,
                   before.similar, before.reviewed)
    return ld.compare_snapshots(before, staging.cleaned(spark, sf))


@query
def compare_changed_copy(spark, sf):
    """A graph and a copy with as many rows: one title changed, similar links turned around, an empty text for a null."""
    graph = staging.graph(spark, sf)
    title = F.when(F.col("asin") == 1, F.lit("changed")).otherwise(F.col("title"))
    dates = F.when(F.col("votes") != 1, F.col("date"))
    emptied = graph.reviewed.withColumn("date", dates)
    copy = Graph(graph.products.withColumn("title", title), graph.customers, graph.categories, graph.belongs_to,
                 graph.similar.select(F.col("dst").alias("src"), F.col("src").alias("dst")),
                 emptied.withColumn("date", F.coalesce("date", F.lit(""))))
    graph = Graph(graph.products, graph.customers, graph.categories, graph.belongs_to, graph.similar, emptied)
    return ld.compare_snapshots(graph, copy)


def _later_graph(spark: SparkSession, sf: str) -> Graph:
    """The graph after changes: some titles, some products gone, a category more, some dates, one review in fifty twice."""
    graph = staging.graph(spark, sf)
    key = F.col("asin")
    products = graph.products.filter(key % 19 != 0).withColumn(
        "title", F.when(key % 23 == 0, F.lit("changed")).otherwise(F.col("title")))
    categories = graph.categories.unionByName(spark.range(1).select(F.concat(F.lit("New "), "id").alias("name")))
    dated = graph.reviewed.withColumn("date", F.when((F.col("customer_id") % 40 == 0) & (F.col("votes") == 1), F.lit("2000-1-1"))
                                      .otherwise(F.col("date")))
    again = graph.reviewed.filter("customer_id % 50 = 1 AND votes = 2")
    return Graph(products, graph.customers, categories, graph.belongs_to, graph.similar.filter("src % 3 <> 0"),
                 dated.unionByName(again))


@query
def snapshot_differences(spark, sf):
    """The rows that differ between the graph and a later one: added, removed and changed."""
    return ld.snapshot_differences(staging.graph(spark, sf), _later_graph(spark, sf))


@query
def replace_graph(spark, sf):
    """The stored graph replaced by a later one: rows by label of the snapshot before and of the one readers get now."""
    root = scratch_path(spark, "graph")
    before = tb.write_graph(staging.graph(spark, sf), root)
    tb.write_graph(_later_graph(spark, sf), root)
    parts = [ld.verify_counts(tb.read_graph(spark, root, name)).withColumn("snapshot", F.lit(label))
             for label, name in (("before", before), ("current", None))]
    return parts[0].unionByName(parts[1])


# ---- scans

@query
def scan_reviews_by_product(spark, sf):
    """Reviews with their product's properties, joined bucket by bucket."""
    return tb.scan_end(spark, staging.bucketed(spark, sf), "reviewed", "product_id").drop("rel_order_id")


@query
def scan_similar_buckets(spark, sf):
    """The rows of ``load_relationships`` from buckets."""
    return tb.scan_both_ends(spark, staging.bucketed(spark, sf), "similar")


@query
def load_relationships(spark, sf):
    return tb.scan_relationship(staging.graph(spark, sf), "similar")


@query
def load_reviews(spark, sf):
    return staging.reviews(spark, sf)


@query
def load_reviews_dataset(spark, sf):
    return tb.scan_reviews(_half_split(spark, sf), with_dataset=True)


def _half_split(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews of which some carry a dataset name already."""
    name = F.when(F.col("votes") == 1, F.lit("train")).when(F.col("votes") == 2, F.lit("test"))
    return staging.reviewed(spark, sf).withColumn("dataset", name)


@query
def read_typed_csv(spark, sf):
    return staging.csv(spark, sf).reviewed


@query
def write_graph_csv(spark, sf):
    """All six tables after a round trip through typed CSV, reduced to counts and sums."""
    return ld.verify_counts(staging.csv(spark, sf)).unionByName(
        staging.csv(spark, sf).reviewed.agg(F.sum("rating").alias("n_rows")).select(F.lit("RATING").alias("label"),
                                                                                    "n_rows"))


# ---- product searches

@query
def search_form_default(spark, sf):
    return se.search_form(staging.products(spark, sf))


@query
def search_form_bounds(spark, sf):
    return se.search_form(staging.products(spark, sf), group="ECONOMY", min_rating=2.5, max_rating=3.5, min_reviews=20,
                          max_reviews=45, min_salesrank=-1, max_salesrank=60000, limit=50)


@query
def search_conditions(spark, sf):
    return se.search_conditions(staging.products(spark, sf), {
        "min_rating": 2.8, "max_rating": 3.4, "min_reviews": 25, "group": "STANDARD", "max_salesrank": 70000}, 25)


@query
def search_all(spark, sf):
    return se.search_conditions(staging.products(spark, sf), k=100)


@query
def preset_high_rated(spark, sf):
    return se.preset(staging.products(spark, sf), "high_rated", min_rating=3.0, min_reviews=30)


@query
def preset_books(spark, sf):
    return se.preset(staging.products(spark, sf), "books", group="ECONOMY", min_rating=3.0)


@query
def preset_music(spark, sf):
    return se.preset(staging.products(spark, sf), "music", group="PROMO", min_rating=3.0, min_reviews=30)


@query
def filter_high_rated(spark, sf):
    return se.filter_high_rated(staging.products(spark, sf), 3.0, 30)


@query
def top_products(spark, sf):
    return se.top_products(staging.products(spark, sf))


@query
def search_listing(spark, sf):
    return se.listing(se.search_conditions(staging.products(spark, sf), k=60), 60)


@query
def active_customer_products(spark, sf):
    return se.active_customer_products(staging.reviewed(spark, sf), min_customer_reviews=40, k=25)


# ---- summaries

@query
def category_analysis(spark, sf):
    return su.category_analysis(staging.belongs_to(spark, sf), staging.products(spark, sf)) \
        .withColumn("mean_rating", rounded("mean_rating"))


@query
def top_categories(spark, sf):
    return su.top_categories(staging.belongs_to(spark, sf))


@query
def top_reviewers(spark, sf):
    return su.top_reviewers(staging.reviewed(spark, sf))


@query
def similarity_network(spark, sf):
    return su.similarity_network(staging.similar(spark, sf), staging.products(spark, sf), more_than=30)


def _similar_support(spark: SparkSession, sf: str) -> DataFrame:
    return su.similar_pair_support(staging.similar(spark, sf), staging.products(spark, sf), staging.reviewed(spark, sf))


@query
def similar_pair_support(spark, sf):
    return _similar_support(spark, sf)


@query
def similar_items(spark, sf):
    return mi.similar_items(_similar_support(spark, sf))


@query
def similar_rules(spark, sf):
    rules = mi.similar_rules(_similar_support(spark, sf))
    return rules.select("antecedent", "consequent", rounded("confidence"), rounded("lift"), "support")


# ---- baskets, samples, splits

@query
def baskets(spark, sf):
    found = bk.baskets(staging.reviews(spark, sf), MAX_ITEMS)
    return found.select("customer_id", joined("items"))


@query
def baskets_sampled_items(spark, sf):
    return bk.baskets_sampled_items(staging.reviewed(spark, sf), MAX_ITEMS).select("customer_id", joined("items"))


@query
def sample_baskets(spark, sf):
    found = bk.baskets(staging.reviews(spark, sf), MAX_ITEMS)
    return bk.sample_baskets(found, SAMPLE_MAX).select("customer_id", joined("items"))


@query
def train_test_split(spark, sf):
    return staging.split(spark, sf)


@query
def train_test_split_by_customer(spark, sf):
    return bk.train_test_split(staging.reviewed(spark, sf), split_by="customer_id")


@query
def split_preserved(spark, sf):
    return bk.train_test_split(_half_split(spark, sf))


@query
def split_counts(spark, sf):
    return bk.split_counts(staging.split(spark, sf))


@query
def dataset_or_all(spark, sf):
    """A dataset that exists, and one that does not and so stands for all rows."""
    split = staging.split(spark, sf)
    parts = [bk.dataset_or_all(split, name).withColumn("asked_for", F.lit(name)) for name in ("test", "holdout")]
    return parts[0].unionByName(parts[1])


# ---- mining

@query
def frequent_items(spark, sf):
    return mi.frequent_items(staging.customer_baskets(spark, sf), staging.customer_threshold(spark, sf))


@query
def frequent_pairs(spark, sf):
    return mi.frequent_pairs(staging.customer_baskets(spark, sf), staging.customer_threshold(spark, sf))


def _sets(found: DataFrame) -> DataFrame:
    return found.select(joined("items"), F.size("items").alias("n_items"), "support")


@query
def frequent_itemsets(spark, sf):
    return _sets(it.frequent_itemsets(staging.order_rows(spark, sf), staging.order_threshold(spark, sf), "order_id"))


@query
def frequent_pairs_fpgrowth(spark, sf):
    found = staging.order_baskets(spark, sf)
    least = max(2, mi.min_count_of(found.count(), staging.ORDER_SHARE))
    return mi.itemsets_of_size(mi.fpgrowth_itemsets(found, least), 2)


@query
def frequent_triples(spark, sf):
    return mi.itemsets_of_size(staging.order_itemsets(spark, sf), 3)


@query
def association_rules(spark, sf):
    rules = mi.association_rules(staging.order_itemsets(spark, sf), mi.basket_count(staging.order_rows(spark, sf), "order_id"))
    return rules.select(joined("antecedent"), "consequent", rounded("confidence"), rounded("lift"),
                        rounded("support"))


@query
def pair_rules(spark, sf):
    found = staging.customer_baskets(spark, sf)
    rules = mi.pair_rules(staging.customer_pairs(spark, sf),
                          mi.frequent_items(found, staging.customer_threshold(spark, sf)), mi.basket_count(found))
    return rules.select("antecedent", "consequent", rounded("confidence"), rounded("lift"), rounded("support")) \
        .orderBy(*mi.rule_order())


# Sets of brands and sizes of an order, by their share of the orders.

@query
def attribute_items(spark, sf):
    return mi.frequent_items(staging.attribute_rows(spark, sf), staging.attribute_threshold(spark, sf), "order_id")


@query
def attribute_pairs(spark, sf):
    return mi.frequent_pairs(staging.attribute_rows(spark, sf), staging.attribute_pair_threshold(spark, sf), "order_id")


@query
def attribute_triples(spark, sf):
    found = it.frequent_itemsets(staging.attribute_rows(spark, sf), staging.attribute_threshold(spark, sf, SETS_SHARE),
                                 "order_id", max_size=3)
    return mi.itemsets_of_size(found, 3)


@query
def attribute_rules(spark, sf):
    rows, threshold = staging.attribute_rows(spark, sf), staging.attribute_pair_threshold(spark, sf)
    rules = mi.pair_rules(staging.attribute_pairs(spark, sf), mi.frequent_items(rows, threshold, "order_id"),
                          mi.basket_count(rows, "order_id"))
    return rules.select("antecedent", "consequent", rounded("confidence"), rounded("lift"), rounded("support"))


@query
def train_itemsets(spark, sf):
    """All sets of two and more brands and sizes of the training orders."""
    return _sets(staging.attribute_train_sets(spark, sf))


@query
def validate_itemsets(spark, sf):
    """Their support in the held-out orders, sets of any size at once."""
    found = it.validate_itemsets(staging.attribute_train_sets(spark, sf), staging.attribute_split(spark, sf),
                                 basket="order_id")
    return found.withColumn("items", joined("items"))


def _ranked(spark: SparkSession, sf: str, top: int | None = None, with_rules: bool = False) -> DataFrame:
    found = staging.customer_baskets(spark, sf)
    items = mi.frequent_items(found, staging.customer_threshold(spark, sf)) if with_rules else None
    return mi.ranked_patterns(staging.customer_pairs(spark, sf), mi.basket_count(found), items, top)


@query
def ranked_patterns(spark, sf):
    return _ranked(spark, sf, with_rules=True).withColumns({
        c: F.round(c, 6) for c in ("confidence", "rule_confidence")})


@query
def train_patterns(spark, sf):
    return mi.frequent_pairs(staging.train_rows(spark, sf), staging.train_threshold(spark, sf, SAMPLED_SHARE))


@query
def train_rules(spark, sf):
    """Rules of the stored training pairs that are in enough baskets."""
    rows, threshold = staging.train_rows(spark, sf), staging.train_threshold(spark, sf, SAMPLED_SHARE)
    rules = mi.pair_rules(staging.train_pairs(spark, sf).filter(F.col("support") >= threshold),
                          mi.frequent_items(rows, threshold), mi.basket_count(rows))
    return rules.select("antecedent", "consequent", rounded("confidence"), rounded("lift"), rounded("support"))


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    return mi.validate_patterns(staging.train_pairs(spark, sf), staging.split(spark, sf), min_test_support=TEST_MIN)


@query
def validate_patterns(spark, sf):
    return _validated(spark, sf)


@query
def top_validated(spark, sf):
    return mi.top_validated(_validated(spark, sf))


@query
def mining_stats(spark, sf):
    return mi.mining_stats(staging.split(spark, sf), _validated(spark, sf))


# ---- enrichment and pattern views

@query
def sample_customers(spark, sf):
    reviews = staging.reviews(spark, sf)
    return en.sample_customers(staging.customer_pairs(spark, sf), reviews)


@query
def enriched_patterns(spark, sf):
    found = en.with_products(_ranked(spark, sf), staging.products(spark, sf))
    return found.withColumn("confidence", rounded("confidence"))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.enriched(_ranked(spark, sf), staging.products(spark, sf), staging.reviews(spark, sf))


def _flat(patterns: DataFrame) -> DataFrame:
    samples = F.array_join(F.transform("sample_customers", lambda s: F.concat_ws(
        ":", s["customer_id"], s["rating1"].cast("int").cast("string"), s["rating2"].cast("int").cast("string"))), ";")
    return patterns.select("rank", "products.asin1", "products.asin2", "products.title1", "products.title2",
                           "products.avgRating1", "products.avgRating2", "support", rounded("confidence"),
                           samples.alias("samples"))


@query
def patterns_nested(spark, sf):
    """All patterns, nested and flattened again."""
    return _flat(_enriched(spark, sf))


@query
def write_patterns(spark, sf):
    """All patterns after writing and reading them, each with the metadata but for its time stamp."""
    path = scratch_path(spark, "patterns")
    pt.write_patterns(_enriched(spark, sf), path, jobs.PAIR_COUNT)
    metadata = pt.read_metadata(spark, path)
    return _flat(pt.read_patterns(spark, path)).withColumns({
        c: metadata.select(c).scalar() for c in ("total_patterns", "algorithm")})


@query
def write_results(spark, sf):
    """Validated patterns and statistics of a run after writing and reading them."""
    path = scratch_path(spark, "results")
    split, found = staging.split(spark, sf), _validated(spark, sf)
    pt.write_results(mi.mining_stats(split, found), en.enriched_validated(found, staging.products(spark, sf)), path)
    rows = spark.read.schema("products array<bigint>, train_support bigint, test_support bigint, total_support bigint") \
        .json(f"{path}/patterns")
    stats = spark.read.schema("num_patterns bigint, train_reviews bigint").json(f"{path}/stats")
    return rows.select(joined("products"), "train_support", "test_support", "total_support").withColumns({
        c: stats.select(c).scalar() for c in ("num_patterns", "train_reviews")})


@query
def read_patterns(spark, sf):
    """All served patterns, from their files."""
    return _flat(staging.served(spark, sf))


@query
def enriched_validated(spark, sf):
    found = en.enriched_validated(_validated(spark, sf), staging.products(spark, sf))
    return found.select(joined("products"), joined("titles"), joined("ratings"), "train_support", "test_support",
                        "total_support", "confidence")


@query
def pattern_list(spark, sf):
    return vw.pattern_list(staging.served(spark, sf))


@query
def top_patterns(spark, sf):
    return vw.top_patterns(staging.ranked(spark, sf))


@query
def pattern_detail(spark, sf):
    return vw.pattern_detail(staging.ranked(spark, sf), rank=3)


@query
def pattern_overview(spark, sf):
    return vw.pattern_overview(staging.ranked(spark, sf)).withColumn("confidence_percent",
                                                                     rounded("confidence_percent"))


@query
def rating_distribution(spark, sf):
    return vw.rating_distribution(staging.served(spark, sf)).withColumns({
        c: F.round(c, 6) for c in ("percent", "mean_rating")})
