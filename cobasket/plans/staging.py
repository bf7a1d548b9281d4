"""Tables that several queries of one session share, as the stages of an ingest and a mining job leave them behind.

Each is written once per session and input folder, into the shared folder (``session.shared_dir``). A table that is
read more than once is thus computed once, its readers take only the columns they need, and as nothing is kept in
executor memory, losing an executor loses nothing.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from cobasket.operators import baskets as bk, clean as cleaning, itemsets, mining, normalize
from cobasket.plans import jobs, views
from cobasket.schemas import Graph
from cobasket.session import COMPRESSION, file_of, scratch_path, shuffle_files_removed
from cobasket.sources import patterns, tables, typed_csv
from cobasket.sources.records import parse_text, read_records, records_of

# Thresholds for the order database's tables.
MAX_ITEMS = 20  # items per basket, where the limit itself is shown
CUSTOMER_SHARE = 0.0025  # share of customers that a pair must be in
ORDER_SHARE = 0.00014  # share of orders that an itemset must be in
ATTRIBUTE_SHARE = 0.01  # share of orders that a brand or size must be in by itself
SETS_SHARE = 0.002  # and a set of them
TRAIN_SHARE = 0.0012  # share of training baskets that a pair must be in to be checked
SAMPLED_SHARE = 0.0018  # and to be reported as a pattern of its own

CSV_COMPRESSION = "gzip"

_written: dict[tuple[str, str, str], str] = {}
_lock = threading.RLock()


def _once(spark: SparkSession, sf_dir: str, stage: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, stage)
    with _lock:  # a stage is written by one thread
        if not _is_written(spark, sf_dir, stage):
            path = scratch_path(spark, stage)
            with shuffle_files_removed(spark):
                write(path)
            _written[key] = path
        return _written[key]


def _is_written(spark: SparkSession, sf_dir: str, stage: str) -> bool:
    path = _written.get((spark.sparkContext.applicationId, sf_dir, stage))
    if path is None:
        return False
    system, found = file_of(spark, path)
    return system.exists(found)


def clean_up(spark: SparkSession) -> int:
    """Remove the stages this session has written; the number of them. Later queries write theirs again."""
    with _lock:
        own = [key for key in _written if key[0] == spark.sparkContext.applicationId]
        for key in own:
            system, path = file_of(spark, _written.pop(key))
            system.delete(path, True)
        return len(own)


def _table(spark: SparkSession, sf_dir: str, stage: str, build: Callable[[], DataFrame]) -> DataFrame:
    return spark.read.parquet(_once(spark, sf_dir, stage, lambda path: build().write.parquet(
        path, compression=COMPRESSION)))


# ---- the text

def raw_text(spark: SparkSession, sf_dir: str) -> str:
    return _once(spark, sf_dir, "raw", lambda path: views.write_listings(spark, sf_dir, path))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records parsed from the text files."""
    return read_records(spark, raw_text(spark, sf_dir))


def parsed_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything one pass gives of text with junk, undecodable bytes, quotes and unreadable numbers."""
    return spark.read.parquet(_once(spark, sf_dir, "parsed_dirty", lambda out: _parsed_once(
        spark, "dirty", lambda path: views.write_dirty_listings(spark, sf_dir, path),
        lambda path: parse_text(spark, path), out)))


def _parsed_once(spark: SparkSession, stage: str, write: Callable[[str], None], parse: Callable[[str], DataFrame],
                 out: str) -> None:
    """Write text, parse it to ``out``, and remove the text, which nothing else reads: what comes later has its room."""
    text = scratch_path(spark, stage)
    write(text)
    parse(text).write.parquet(out, compression=COMPRESSION)
    system, path = file_of(spark, text)
    system.delete(path, True)


def dirty_csv(spark: SparkSession, sf_dir: str) -> Graph:
    """The records of the dirty text as a graph, after a round trip through typed CSV."""
    path = _once(spark, sf_dir, "dirty_csv", lambda out: typed_csv.write_graph_csv(
        normalize.normalize(records_of(parsed_dirty(spark, sf_dir))), out, CSV_COMPRESSION))
    return typed_csv.read_graph_csv(spark, path)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed records, from the text files if this session has them, else from text that is only written for that."""
    def write(out: str) -> None:
        if _is_written(spark, sf_dir, "raw"):
            parsed(spark, sf_dir).write.parquet(out, compression=COMPRESSION)
        else:
            _parsed_once(spark, "listings", lambda path: views.write_listings(spark, sf_dir, path),
                         lambda path: read_records(spark, path), out)

    return spark.read.parquet(_once(spark, sf_dir, "records", write))


def normalized(spark: SparkSession, sf_dir: str) -> Graph:
    return normalize.normalize(records(spark, sf_dir))


def clean_nodes(spark: SparkSession, sf_dir: str) -> Graph:
    """The cleaned graph with its node tables written. The edges are checked against them where they are read: for those
    who read no edges, or each once."""
    raw = normalized(spark, sf_dir)
    products = _table(spark, sf_dir, "clean_products", lambda: cleaning.clean_products(raw.products))
    customers = _table(spark, sf_dir, "clean_customers", lambda: cleaning.clean_keys(raw.customers, "customer_id"))
    categories = _table(spark, sf_dir, "clean_categories", lambda: cleaning.clean_keys(raw.categories, "name"))
    return Graph(
        products, customers, categories,
        cleaning.clean_belongs_to(raw.belongs_to, products, categories),
        cleaning.clean_similar(raw.similar, products),
        cleaning.clean_reviewed(raw.reviewed, customers, products))


def cleaned(spark: SparkSession, sf_dir: str) -> Graph:
    """The cleaned graph, written. Node tables are written first, as the edges are checked against them."""
    graph = clean_nodes(spark, sf_dir)
    return Graph(
        graph.products, graph.customers, graph.categories,
        _table(spark, sf_dir, "clean_belongs_to", lambda: graph.belongs_to),
        _table(spark, sf_dir, "clean_similar", lambda: graph.similar),
        _table(spark, sf_dir, "clean_reviewed", lambda: graph.reviewed))


def csv(spark: SparkSession, sf_dir: str) -> Graph:
    """The cleaned graph after a round trip through typed CSV."""
    path = _once(spark, sf_dir, "csv", lambda out: typed_csv.write_graph_csv(clean_nodes(spark, sf_dir), out,
                                                                             CSV_COMPRESSION))
    return typed_csv.read_graph_csv(spark, path)


# ---- the order database

def reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "reviewed", lambda: views.reviews(spark, sf_dir))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mining input."""
    return tables.scan_reviews(reviewed(spark, sf_dir))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "products", lambda: views.products(spark, sf_dir, reviewed(spark, sf_dir)))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customers", lambda: reviewed(spark, sf_dir).select("customer_id").distinct())


def belongs_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "belongs_to", lambda: views.belongs_to(spark, sf_dir))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "categories", lambda: belongs_to(spark, sf_dir).selectExpr("category AS name")
                  .distinct())


def similar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "similar", lambda: views.similar(order_rows(spark, sf_dir)))


def graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The views over the order database as a stored graph."""
    return Graph(*[build(spark, sf_dir) for build in (products, customers, categories, belongs_to, similar,
                                                      reviewed)])


def bucketed(spark: SparkSession, sf_dir: str) -> str:
    """The graph in buckets: the prefix of its tables' names in this session."""
    path = _once(spark, sf_dir, "bucketed", lambda out: _prefixes.__setitem__(out, tables.write_buckets(
        graph(spark, sf_dir), out, GRAPH_BUCKETS)))
    return _prefixes[path]


GRAPH_BUCKETS = 8
_prefixes: dict[str, str] = {}


def customer_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer_baskets",
                  lambda: bk.basket_rows(reviews(spark, sf_dir)))


def customer_threshold(spark: SparkSession, sf_dir: str) -> Column:
    return mining.count_of_share(customer_baskets(spark, sf_dir), CUSTOMER_SHARE)


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "order_rows", lambda: bk.basket_rows(views.order_lines(spark, sf_dir), "order_id"))


def order_threshold(spark: SparkSession, sf_dir: str) -> Column:
    return mining.count_of_share(order_rows(spark, sf_dir), ORDER_SHARE, "order_id")


def order_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as lists, which MLlib's FP-Growth takes; nothing else reads them."""
    return _table(spark, sf_dir, "order_baskets",
                  lambda: bk.baskets(views.order_lines(spark, sf_dir), basket="order_id"))


def attribute_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "attribute_rows",
                  lambda: bk.basket_rows(views.order_attributes(spark, sf_dir), "order_id"))


def attribute_threshold(spark: SparkSession, sf_dir: str, share: float = ATTRIBUTE_SHARE, at_least: int = 2) -> Column:
    return mining.count_of_share(attribute_rows(spark, sf_dir), share, "order_id", at_least)


def attribute_pair_threshold(spark: SparkSession, sf_dir: str) -> Column:
    """That of pairs and their rules; on a few orders, pairs of a single one are reported as well."""
    return attribute_threshold(spark, sf_dir, SETS_SHARE, 1)


def attribute_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "attribute_pairs", lambda: mining.frequent_pairs(
        attribute_rows(spark, sf_dir), attribute_pair_threshold(spark, sf_dir), "order_id"))


def attribute_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole orders as training or held-out rows; a projection, so not written."""
    return bk.train_test_split(attribute_rows(spark, sf_dir), split_by="order_id")


def attribute_train_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets of two and more brands and sizes of training orders."""
    def build() -> DataFrame:
        rows = attribute_split(spark, sf_dir).filter("dataset = 'train'").drop("dataset")
        found = itemsets.frequent_itemsets(rows, mining.count_of_share(rows, SETS_SHARE, "order_id"), "order_id")
        return found.filter("size(items) >= 2")

    return _table(spark, sf_dir, "attribute_train_sets", build)


def customer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "customer_pairs", lambda: mining.frequent_pairs(
        customer_baskets(spark, sf_dir), customer_threshold(spark, sf_dir)))


def order_itemsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "order_itemsets", lambda: itemsets.frequent_itemsets(
        order_rows(spark, sf_dir), order_threshold(spark, sf_dir), "order_id"))


def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews with their dataset; a projection, so not written."""
    return bk.train_test_split(reviewed(spark, sf_dir))


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training baskets."""
    return _table(spark, sf_dir, "train_rows", lambda: mining.train_rows(split(spark, sf_dir)))


def train_threshold(spark: SparkSession, sf_dir: str, share: float = TRAIN_SHARE) -> Column:
    return mining.count_of_share(train_rows(spark, sf_dir), share)


def train_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "train_pairs", lambda: mining.frequent_pairs(
        train_rows(spark, sf_dir), train_threshold(spark, sf_dir)))


def served_path(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the served patterns: all frequent pairs, ranked and enriched."""
    return _once(spark, sf_dir, "patterns", lambda path: jobs.serve_patterns(
        customer_pairs(spark, sf_dir), mining.basket_count(customer_baskets(spark, sf_dir)),
        products(spark, sf_dir), reviews(spark, sf_dir), path))


def served(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patterns.read_patterns(spark, served_path(spark, sf_dir))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The served patterns in the order of their ranks."""
    return patterns.read_ranked(spark, served_path(spark, sf_dir))
