"""Whole jobs: text to stored graph, graph to served patterns, and patterns with a held-out check.

Each job writes its intermediate tables under the folder it is given, or checkpoints them, wherever one is used more
than once. There is no loop over patterns and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from cobasket.operators import baskets as bk, clean, enrich, load, mining, normalize
from cobasket.schemas import Graph
from cobasket.session import checkpointed, stored
from cobasket.sources import patterns, tables, typed_csv
from cobasket.sources.records import parse_text, records_of

# Fixed value: the share of baskets that a served pattern is in.
SERVED_SUPPORT = 0.0005
PAIR_COUNT = "pair counting over blocks of basket rows"


def ingest(spark: SparkSession, text: str, root: str, fill_defaults: bool = True, csv: bool = False) -> Graph:
    """Text files to a stored graph: ``root/parsed``, ``root/nodes`` and ``root/graph`` [, ``root/csv``].

    ``root/parsed`` holds the records and what could not be read (``records.rejects_of``), from one pass. Cleaned node tables are written before the edges are checked against them. Edges that passed the check have both
    ends, and node keys are unique, so loading needs no further join.
    """
    parse_text(spark, text).write.mode("overwrite").parquet(f"{root}/parsed")
    raw = normalize.normalize(records_of(spark.read.parquet(f"{root}/parsed")))
    nodes = {"products": clean.clean_products(raw.products),
             "customers": clean.clean_keys(raw.customers, "customer_id"),
             "categories": clean.clean_keys(raw.categories, "name")}
    for name, df in nodes.items():
        df.write.mode("overwrite").parquet(f"{root}/nodes/{name}")
        nodes[name] = spark.read.parquet(f"{root}/nodes/{name}")
    products, customers, categories = nodes["products"], nodes["customers"], nodes["categories"]
    cleaned = Graph(products, customers, categories,
                    clean.clean_belongs_to(raw.belongs_to, products, categories),
                    clean.clean_similar(raw.similar, products),
                    clean.clean_reviewed(raw.reviewed, customers, products))
    loaded = Graph(load.load_products(products, fill_defaults), load.load_customers(customers), categories,
                   cleaned.belongs_to, cleaned.similar, cleaned.reviewed)
    tables.write_graph(loaded, f"{root}/graph")
    if csv:
        stored = tables.read_graph(spark, f"{root}/graph")
        typed_csv.write_graph_csv(Graph(products, customers, categories, stored.belongs_to, stored.similar,
                                        stored.reviewed), f"{root}/csv")
    return tables.read_graph(spark, f"{root}/graph")


def load_csv(spark: SparkSession, csv: str, root: str, fill_defaults: bool = True) -> Graph:
    """Typed CSV files to a stored graph; edges are resolved against the nodes."""
    loaded = load.load_graph(typed_csv.read_graph_csv(spark, csv), fill_defaults)
    tables.write_graph(loaded, root)
    return tables.read_graph(spark, root)


def enriched(ranked: DataFrame, products: DataFrame, reviews: DataFrame) -> DataFrame:
    """Ranked pairs as nested patterns, with product details and sample customers."""
    return enrich.nested_patterns(enrich.with_products(ranked, products), enrich.sample_customers(ranked, reviews))


def serve_patterns(pairs: DataFrame, n_baskets: Column | int, products: DataFrame, reviews: DataFrame,
                   path: str) -> None:
    """Rank and enrich all pairs and write them, by rank to be read from and as JSON lines. The ranking is used twice, and
    ends in a checkpoint anyhow."""
    found = stored(enriched(mining.ranked_patterns(pairs, n_baskets), products, reviews), "enriched")
    patterns.write_ranked(found, path)
    patterns.write_patterns(found, path, PAIR_COUNT)


def _rows(reviews: DataFrame, max_baskets: int | None) -> DataFrame:
    rows = checkpointed(bk.basket_rows(reviews))
    return rows if max_baskets is None else bk.sample_baskets(rows, max_baskets)


def mine_patterns(graph: Graph, path: str, min_support: float = SERVED_SUPPORT, min_count: int | None = None,
                  max_baskets: int | None = None) -> DataFrame:
    """Mine a graph's reviews and write the served patterns to ``path`` and their rules to ``path/rules``; gives the
    metadata row.

    The threshold is ``min_count`` baskets, or else the share ``min_support`` of them. All baskets are mined, or about
    ``max_baskets`` if that is given.
    """
    reviews = tables.scan_reviews(graph.reviewed)
    found = _rows(reviews, max_baskets)
    total = found.select("customer_id").distinct().count()
    threshold = min_count or mining.min_count_of(total, min_support)
    pairs = checkpointed(mining.frequent_pairs(found, threshold))
    serve_patterns(pairs, total, graph.products, reviews, path)
    mining.pair_rules(pairs, mining.frequent_items(found, threshold), total).write.mode("overwrite").json(f"{path}/rules")
    return patterns.read_metadata(reviews.sparkSession, path)


def mine_validated(graph: Graph, path: str, min_support: float = mining.MIN_SUPPORT, min_count: int | None = None,
                   min_test_support: int = mining.MIN_TEST_SUPPORT, max_baskets: int | None = None,
                   split_by: str | list[str] | None = None) -> DataFrame:
    """Mine the training reviews, check the patterns on the test reviews, write both and the rules; gives the patterns."""
    split = bk.train_test_split(graph.reviewed, split_by=split_by)
    found = _rows(split.filter("dataset = 'train'"), max_baskets)
    total = found.select("customer_id").distinct().count()
    threshold = min_count or mining.min_count_of(total, min_support)
    train = checkpointed(mining.frequent_pairs(found, threshold))
    validated = checkpointed(mining.validate_patterns(train, split, min_test_support=min_test_support))
    patterns.write_results(mining.mining_stats(split, validated), enrich.enriched_validated(validated, graph.products),
                           path, mining.pair_rules(train, mining.frequent_items(found, threshold), total))
    return validated
