"""Time the headline queries; prints one JSON line.

    BENCH_SF_DIR  input folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)

``load_*`` entries store the graph's tables, as a database load would; the queries after them read the stored tables,
and the mining entries are timed from the stored reviews on. Writing the text records, which only makes input for the
parser, is not timed. A query's result is written to Spark's
``noop`` sink, so all rows and columns are computed and none are collected.
"""

from __future__ import annotations

import json
import os
import time

from cobasket.plans import catalog, staging
from cobasket.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

LOADS = {
    "load_reviews_table": staging.reviewed,
    "load_products_table": staging.products,
    "load_belongs_to_table": staging.belongs_to,
    "load_order_baskets": staging.order_baskets,
    "load_similar_table": staging.similar,
    "load_text_parsed": staging.records,
    "load_text_cleaned": staging.cleaned,
    "mine_baskets": staging.customer_baskets,
    "mine_pairs": staging.customer_pairs,
    "mine_served_patterns": staging.served_path,
    "mine_train_pairs": staging.train_pairs,
}
QUERIES = ["filter_high_rated", "top_products", "search_form_default", "category_analysis", "top_categories",
           "top_reviewers", "load_relationships", "similarity_network", "similar_pair_support",
           "active_customer_products", "frequent_pairs", "frequent_itemsets", "pair_rules", "ranked_patterns",
           "attribute_pairs", "attribute_triples", "train_rules", "validate_itemsets", "snapshot_differences",
           "scan_reviews_by_product",
           "sample_customers", "enriched_patterns", "validate_patterns", "pattern_overview", "rating_distribution",
           "parse_products", "parse_reviews", "clean_reviews", "clean_rejects"]


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "32m",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    times: dict[str, float] = {}
    staging.raw_text(spark, SF_DIR)
    for name, load in LOADS.items():
        start = time.perf_counter()
        load(spark, SF_DIR)
        times[name] = round(time.perf_counter() - start, 3)
    registered = catalog.queries()
    for name in QUERIES:
        start = time.perf_counter()
        registered[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": SF_DIR.rstrip("/").rpartition("sf")[2]}))


if __name__ == "__main__":
    main()
