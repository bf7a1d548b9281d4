"""Summaries over the graph's edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def category_analysis(belongs_to: DataFrame, products: DataFrame) -> DataFrame:
    """Edges per category and the edge-weighted mean rating; products without a rating do not enter the mean.

    The edges are shuffled once, for the join. A category that holds a third of them is summed up in the tasks of the
    join, and a product that does is split by adaptive execution, as the shuffle that follows is on another column.
    """
    ratings = products.select(F.col("asin").alias("product_id"), "avg_rating")
    return (belongs_to.join(ratings, "product_id").groupBy("category")
            .agg(F.count("*").alias("n_products"), F.avg("avg_rating").alias("mean_rating")))


def top_categories(belongs_to: DataFrame, k: int = 50) -> DataFrame:
    return (belongs_to.groupBy("category").agg(F.count("*").alias("n_products"))
            .orderBy(F.desc("n_products"), F.asc("category")).limit(k))


def top_reviewers(reviewed: DataFrame, min_rating: int = 4, k: int = 100) -> DataFrame:
    """Customers by their number of good reviews."""
    return (reviewed.filter(F.col("rating") >= min_rating)
            .groupBy("customer_id").agg(F.count("*").alias("n_reviews"))
            .orderBy(F.desc("n_reviews"), F.asc("customer_id")).limit(k))


def _both_ends(similar: DataFrame, products: DataFrame) -> DataFrame:
    ends = [products.select(F.col("asin").alias(key), F.col("title").alias(f"title{i}"),
                            F.col("total_reviews").alias(f"reviews{i}"))
            for i, key in ((1, "src"), (2, "dst"))]
    return similar.join(ends[0], "src").join(ends[1], "dst") \
        .withColumnsRenamed({"src": "asin1", "dst": "asin2"})


def similarity_network(similar: DataFrame, products: DataFrame, more_than: int = 100, k: int = 500) -> DataFrame:
    """Similar edges between two much reviewed products, in key order."""
    reviewed = products.filter(F.col("total_reviews") > more_than)
    return (_both_ends(similar, reviewed).select("asin1", "title1", "asin2", "title2")
            .orderBy("asin1", "asin2", F.asc_nulls_first("title1"), F.asc_nulls_first("title2")).limit(k))


def similar_pair_support(similar: DataFrame, products: DataFrame, reviews: DataFrame, min_support: int = 3) -> DataFrame:
    """Similar pairs by how many customers reviewed both products.

    Each pair is extended by the reviewers of its less reviewed product only, and these are then looked up among the
    reviewers of the other one: a product that holds a third of all reviews is looked up in, not expanded. Which
    product is extended changes the cost, not the count.
    """
    pairs = _both_ends(similar.distinct(), products.filter(F.col("total_reviews") >= min_support))
    first_is_rarer = F.col("reviews1") <= F.col("reviews2")
    pairs = pairs.withColumns({
        "_rare": F.when(first_is_rarer, F.col("asin1")).otherwise(F.col("asin2")),
        "_other": F.when(first_is_rarer, F.col("asin2")).otherwise(F.col("asin1"))})
    seen = reviews.select("customer_id", "product_id").distinct()
    candidates = pairs.join(seen.withColumnRenamed("product_id", "_rare"), "_rare")
    both = candidates.join(seen.withColumnRenamed("product_id", "_other"), ["customer_id", "_other"], "left_semi")
    support = both.groupBy("asin1", "asin2").agg(
        F.count("*").alias("support"), F.max("title1").alias("title1"), F.max("reviews1").alias("reviews1"),
        F.max("title2").alias("title2"), F.max("reviews2").alias("reviews2"))
    return (support.filter(F.col("support") >= min_support)
            .select("asin1", "title1", "reviews1", "asin2", "title2", "reviews2", "support")
            .orderBy(F.desc("support"), "asin1", "asin2"))
