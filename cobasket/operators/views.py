"""Views of served patterns (``schemas.PATTERN``): list, report, detail, overview series, rating shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cobasket.functions.text import cut

# Lengths and limits of the views.
LIST_TITLE = 40
REPORT_TITLE = 60
REPORT_PATTERNS = 10
DETAIL_SAMPLES = 5
OVERVIEW_PATTERNS = 20


def pattern_list(patterns: DataFrame) -> DataFrame:
    return patterns.select("rank", cut("products.title1", LIST_TITLE).alias("title1"),
                           cut("products.title2", LIST_TITLE).alias("title2"), "support",
                           F.format_string("%.4f", "confidence").alias("confidence"))


def top_patterns(patterns: DataFrame, k: int = REPORT_PATTERNS) -> DataFrame:
    """The report of the first ``k`` patterns, ratings as text with 'N/A' for a missing one."""
    def rating(i: int):
        value = F.col(f"products.avgRating{i}")
        return F.when(value.isNull(), F.lit("N/A")).otherwise(F.format_string("%.2f", value)).alias(f"rating{i}")

    return patterns.filter(F.col("rank") <= k).select(
        "rank", "support", F.format_string("%.4f", "confidence").alias("confidence"),
        cut("products.title1", REPORT_TITLE).alias("title1"), rating(1),
        cut("products.title2", REPORT_TITLE).alias("title2"), rating(2),
        F.size("sample_customers").alias("n_samples"))


def pattern_detail(patterns: DataFrame, rank: int) -> DataFrame:
    """One pattern with its first sample customers, one row each; one row with nulls if it has none."""
    one = patterns.filter(F.col("rank") == rank)
    rows = one.select("rank", "products.asin1", "products.title1", "products.asin2", "products.title2", "support",
                      F.format_string("%.4f", "confidence").alias("confidence"),
                      F.posexplode_outer(F.slice("sample_customers", 1, DETAIL_SAMPLES)).alias("_at", "_sample"))
    return rows.select("rank", "asin1", "title1", "asin2", "title2", "support", "confidence",
                       (F.col("_at") + 1).alias("position"), "_sample.customer_id",
                       F.format_string("%.1f", "_sample.rating1").alias("rating1"),
                       F.format_string("%.1f", "_sample.rating2").alias("rating2"))


def pattern_overview(patterns: DataFrame, k: int = OVERVIEW_PATTERNS) -> DataFrame:
    return patterns.filter(F.col("rank") <= k).select(
        "rank", "support", (F.col("confidence") * 100).alias("confidence_percent"))


def rating_distribution(patterns: DataFrame) -> DataFrame:
    """Per pattern and product (1 or 2): each rating among the samples, its count, its share in percent, the mean.

    The samples of a pattern are few, so this is a projection and two small aggregations per pattern.
    """
    samples = patterns.select("rank", F.inline("sample_customers"))
    ratings = samples.select("rank", F.inline(F.array(
        F.struct(F.lit(1).alias("product"), F.col("rating1").alias("rating")),
        F.struct(F.lit(2).alias("product"), F.col("rating2").alias("rating")))))
    counts = ratings.groupBy("rank", "product", "rating").agg(F.count("*").alias("n_ratings"))
    whole = Window.partitionBy("rank", "product")
    total = F.sum("n_ratings").over(whole)
    return counts.select("rank", "product", "rating", "n_ratings",
                         (F.lit(100.0) * F.col("n_ratings") / total).alias("percent"),
                         (F.sum(F.col("rating") * F.col("n_ratings")).over(whole) / total).alias("mean_rating"))
