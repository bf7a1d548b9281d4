"""Filtered top-k searches over products."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from cobasket.functions.ranking import top_ranked
from cobasket.functions.text import cut, number_or, text_or

LISTED = ["asin", "title", "product_group", "avg_rating", "total_reviews", "salesrank"]

# The three searches that are offered by name, and how many products a search returns.
PRESETS: dict[str, dict[str, object]] = {
    "high_rated": {"min_rating": 4.5, "min_reviews": 100},
    "books": {"group": "Book", "min_rating": 4.0, "max_salesrank": 50000},
    "music": {"group": "Music", "min_rating": 4.0, "min_reviews": 50},
}
PRESET_LIMIT = 10
FORM_LIMIT = 20
TITLE_LENGTH = 60


def _bounds(column: str, low: float | None, high: float | None) -> list[Column]:
    bounds = []
    if low is not None:
        bounds.append(F.col(column) >= low)
    if high is not None:
        bounds.append(F.col(column) <= high)
    return bounds


def _filtered(products: DataFrame, predicates: list[Column]) -> DataFrame:
    return products.filter(reduce(and_, predicates)) if predicates else products


def search_form(products: DataFrame, group: str | None = None, min_rating: float | None = None,
                max_rating: float | None = None, min_reviews: int | None = None, max_reviews: int | None = None,
                min_salesrank: int | None = None, max_salesrank: int | None = None,
                limit: int = FORM_LIMIT) -> DataFrame:
    """Search with optional bounds; without a bound on it, a group, rating or review count must at least be there.

    Salesrank has bounds only, so its placeholders -1 and 0 pass a maximum.
    """
    predicates = [F.col("title").isNotNull()]
    predicates.append(F.col("product_group") == group if group and group != "All"
                      else F.col("product_group").isNotNull())
    predicates += _bounds("avg_rating", min_rating, max_rating) or [F.col("avg_rating").isNotNull()]
    predicates += _bounds("total_reviews", min_reviews, max_reviews) or [F.col("total_reviews") > 0]
    predicates += _bounds("salesrank", min_salesrank, max_salesrank)
    order = [F.desc("avg_rating"), F.desc("total_reviews"), F.asc("asin")]
    return _filtered(products, predicates).select(LISTED).orderBy(*order).limit(limit)


def search_conditions(products: DataFrame, conditions: Mapping[str, object] | None = None,
                      k: int = PRESET_LIMIT) -> DataFrame:
    """Search with the given conditions only: min_rating, max_rating, min_reviews, group, max_salesrank.

    A sales rank maximum also asks for a real rank, above 0. A missing rating counts as the largest.
    """
    conditions = conditions or {}
    predicates = _bounds("avg_rating", conditions.get("min_rating"), conditions.get("max_rating"))
    predicates += _bounds("total_reviews", conditions.get("min_reviews"), None)
    if "group" in conditions:
        predicates.append(F.col("product_group") == conditions["group"])
    if "max_salesrank" in conditions:
        predicates += [F.col("salesrank") <= conditions["max_salesrank"], F.col("salesrank") > 0]
    order = [F.desc_nulls_first("avg_rating"), F.desc_nulls_first("total_reviews"), F.asc("asin")]
    return _filtered(products, predicates).select(LISTED).orderBy(*order).limit(k)


def preset(products: DataFrame, name: str, k: int = PRESET_LIMIT, **override: object) -> DataFrame:
    """A search by name; ``override`` replaces single conditions, as thresholds depend on the catalogue."""
    return search_conditions(products, {**PRESETS[name], **override}, k)


def filter_high_rated(products: DataFrame, min_rating: float = 4.5, min_reviews: int = 100) -> DataFrame:
    return products.filter((F.col("avg_rating") >= min_rating) & (F.col("total_reviews") >= min_reviews))


def top_products(products: DataFrame, k: int = 100) -> DataFrame:
    """The most reviewed products."""
    return products.filter(F.col("total_reviews") > 0).orderBy(F.desc("total_reviews"), F.asc("asin")).limit(k)


def listing(found: DataFrame, k: int) -> DataFrame:
    """Search results as shown to a reader: position, cut title, and text in place of missing values."""
    order = [F.desc_nulls_first("avg_rating"), F.desc_nulls_first("total_reviews"), F.asc("asin")]
    return top_ranked(found, k, *order, name="position").select(
        "position", "asin",
        cut(text_or("title", "Unknown"), TITLE_LENGTH).alias("title"),
        text_or("product_group", "Unknown").alias("product_group"),
        number_or("avg_rating", "N/A").alias("rating"),
        F.coalesce("total_reviews", F.lit(0)).alias("reviews"),
        number_or("salesrank", "N/A").alias("salesrank"))


def active_customer_products(reviews: DataFrame, min_customer_reviews: int = 5, k: int = 10) -> DataFrame:
    """Products by the number of distinct active customers who reviewed them; active means at least
    ``min_customer_reviews`` reviews. This definition is ours.

    Reviews are made distinct by customer and product before they are shuffled on the customer, so a customer who
    reviews one product over and over is no large group then.
    """
    active = (reviews.groupBy("customer_id").agg(F.count("*").alias("_n"))
              .filter(F.col("_n") >= min_customer_reviews).select("customer_id"))
    return (reviews.select("customer_id", "product_id").distinct().join(active, "customer_id", "left_semi")
            .groupBy("product_id").agg(F.count("*").alias("active_customers"))
            .orderBy(F.desc("active_customers"), F.asc("product_id")).limit(k))
