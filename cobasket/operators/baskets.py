"""Baskets: the distinct products of a customer. Plus splitting and sampling.

Mining works on basket *rows*, one per customer and product, so a customer with a third of all reviews is never one
list. A limit on a basket's items, or on the number of baskets, is applied only where a caller asks for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cobasket.functions.hashing import hash_text, percent_bucket, unit_hash
from cobasket.functions.ranking import first_per_group
from cobasket.session import stored

# Shares and thresholds of the two mining jobs.
TRAIN_PERCENT = 70
MIN_DATASET_ROWS = 1


def _limited(reviews: DataFrame, max_items: int | None, basket: str, *order: str | Column) -> DataFrame:
    items = (reviews.filter(F.col(basket).isNotNull() & F.col("product_id").isNotNull())
             .select(basket, "product_id").distinct())
    return items if max_items is None else first_per_group(items, [basket], max_items, *order)


def basket_rows(reviews: DataFrame, basket: str = "customer_id") -> DataFrame:
    """One row per basket and distinct product, of baskets with two products or more.

    Sizes are counted in the tasks before they are shuffled. Distinct rows and sizes are stored before they are joined, so
    that the rows are made once, both sides of the join are plain shuffles and the skew join splits a basket that holds a
    third of all rows.
    """
    items = stored(_limited(reviews, None, basket), "basket-items")
    larger = items.groupBy(basket).agg(F.count("*").alias("_n")).filter("_n >= 2").select(basket)
    return items.join(stored(larger, "larger-baskets"), basket, "left_semi")


def _collect(items: DataFrame, basket: str) -> DataFrame:
    return (items.groupBy(basket).agg(F.sort_array(F.collect_list("product_id")).alias("items"))
            .filter(F.size("items") >= 2))


def baskets(reviews: DataFrame, max_items: int | None = None, basket: str = "customer_id") -> DataFrame:
    """Baskets of two or more products as lists: ``basket``, ``items``; all of them, or the first ``max_items`` in key
    order. Without a limit, a list is as long as its basket: for baskets that are small by nature, such as orders."""
    return _collect(_limited(reviews, max_items, basket, "product_id"), basket)


def baskets_sampled_items(reviews: DataFrame, max_items: int, basket: str = "customer_id") -> DataFrame:
    """Baskets of two or more products: ``max_items`` chosen pseudo-randomly, the same ones every time."""
    return _collect(_limited(reviews, max_items, basket, hash_text(basket, "product_id"), "product_id"), basket)


def basket_count(baskets: DataFrame, basket: str = "customer_id") -> Column:
    """The number of baskets, as rows or as lists: a scalar subquery for use inside a plan over the same baskets."""
    keys = baskets if "items" in baskets.columns else baskets.select(basket).distinct()
    return keys.agg(F.count("*")).scalar()


def sample_baskets(basket_table: DataFrame, max_baskets: int, basket: str = "customer_id") -> DataFrame:
    """About ``max_baskets`` baskets, each kept or not by the hash of its key; all of them if there are no more.

    The share to keep is a scalar subquery over the same baskets: no driver action and no sort.
    """
    total = basket_count(basket_table, basket)
    share = F.try_divide(F.lit(float(max_baskets)), total)
    return basket_table.filter((total <= max_baskets) | (unit_hash(basket) < share))


def train_test_split(reviews: DataFrame, train_percent: int = TRAIN_PERCENT,
                     split_by: str | list[str] | None = None) -> DataFrame:
    """Set ``dataset`` to 'train' or 'test', row by row. A row that has a dataset already keeps it.

    ``split_by`` names the columns whose hash decides; all columns by default. With the customer column, no customer
    without a dataset is put on both sides.
    """
    keys = [split_by] if isinstance(split_by, str) else split_by
    keys = keys or [c for c in reviews.columns if c != "dataset"]
    drawn = F.when(percent_bucket(*keys) < train_percent, F.lit("train")).otherwise(F.lit("test"))
    known = [F.col("dataset")] if "dataset" in reviews.columns else []
    return reviews.withColumn("dataset", F.coalesce(*known, drawn))


def split_counts(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("dataset").agg(F.count("*").alias("n_reviews"))


def dataset_or_all(reviews: DataFrame, dataset: str, min_rows: int = MIN_DATASET_ROWS) -> DataFrame:
    """The rows of one dataset, or all rows when it has fewer than ``min_rows``: none, unless the caller asks for more.

    No other operator does this by itself, as it would mix the datasets. Counts no further than ``min_rows``.
    """
    rows = reviews.filter(F.col("dataset") == dataset)
    return rows if rows.limit(min_rows).count() >= min_rows else reviews
