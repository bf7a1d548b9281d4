"""Patterns with product details and sample customers, for all patterns at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cobasket.functions.ranking import first_per_group
from cobasket.operators.mining import pair_rows

# Fixed value: sample customers per pattern.
SAMPLE_CUSTOMERS = 10


def sample_customers(pairs: DataFrame, reviews: DataFrame, limit: int = SAMPLE_CUSTOMERS) -> DataFrame:
    """For each pair, up to ``limit`` customers who reviewed both items: item1, item2, customer_id, rating1, rating2.

    A customer who reviewed an item several times counts once per combination of reviews; the first ones by customer
    and ratings are taken. Customers come from the same pairs of basket rows that mining counts, cut down to the wanted
    pairs and to ``limit`` customers each before they are shuffled; so there are never more candidates than real
    co-purchases. Only then are the ratings looked up, under (customer, product): a combination is one row with a
    multiplicity, and only the rows that make the cut are repeated.
    """
    pairs = pairs.select("item1", "item2")
    wanted = pairs.select(F.explode(F.array("item1", "item2")).alias("product_id")).distinct()
    counted = (reviews.filter(F.col("customer_id").isNotNull()).join(wanted, "product_id", "left_semi")
               .groupBy("customer_id", "product_id", "rating").agg(F.count("*").alias("_n")))
    rows = counted.select("customer_id", F.col("product_id").alias("item")).distinct()
    bought = pair_rows(rows).join(pairs, ["item1", "item2"], "left_semi")
    chosen = first_per_group(bought, ["item1", "item2"], limit, "customer_id")
    sides = [counted.select("customer_id", F.col("product_id").alias(f"item{i}"), F.col("rating").alias(f"rating{i}"),
                            F.col("_n").alias(f"_n{i}")) for i in (1, 2)]
    both = chosen.join(sides[0], ["customer_id", "item1"]).join(sides[1], ["customer_id", "item2"]).select(
        "item1", "item2", "customer_id", "rating1", "rating2",
        # More than `limit` copies are never needed, so the product of two counts cannot overflow.
        (F.least("_n1", F.lit(limit)) * F.least("_n2", F.lit(limit))).alias("_copies"))
    order = ["customer_id", "rating1", "rating2"]
    first = first_per_group(both, ["item1", "item2"], limit, *order)
    before = Window.partitionBy("item1", "item2").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(limit) - F.coalesce(F.sum("_copies").over(before), F.lit(0))
    cut = first.withColumn("_room", room).filter(F.col("_room") > 0)
    copies = F.array_repeat(F.lit(0), F.least("_copies", "_room").cast("int"))
    return cut.withColumn("_copy", F.explode(copies)).select("item1", "item2", "customer_id", "rating1", "rating2")


def with_products(patterns: DataFrame, products: DataFrame) -> DataFrame:
    """Add title1, title2 ('Unknown' when the product has none) and avg_rating1, avg_rating2 (null then)."""
    found = patterns
    for i in (1, 2):
        side = products.select(F.col("asin").alias(f"item{i}"), F.col("title").alias(f"title{i}"),
                               F.col("avg_rating").alias(f"avg_rating{i}"))
        found = found.join(side, f"item{i}", "left")
    details = [c for i in (1, 2) for c in (F.coalesce(f"title{i}", F.lit("Unknown")).alias(f"title{i}"),
                                           f"avg_rating{i}")]
    return found.select(*patterns.columns, *details)


def nested_patterns(enriched: DataFrame, samples: DataFrame) -> DataFrame:
    """One nested row per pattern, as it is served: rank, products, support, confidence, sample_customers.

    A pattern has ``limit`` samples at most, so the lists are short.
    """
    sample = F.struct(F.col("customer_id").cast("string").alias("customer_id"),
                      F.col("rating1").cast("double").alias("rating1"),
                      F.col("rating2").cast("double").alias("rating2"))
    lists = samples.groupBy("item1", "item2").agg(F.sort_array(F.collect_list(sample)).alias("sample_customers"))
    products = F.struct(F.col("item1").cast("string").alias("asin1"), F.col("item2").cast("string").alias("asin2"),
                        "title1", "title2", F.col("avg_rating1").alias("avgRating1"),
                        F.col("avg_rating2").alias("avgRating2"))
    empty = F.array().cast("array<struct<customer_id:string,rating1:double,rating2:double>>")
    return enriched.join(lists, ["item1", "item2"], "left").select(
        F.col("rank").cast("bigint").alias("rank"), products.alias("products"), "support", "confidence",
        F.coalesce("sample_customers", empty).alias("sample_customers"))


def enriched_validated(validated: DataFrame, products: DataFrame) -> DataFrame:
    """All validated patterns with arrays of titles and ratings.

    The missing title is 'Unknown' and the missing rating 0.0. ``confidence`` is 0.0: validation does not set it.
    """
    known = products.select(F.col("asin").alias("_item"), "title", "avg_rating")
    exploded = validated.select("*", F.posexplode(F.array("item1", "item2")).alias("_at", "_item"))
    found = exploded.join(known, "_item", "left").withColumn("_detail", F.struct(
        "_at", F.coalesce("title", F.lit("Unknown")).alias("title"),
        F.coalesce("avg_rating", F.lit(0.0)).alias("rating")))
    keys = ["item1", "item2", "train_support", "test_support", "total_support"]
    details = found.groupBy(*keys).agg(F.sort_array(F.collect_list("_detail")).alias("_details"))
    return details.select(
        F.array("item1", "item2").alias("products"), F.col("_details.title").alias("titles"),
        F.col("_details.rating").alias("ratings"), "train_support", "test_support", "total_support",
        F.lit(0.0).alias("confidence"))
