"""Nested product records to node and edge tables. Every function is a projection, except the two node lists.

Arrays are exploded with the outer form and the empty ones filtered out after it: the plain form makes Spark check the
array's size below the projection that builds it, which would parse the text a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cobasket.schemas import Graph, PRODUCT_COLUMNS


def products(records: DataFrame) -> DataFrame:
    return records.select("id", *PRODUCT_COLUMNS)


def similar(records: DataFrame) -> DataFrame:
    """One edge per listed product."""
    return records.select(F.col("asin").alias("src"), F.explode_outer("similar").alias("dst")) \
        .filter(F.col("dst").isNotNull())


def belongs_to(records: DataFrame) -> DataFrame:
    """One edge per category name and path: a name that is on two paths of a product gives two edges."""
    names = F.explode_outer(F.flatten("categories")).alias("category")
    return records.select(F.col("asin").alias("product_id"), names).filter(F.col("category").isNotNull())


def reviewed(records: DataFrame) -> DataFrame:
    """One edge per review."""
    rows = records.select("asin", F.explode_outer("reviews").alias("r")).filter(F.col("r").isNotNull())
    return rows.select(F.col("r.customer").alias("customer_id"), F.col("asin").alias("product_id"), "r.rating",
                       "r.date", "r.votes", "r.helpful")


def customers(records: DataFrame) -> DataFrame:
    return reviewed(records).select("customer_id").distinct()


def categories(records: DataFrame) -> DataFrame:
    return belongs_to(records).select(F.col("category").alias("name")).distinct()


def normalize(records: DataFrame) -> Graph:
    """All six tables. ``products`` keeps the record id, which gives the file order that cleaning needs."""
    return Graph(products(records), customers(records), categories(records), belongs_to(records), similar(records),
                 reviewed(records))
