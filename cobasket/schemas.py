"""Row types of the engine's tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

REVIEW_STRUCT = "struct<date:string,customer:string,rating:int,votes:int,helpful:int>"

# A parsed product record, one row per text block.
RECORD = (
    "id bigint, asin string, title string, product_group string, salesrank bigint, similar array<string>, "
    "categories array<array<string>>, total_reviews int, downloaded_reviews int, avg_rating double, "
    f"reviews array<{REVIEW_STRUCT}>"
)

PRODUCT_COLUMNS = ["asin", "title", "product_group", "salesrank", "avg_rating", "total_reviews"]

# A served pattern, one JSON line each.
PATTERN = (
    "rank bigint, products struct<asin1:string,asin2:string,title1:string,title2:string,"
    "avgRating1:double,avgRating2:double>, support bigint, confidence double, "
    "sample_customers array<struct<customer_id:string,rating1:double,rating2:double>>"
)


@dataclass(frozen=True)
class Graph:
    """Three node tables and three edge tables.

    products    asin, title, product_group, salesrank, avg_rating, total_reviews
    customers   customer_id
    categories  name
    belongs_to  product_id, category
    similar     src, dst
    reviewed    customer_id, product_id, rating, date, votes, helpful
    """

    products: DataFrame
    customers: DataFrame
    categories: DataFrame
    belongs_to: DataFrame
    similar: DataFrame
    reviewed: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}


# Graph labels in the order the loaders report them.
NODE_LABELS = {"products": "Product", "customers": "Customer", "categories": "Category"}
EDGE_LABELS = {"belongs_to": "BELONGS_TO", "similar": "SIMILAR", "reviewed": "REVIEWED"}
LABELS = {**NODE_LABELS, **EDGE_LABELS}
