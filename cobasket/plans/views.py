"""The engine's tables as views over an order database: reviews, products, categories, similar products, and raw text.

    reviews     one per line item; the rating comes from the quantity
    products    parts with review aggregates; some values missing or out of range on purpose
    belongs_to  type (twice, as from two category paths), brand and size of a part
    similar     parts that share an order twice or more
    listings    one text record per line item, with all the irregular cases of the format
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cobasket.operators.mining import frequent_pairs

SIMILAR_ORDERS = 2
FILE_RECORDS = 40_000  # text records in a file


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("product_id"),
        F.col("l_orderkey").alias("order_id"),
        (F.floor((F.col("l_quantity") - 1) / 10).cast("int") + 1).alias("rating"),
        F.col("o_orderdate").cast("date").cast("string").alias("date"),
        F.col("l_linenumber").alias("votes"), (F.col("l_linenumber") % 3).alias("helpful"))


def products(spark: SparkSession, sf_dir: str, reviewed: DataFrame) -> DataFrame:
    part = table(spark, sf_dir, "part")
    rated = reviewed.groupBy("product_id").agg(
        F.round(F.avg("rating"), 1).alias("avg_rating"), F.count("*").alias("total_reviews"))
    key = F.col("p_partkey")
    return part.join(rated, part.p_partkey == rated.product_id, "left").select(
        key.alias("asin"),
        F.when(key % 37 != 0, F.concat("p_name", F.lit(" "), key.cast("string"))).alias("title"),
        F.when(key % 41 != 0, F.col("p_type")).alias("product_group"),
        F.when(key % 29 == 0, F.lit(-1)).when(key % 31 == 0, F.lit(0))
        .otherwise((key * 7919 % 100000 + 1).cast("int")).alias("salesrank"),
        F.when(key % 43 != 0, F.col("avg_rating")).alias("avg_rating"),
        F.when(key % 43 != 0, F.col("total_reviews")).alias("total_reviews"))


def belongs_to(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    names = F.array("p_type", "p_brand", "p_type", F.concat(F.lit("Size "), F.col("p_size").cast("string")))
    return part.select(F.col("p_partkey").alias("product_id"), F.explode(names).alias("category"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"),
                                                   F.col("l_partkey").alias("product_id"))


def order_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands and sizes of the parts of each order, as items: few kinds, so real patterns at every scale."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.array(
        "p_brand", F.concat(F.lit("Size "), F.col("p_size").cast("string"))).alias("items"))
    return (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select(F.col("l_orderkey").alias("order_id"), F.explode("items").alias("product_id")))


def similar(order_rows: DataFrame) -> DataFrame:
    pairs = frequent_pairs(order_rows, SIMILAR_ORDERS, "order_id")
    return pairs.select(F.col("item1").alias("src"), F.col("item2").alias("dst"))


def listings(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Text records (``value``), one per line item, built row by row.

    By key of part, line and supplier: titles with a colon or missing, groups missing, sales ranks unreadable or
    missing, none to two similar products, category lines with an unnamed and an id-less part, counts of zero or too
    large, short summaries, a second review, a review that cannot be read, and CRLF line ends.

    ``dirty`` adds, by line: quotes, commas and backslashes in titles and categories; bytes in a title that are no
    UTF-8; an ``Id:`` and totals that cannot be read; and by supplier, junk without any field in front of a record.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                    "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    # Numbers alone are shuffled twice; the texts of a part come last.
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(part, lines.l_partkey == part.p_partkey)
    key, line, supplier = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_suppkey")
    rating = F.floor((F.col("l_quantity") - 1) / 10).cast("int") + 1

    def text(*parts) -> F.Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    title = F.when(key % 37 == 0, F.lit(None)).when(key % 5 == 0, text("  title: ", F.col("p_name"), ": vol ", key)) \
        .otherwise(text("  title: ", F.col("p_name"), " ", key))
    group = F.when(key % 41 != 0, text("  group: ", F.col("p_type")))
    rank = F.when(key % 29 == 0, F.lit("  salesrank: n/a")) \
        .when(key % 31 != 0, text("  salesrank: ", key * 7919 % 100000 + 1))
    similar_line = F.when(line % 3 == 0, F.lit("  similar: 0")) \
        .when(line % 3 == 1, text("  similar: 1  P", key + 1)) \
        .otherwise(text("  similar: 2  P", key + 1, "  P", key + supplier))
    path1 = text("   |", F.col("p_type"), "[1]|", F.col("p_brand"), "[2]", F.when(supplier % 4 == 0, F.lit("|[9]"))
                 .otherwise(F.lit("")))
    path2 = text("   |", F.col("p_type"), "[1]|loose|Size ", F.col("p_size"), "[3][x]")
    category_lines = F.when(line == 7, F.lit("  categories: 0")) \
        .when(line == 6, F.concat_ws("\n", F.lit("  categories: 50"), path1, path2)) \
        .otherwise(F.concat_ws("\n", F.lit("  categories: 2"), path1, path2))
    summary = F.when(line == 4, F.lit("  reviews: total: 9")) \
        .otherwise(text("  reviews: total: ", line, "  downloaded: 2  avg rating: ", rating))

    def review(date, customer, stars, votes) -> F.Column:
        return text("    ", date, "  cutomer: C", customer, "  rating: ", stars, "  votes: ", votes, "  helpful: ",
                    line % 3)

    first = review(F.date_format("o_orderdate", "yyyy-M-d"), F.col("o_custkey"), rating, line)
    second = F.when(supplier % 2 == 0, review(F.lit("2001-2-3"), F.col("o_custkey") + 1, 6 - rating, supplier))
    broken = F.when(supplier % 3 == 0, F.lit("    2000-1-1  cutomer: C1  rating: x  votes: 1  helpful: 0"))
    number = text("Id:   ", F.col("l_orderkey") * 10 + line)
    if dirty:
        quoted = text('  title: "', F.col("p_name"), '", \\ ', key, ' "')
        odd = text("  title: ", F.col("p_name"), F.unhex(F.lit("FFFE")).cast("string"), " ", key)
        title = F.when(line == 1, quoted).when(line == 2, odd).otherwise(title)
        category_lines = F.when(line == 1, F.concat_ws("\n", F.lit("  categories: 1"), text(
            '   |"', F.col("p_type"), '"[1]|a, "b" \\[2]'))).otherwise(category_lines)
        number = F.when(line == 3, F.lit("Id:   n/a")).otherwise(number)
        summary = F.when(line == 5, F.lit("  reviews: total: many  downloaded: 2  avg rating: 3")).otherwise(summary)
        number = F.when(supplier % 7 == 0, F.concat(F.lit("# dump\ntotal items: 12\n\n"), number)).otherwise(number)
    block = F.concat_ws("\n", number, text("ASIN: P", key), title, group, rank, similar_line, category_lines, summary,
                        first, broken, second)
    return rows.select(F.when(supplier % 5 == 0, F.replace(block, F.lit("\n"), F.lit("\r\n"))).otherwise(block)
                       .alias("value"))


def write_dirty_listings(spark: SparkSession, sf_dir: str, path: str) -> None:
    _write_text(listings(spark, sf_dir, dirty=True), path)


def write_listings(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the text records to files, a blank line after each."""
    _write_text(listings(spark, sf_dir), path)


def _write_text(records: DataFrame, path: str) -> None:
    """Compressed, as text takes some eight times the room else. Compressed files can't be split, so they are small: the
    reader deals out files instead."""
    records.write.options(lineSep="\n\n", compression="gzip", maxRecordsPerFile=FILE_RECORDS).text(path)
