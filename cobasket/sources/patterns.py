"""Served patterns: a Parquet table in the order of their ranks to read from, and JSON lines with a one-row metadata table
as an export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cobasket.schemas import PATTERN

# Fixed value: the time format of the metadata row.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def write_patterns(patterns: DataFrame, path: str, algorithm: str | None = None) -> None:
    """Write ``path/patterns`` (one JSON object per line, any number of files) and ``path/metadata``, with the name of
    the method that found them."""
    patterns.write.mode("overwrite").json(f"{path}/patterns")
    written = read_patterns(patterns.sparkSession, path)
    metadata = written.agg(
        F.date_format(F.current_timestamp(), TIME_FORMAT).alias("generated_at"),
        F.count("*").alias("total_patterns"),
        F.lit(algorithm).cast("string").alias("algorithm"),
    )
    metadata.write.mode("overwrite").json(f"{path}/metadata")


def read_patterns(spark: SparkSession, path: str, schema: str = PATTERN) -> DataFrame:
    return spark.read.schema(schema).json(f"{path}/patterns")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("generated_at string, total_patterns bigint, algorithm string").json(f"{path}/metadata")


def write_results(stats: DataFrame, patterns: DataFrame, path: str, rules: DataFrame | None = None) -> None:
    """Write the validated patterns of a run, its one-row statistics, and its rules if given."""
    if rules is not None:
        rules.write.mode("overwrite").json(f"{path}/rules")
    patterns.write.mode("overwrite").json(f"{path}/patterns")
    stats.write.mode("overwrite").json(f"{path}/stats")


# Small row groups and pages: what a reader of some ranks fetches.
RANKED_OPTIONS = {"parquet.block.size": str(4 << 20), "parquet.page.row.count.limit": "1000"}


def write_ranked(patterns: DataFrame, path: str) -> None:
    """Write ``path/ranked``: ranges of ranks, sorted, so that the statistics of files, row groups and pages tell a reader
    which of them hold the ranks it wants."""
    (patterns.repartitionByRange("rank").sortWithinPartitions("rank").write.mode("overwrite")
     .options(**RANKED_OPTIONS).parquet(f"{path}/ranked"))


def read_ranked(spark: SparkSession, path: str, schema: str = PATTERN) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{path}/ranked")
