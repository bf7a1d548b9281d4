"""What stages leave on disk: compressed text, no text that was parsed already, no shuffle files, no edges nobody reads."""

import gzip
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cobasket import session
from cobasket.plans import catalog, staging, views
from cobasket.sources import typed_csv
from conftest import tuples


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """300 lines of 60 orders of 20 parts."""
    folder = tmp_path_factory.mktemp("lines")
    spark.range(300).selectExpr("id % 60 AS l_orderkey", "CAST(id DIV 60 + 1 AS int) AS l_linenumber", "id * 7 % 20 AS l_partkey",
                                "id % 11 AS l_suppkey", "CAST(id % 50 + 1 AS double) AS l_quantity").write.parquet(
        f"{folder}/lineitem.parquet")
    spark.range(60).selectExpr("id AS o_orderkey", "id % 9 AS o_custkey", "timestamp'1998-02-06 00:00:00' AS o_orderdate") \
        .write.parquet(f"{folder}/orders.parquet")
    spark.range(20).selectExpr("id AS p_partkey", "concat('part ', id) AS p_name", "concat('TYPE', id % 3) AS p_type",
                               "concat('Brand#', id % 4) AS p_brand", "CAST(id % 5 AS int) AS p_size").write.parquet(
        f"{folder}/part.parquet")
    return str(folder)


@pytest.fixture
def stages(spark):
    """The folders that a test has written below the shared one, by stage."""
    staging.clean_up(spark)
    root = Path(session.shared_dir(spark).removeprefix("file:"))
    before = set(root.iterdir())

    def found():
        return {re.sub("-[0-9a-f]{32}$", "", p.name): p for p in set(root.iterdir()) - before}

    yield found
    staging.clean_up(spark)


def test_text_is_compressed_in_files_of_bounded_size(spark, lines, tmp_path, monkeypatch):
    monkeypatch.setattr(views, "FILE_RECORDS", 50)
    views.write_listings(spark, lines, f"{tmp_path}/text")
    files = list((tmp_path / "text").glob("part-*.gz"))
    records = [gzip.open(f, "rt", newline="").read().count("Id:   ") for f in files]
    assert sum(records) == 300 and max(records) <= 50
    assert views.listings(spark, lines).count() == 300
    plain = views.listings(spark, lines)
    plain.write.option("lineSep", "\n\n").text(f"{tmp_path}/plain")
    one, two = [tuples(staging.read_records(spark, f"{tmp_path}/{name}")) for name in ("text", "plain")]
    assert one == two and len(one) == 300


@pytest.mark.parametrize("name", ["norm_customers", "norm_belongs_to", "clean_products", "clean_customers", "merge_categories"])
def test_parsed_text_makes_room(spark, lines, stages, name):
    assert catalog.queries()[name](spark, lines).count() > 0
    assert "records" in stages() and not {"raw", "listings"} & set(stages())


@pytest.mark.parametrize("name", ["parse_counts", "parse_rejects", "parse_dirty"])
def test_dirty_text_makes_room(spark, lines, stages, name):
    assert catalog.queries()[name](spark, lines).count() > 0
    assert "parsed_dirty" in stages() and "dirty" not in stages()


def test_text_that_a_query_reads_stays(spark, lines, stages):
    first = catalog.queries()["parse_products"](spark, lines)
    assert staging.records(spark, lines).count() == first.count() == 300 and "raw" in stages()


@pytest.mark.parametrize("name", ["clean_similar", "clean_reviews", "clean_belongs_to", "clean_rejects", "load_products"])
def test_edges_that_are_not_read_are_not_written(spark, lines, stages, name):
    assert catalog.queries()[name](spark, lines).count() > 0
    assert "clean_products" in stages() and not {"clean_belongs_to", "clean_similar", "clean_reviewed"} & set(stages())


@pytest.mark.parametrize("name", ["load_products_defaults", "load_products_nulls", "read_typed_csv", "write_graph_csv"])
def test_clean_csv_is_compressed(spark, lines, stages, name):
    assert catalog.queries()[name](spark, lines).count() > 0
    assert not list(stages()["csv"].rglob("part-*.csv")) and len(list(stages()["csv"].rglob("part-*.csv.gz"))) >= 6
    assert "clean_reviewed" not in stages()
    assert tuples(staging.csv(spark, lines).reviewed) == tuples(staging.cleaned(spark, lines).reviewed)


@pytest.mark.parametrize("name", ["dirty_products_csv", "dirty_categories_csv"])
def test_dirty_csv_is_compressed(spark, lines, stages, name):
    assert catalog.queries()[name](spark, lines).count() > 0
    assert not list(stages()["dirty_csv"].rglob("part-*.csv")) and "dirty" not in stages()


def test_snapshots_are_compared_without_the_text(spark, lines, stages):
    assert {r.label for r in catalog.queries()["compare_snapshots"](spark, lines).collect()} >= {"Product", "REVIEWED"}
    assert {"clean_reviewed", "records"} <= set(stages()) and not {"raw", "listings"} & set(stages())


def test_csv_files_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(typed_csv, "FILE_ROWS", 10)
    frame = spark.range(95).select(F.concat(F.lit('c "'), "id").alias("customer_id")).coalesce(1)
    typed_csv.write_typed_csv(frame, "customers", f"{tmp_path}/c", "gzip")
    assert len(list((tmp_path / "c").glob("part-*.csv.gz"))) == 10
    assert tuples(typed_csv.read_typed_csv(spark, f"{tmp_path}/c", "customers")) == tuples(frame)


def test_shuffle_files_go_with_the_write(spark):
    def files():
        local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {local.apply(i).getName() for i in range(local.size()) if local.apply(i).getName().startswith("shuffle_")}

    held, before = files(), spark.conf.get(session.SHUFFLE_CLEANUP, None)
    table = session.stored(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert not files() - held and table.count() == 7
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
    with session.shuffle_files_removed(spark), session.shuffle_files_removed(spark):
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before
