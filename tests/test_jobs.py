"""Whole jobs on a small text."""

import random

import pytest

from cobasket.operators import load
from cobasket.plans import jobs
from cobasket.sources import patterns as files, tables, typed_csv
from conftest import tuples


def text_of(seed=5, products=12, customers=40):
    rng = random.Random(seed)
    blocks = []
    for i in range(products):
        bought = rng.sample(range(customers), rng.randrange(5, 30))
        lines = [f"Id:   {i}", f"ASIN: P{i:02}", f'  title: Product "{i}", vol: {i}', "  group: Book",
                 f"  salesrank: {i * 10}", f"  similar: 2  P{(i + 1) % products:02}  Q{i}", "  categories: 1",
                 f"   |Books[1]|Shelf {i % 3}[2]",
                 f"  reviews: total: {len(bought)}  downloaded: {len(bought)}  avg rating: 4.5"]
        lines += [f"    2001-{c % 12 + 1}-{i + 1}  cutomer: C{c:02}  rating: {c % 5 + 1}  votes: 1  helpful: 0"
                  for c in bought]
        blocks.append("\n".join(lines))
    return "# header\nTotal items: 12\n\n" + "\n\n".join(blocks)


@pytest.fixture(scope="module")
def graph(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("ingest")
    (folder / "text").mkdir()
    (folder / "text" / "products.txt").write_text(text_of())
    return jobs.ingest(spark, str(folder / "text"), str(folder / "out"), csv=True), folder / "out"


def test_ingest(spark, graph):
    stored, out = graph
    counts = dict(tuples(load.verify_counts(stored)))
    assert counts["Product"] == 12 and counts["Category"] == 4 and counts["SIMILAR"] == 12
    assert counts["BELONGS_TO"] == 24
    assert stored.products.filter("asin = 'P03'").collect()[0].title == 'Product "3", vol: 3'
    again = jobs.load_csv(spark, str(out / "csv"), str(out / "from_csv"))
    assert all(r.same_rows for r in load.compare_snapshots(stored, again).collect())


def test_mine_patterns(spark, graph, tmp_path):
    stored, _ = graph
    metadata = jobs.mine_patterns(stored, str(tmp_path / "p"), min_count=4).collect()[0]
    served = files.read_patterns(spark, str(tmp_path / "p")).collect()
    assert metadata.total_patterns == len(served) > 5
    served.sort(key=lambda r: r["rank"])
    assert [r["rank"] for r in served] == list(range(1, len(served) + 1))
    assert all(a.support >= b.support for a, b in zip(served, served[1:]))
    assert all(1 <= len(r.sample_customers) <= 10 for r in served)
    assert jobs.mine_patterns(stored, str(tmp_path / "q"), min_support=0.99).collect()[0].total_patterns == 0


def test_mine_validated(spark, graph, tmp_path):
    stored, _ = graph
    found = jobs.mine_validated(stored, str(tmp_path / "v"), min_count=2, min_test_support=1).collect()
    assert found and all(r.total_support == r.train_support + r.test_support for r in found)
    stats = spark.read.json(str(tmp_path / "v" / "stats")).collect()[0]
    assert stats.num_patterns == len(found)
    assert stats.total_reviews == tables.scan_reviews(stored.reviewed).count()
    assert spark.read.json(str(tmp_path / "v" / "patterns")).count() == len(found)
    assert spark.read.json(str(tmp_path / "v" / "rules")).count() > 0


def test_headers_cover_every_table(graph):
    stored, _ = graph
    for name, table in stored.tables().items():
        assert list(typed_csv.HEADERS[name]) == table.columns
