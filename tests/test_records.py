"""The text format, irregular cases included."""

import pytest

from cobasket.sources import records
from cobasket.sources.records import read_records

FULL = """Id:   1
ASIN: K100000001
  title: Knots: A Handbook
  group: Garden
  salesrank: 8041
  similar: 2  K200000002  K300000003
  categories: 2
   |Tools[51]|Ropes[520]|Sailing[7]
   |Tools[51]|Ropes[520]|Climbing[8]
  reviews: total: 2  downloaded: 2  avg rating: 3.5
    2011-3-5  cutomer: K71  rating: 3  votes:   14  helpful:   2
    2012-10-30  cutomer: K72  rating: 4  votes:   3  helpful:   1
"""


@pytest.fixture
def parse(spark, tmp_path):
    def run(text, *more):
        for i, content in enumerate((text, *more)):
            data = content if isinstance(content, bytes) else content.encode()
            (tmp_path / f"part-{i}.txt").write_bytes(data)
        rows = [row.asDict(recursive=True) for row in read_records(spark, str(tmp_path)).collect()]
        return sorted(rows, key=lambda r: (r["id"] is None, r["id"] or 0, r["asin"] or ""))
    return run


def block(*lines, id=1):
    return "\n".join([f"Id:   {id}", "ASIN: A", *lines]) + "\n"


def test_full_record(parse):
    assert parse(FULL) == [{
        "id": 1, "asin": "K100000001", "title": "Knots: A Handbook", "product_group": "Garden", "salesrank": 8041,
        "similar": ["K200000002", "K300000003"],
        "categories": [["Tools", "Ropes", "Sailing"], ["Tools", "Ropes", "Climbing"]],
        "total_reviews": 2, "downloaded_reviews": 2, "avg_rating": 3.5,
        "reviews": [{"date": "2011-3-5", "customer": "K71", "rating": 3, "votes": 14, "helpful": 2},
                    {"date": "2012-10-30", "customer": "K72", "rating": 4, "votes": 3, "helpful": 1}]}]


def test_numbers_of_any_length(parse):
    """A number beyond the type is null; its review stays."""
    found = parse(block("  reviews: total: 2  downloaded: 2  avg rating: 4",
                        "    2001-1-1  cutomer: A  rating: 5  votes: 2147483647  helpful: 0",
                        "    2001-1-2  cutomer: B  rating: 5  votes: 12345678901  helpful: 1"))[0]["reviews"]
    assert [(r["customer"], r["votes"], r["helpful"]) for r in found] == [("A", 2147483647, 0), ("B", None, 1)]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_are_split_at_blank_lines(parse, newline):
    text = "# Full information\nTotal items: 3\n\n" + FULL + "\n\n  \nId:   2\nASIN: 2\n  discontinued product\n\nId: 3\nASIN: 3"
    found = parse(text.replace("\n", newline))
    assert [r["id"] for r in found] == [1, 2, 3]
    assert found[0] == parse(FULL)[0] or found[0]["asin"] == "K100000001"
    assert len(found[0]["reviews"]) == 2 and found[0]["categories"][1][-1] == "Climbing"


def test_bare_record(parse):
    row = parse("Id:   2\nASIN: 0000000002\n  discontinued product\n")[0]
    assert row["asin"] == "0000000002" and row["reviews"] == []
    assert all(row[c] is None for c in row if c not in ("id", "asin", "reviews"))


def test_every_file_has_its_own_first_record(parse):
    assert [r["id"] for r in parse("Id: 1\nASIN: A\n", "Id: 2\nASIN: B\n\nId: 3\nASIN: C\n")] == [1, 2, 3]


def test_block_without_id_is_a_record_of_its_own(parse):
    found = parse("Id: 1\nASIN: A\n\nASIN: B\n\nId: 3\nASIN: C\n")
    assert [(r["id"], r["asin"]) for r in found] == [(1, "A"), (3, "C"), (None, "B")]


def test_unreadable_id_is_null(parse):
    found = parse("Id: 1\nASIN: A\n\nId: x2\nASIN: B\n")
    assert [(r["id"], r["asin"]) for r in found] == [(1, "A"), (None, "B")]


@pytest.mark.parametrize("line, column, value", [
    ("title: a: b", "title", "a: b"),
    ("title:   padded  \t", "title", "padded"),
    ("title:  wide　", "title", "wide"),
    ("title:", "title", ""),
    ("group: a: b", "product_group", "a"),
    ("salesrank: x", "salesrank", 0),
    ("salesrank: -1", "salesrank", -1),
    ("similar: 0", "similar", []),
    ("similar: 2  B  C", "similar", ["B", "C"]),
    ("similar: 1\tB", "similar", ["B"]),
    ("categories: 0", "categories", []),
    ("categories: many", "categories", []),
    ("reviews: total: 4", "total_reviews", 0),
    ("reviews: total: 4", "avg_rating", 0.0),
    ("reviews: total: x  downloaded: 2  avg rating: 5", "total_reviews", None),
    ("reviews: total: 3  downloaded: 2  avg rating: 5", "downloaded_reviews", 2),
])
def test_field(parse, line, column, value):
    assert parse(block(line))[0][column] == value


def test_asin_ends_at_its_second_colon(parse):
    assert parse("Id: 1\nASIN: a: b\n")[0]["asin"] == "a"


def test_last_of_repeated_fields_counts(parse):
    assert parse(block("title: one", "title: two"))[0]["title"] == "two"


@pytest.mark.parametrize("lines, paths", [
    (["categories: 1", "|a[1]|loose|b[2]"], [["a", "b"]]),
    (["categories: 1", "|[265523]|b[2]"], [["", "b"]]),
    (["categories: 1", "|guitar[x][9]| spaced [3]"], [["guitar", "spaced"]]),
    (["categories: 1", "|only loose|parts"], []),
    (["categories: 2", "no bars", "|b[2]"], [["b"]]),
    (["categories: 1", "before[1]|b[2]"], [["b"]]),
    (["categories: 3", "|a[1]"], None),
])
def test_categories(parse, lines, paths):
    assert parse(block(*lines))[0]["categories"] == paths


def test_large_category_count_takes_the_lines_after_it(parse):
    row = parse(block("categories: 3", "|a[1]", "title: taken", "reviews: total: 1  downloaded: 1  avg rating: 5",
                      "title: kept"))[0]
    assert row["categories"] == [["a"]] and row["title"] == "kept" and row["total_reviews"] is None


def test_category_line_that_looks_like_a_review_is_none(parse):
    assert parse(block("categories: 1", "2000-1-1 cutomer: C rating: 5 votes: 1 helpful: 1"))[0]["reviews"] == []


@pytest.mark.parametrize("line", [
    "2000-1-1  cutomer: C  rating: 5  helpful: 1",
    "2000-1-1  cutomer: C  rating: x  votes: 1  helpful: 1",
    "2000-1-1  cutomer: C  rating: 5.5  votes: 1  helpful: 1",
    "2000-1-1  cutomer:C  rating: 5  votes: 1  helpful: 1",
    "2000-1-1  cutomer: C  rating: 5  votes: 1  helpful:",
    "2000-1-1  customer: C  rating: 5  votes: 1  helpful: 1",
    "title: cutomer: C  rating: 5  votes: 1  helpful: 1",
])
def test_malformed_review_is_left_out(parse, line):
    good = "2001-1-1  cutomer: D  rating: 4  votes: 2  helpful: 3"
    assert [r["customer"] for r in parse(block(line, good))[0]["reviews"]] == ["D"]


def test_review_values_are_found_by_keyword(parse):
    row = parse(block("2000-1-1  helpful: 3  votes: 2  rating: 4  cutomer: C  more"))[0]
    assert row["reviews"] == [{"date": "2000-1-1", "customer": "C", "rating": 4, "votes": 2, "helpful": 3}]


def test_repeated_reviews_are_kept(parse):
    line = "2000-1-1  cutomer: C  rating: 4  votes: 1  helpful: 1"
    assert len(parse(block(line, line))[0]["reviews"]) == 2


def test_undecodable_bytes_are_left_out(parse):
    assert parse(b"Id: 1\nASIN: A\n  title: a\xffb\xfe\n")[0]["title"] == "ab"


def test_replacement_character_of_valid_text_is_kept(parse):
    assert parse("Id: 1\nASIN: A\n  title: a�b\n")[0]["title"] == "a�b"


def test_long_record(parse):
    lines = [f"2000-1-{i % 28 + 1}  cutomer: C{i}  rating: {i % 5 + 1}  votes: {i}  helpful: 0" for i in range(20000)]
    row = parse(block("reviews: total: 20000  downloaded: 20000  avg rating: 3", *lines))[0]
    assert len(row["reviews"]) == 20000 and row["reviews"][-1]["customer"] == "C19999"


def test_review_lines_of_any_order_keep_their_place(parse):
    lines = ["2000-1-1  cutomer: C1  rating: 1  votes: 2  helpful: 3",
             "2000-1-2  rating: 2  cutomer: C:2  votes: 3  helpful: 4",
             "2000-1-3  cutomer: rating:  rating: 5  votes: 1  helpful: 1",
             "2000-1-4  cutomer: C4  rating: 4  votes: 5  helpful: 6  trailing: 7"]
    found = [tuple(r.values()) for r in parse(block(*lines))[0]["reviews"]]
    assert found == [("2000-1-1", "C1", 1, 2, 3), ("2000-1-2", "C:2", 2, 3, 4), ("2000-1-4", "C4", 4, 5, 6)]


def test_rejects_and_records_account_for_all_blocks_and_review_lines(spark, tmp_path):
    review = "    2001-1-2  cutomer: K{}  rating: {}  votes: 1  helpful: 0"
    first = "\n".join([
        "# dump of 2005", "total items: 3", "", "Id:   1", "ASIN: A", "  reviews: total: x  downloaded: 1  avg rating: 2",
        review.format(1, 5), review.format(2, "five"), "", "Id:   n/a", "ASIN: B", "  categories: 2", "   |a[1]", "   |b[2]",
        review.format(3, 4), "    2001-1-2  cutomer:", "", "Id:   3", "  discontinued product", ""])
    (tmp_path / "one.txt").write_text(first)
    (tmp_path / "two.txt").write_bytes(("just words\r\n\r\nASIN: C\r\n  reviews: total: 1\r\n" + review.format(4, 1)).encode()
                                       + b"\xff\xfe\r\n\r\n \r\n" + "ïd: 3".encode())
    parsed = records.parse_text(spark, str(tmp_path)).cache()
    found = sorted((r.file.rpartition("/")[2], r.id, r.asin, r.reason, r.text) for r in records.rejects_of(parsed).fillna(
        {"id": -1, "asin": ""}).collect())
    assert found == sorted([
        ("one.txt", -1, "", "no field line", "# dump of 2005\ntotal items: 3"),
        ("one.txt", 1, "A", "unreadable totals", "reviews: total: x  downloaded: 1  avg rating: 2"),
        ("one.txt", 1, "A", "unreadable review line", review.format(2, "five").strip()),
        ("one.txt", -1, "B", "unreadable id", "Id:   n/a"),
        ("one.txt", -1, "B", "unreadable review line", "2001-1-2  cutomer:"),
        ("two.txt", -1, "", "no field line", "just words"), ("two.txt", -1, "", "no field line", "ïd: 3")])
    counts = {(r.part, r.reason): r.n_rows for r in records.parse_counts(parsed).collect()}
    assert counts == {("block", None): 4, ("block", "no field line"): 3, ("review line", None): 3,
                      ("review line", "unreadable review line"): 2, ("field", "unreadable id"): 1,
                      ("field", "unreadable totals"): 1}
    assert records.records_of(parsed).exceptAll(read_records(spark, str(tmp_path))).isEmpty()
    assert records.records_of(parsed).count() == read_records(spark, str(tmp_path)).count() == 4
    parsed.unpersist()


def test_no_text_no_rejects(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    parsed = records.parse_text(spark, str(tmp_path))
    assert records.rejects_of(parsed).isEmpty() and records.parse_counts(parsed).isEmpty()
