"""Product records in block-structured text.

    Id:   1
    ASIN: K100000001
      title: Knots: A Handbook
      group: Garden
      salesrank: 8041
      similar: 2  K200000002  K300000003
      categories: 1
       |Tools[51]|Sailing[7]
      reviews: total: 1  downloaded: 1  avg rating: 3
        2011-3-5  cutomer: K71  rating: 3  votes: 14  helpful: 2

A blank line ends a record. Spark splits the file before each line that starts with ``Id:``, so a file of any size is
read in parallel; each row is then cut at its blank lines, which leaves one block per record. Fields are read from a
block's text by regular expressions, which Spark compiles once per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The words that start a field line, and those that mark the values of a review line.
FIELD_KEYS = ["Id:", "ASIN:", "title:", "group:", "salesrank:", "similar:", "categories:", "reviews:"]
REVIEW_KEYS = ["cutomer:", "rating:", "votes:", "helpful:"]

RECORD_SEPARATOR = "\nId:"

_BLANK = "[^\\S\\n]"  # white space within a line
_STARTS_FIELD = f"{_BLANK}*+(?:{'|'.join(FIELD_KEYS)})"
# A field line without the white space around it.
_FIELD_LINE = f"(?Um)^{_BLANK}*+((?:{'|'.join(FIELD_KEYS)})(?:[^\\n]*\\S)?)"
# The parts of a category line that hold an opening and a closing bracket; the name ends at the first opening one.
_CATEGORY_NAME = "(?U)\\|(?=[^|]*\\])\\s*([^|\\[]*?)\\s*\\["


_NUMBER = "([+-]?\\d+)"
_MARK = "\x01"  # starts a review line that was rewritten to its values
_VALUES = f"{_MARK}$1\t$2\t$3\t$4\t$5"


def _ordered_review() -> str:
    """A review line with its values in the usual order, read from left to right."""
    numbers = "".join(f"{_BLANK}+{key}{_BLANK}+{_NUMBER}" for key in REVIEW_KEYS[1:])
    return f"(?Um)^{_BLANK}*+([^\\s:]+){_BLANK}+{REVIEW_KEYS[0]}{_BLANK}+([^\\s:]+){numbers}(?!\\S)[^\\n]*"


def _any_review() -> str:
    """Any review line: its first token, and the token after each keyword wherever that stands in the line.

    The atomic group settles on the first place of a keyword; numbers that are none make the line fail.
    """
    values = {key: _NUMBER for key in REVIEW_KEYS} | {REVIEW_KEYS[0]: "(\\S+)"}
    ahead = [f"(?=(?>(?:[^\\n]*?{_BLANK})??{key}{_BLANK}+){value}(?!\\S))" for key, value in values.items()]
    return f"(?Um)^(?!{_MARK}|{_STARTS_FIELD}){_BLANK}*+(?=(\\S+)){''.join(ahead)}[^\\n]+"


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """One row (``value``, ``file``) per stretch of text between two ``Id:`` line starts; undecodable bytes are left
    out."""
    raw = spark.read.option("lineSep", RECORD_SEPARATOR).text(path)
    readable = F.regexp_replace(F.make_valid_utf8("value"), "\ufffd", "")
    return raw.select(F.when(F.is_valid_utf8("value"), F.col("value")).otherwise(readable).alias("value"),
                      F.input_file_name().alias("file"))


def all_blocks(chunks: DataFrame) -> DataFrame:
    """One row (``file``, ``block``) per block of text: lines without a blank one between them, ended by a line feed each.

    The text source takes the ``Id:`` off every chunk but a file's first, so it is put back in front of a chunk that
    starts with a number, or that names a product further down. Blocks of white space alone are left out.
    """
    text = F.replace(F.replace("value", F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    parts = chunks.select("file", F.posexplode(F.split(text, "(?U)\\n\\s*\\n")).alias("_at", "_part"))
    lacks_id = (F.col("_at") == 0) & F.col("_part").rlike(f"(?s)^(?!{_STARTS_FIELD})\\s*(?:[+-]?\\d|.*\\n\\s*ASIN:)")
    blocks = parts.select("file", F.when(lacks_id, F.concat(F.lit("Id:"), "_part")).otherwise(F.col("_part"))
                          .alias("block"))
    return blocks.filter(F.col("block").rlike("(?U)\\S"))


def _is_record() -> Column:
    return F.col("block").rlike(f"(?m)^{_STARTS_FIELD}")


def split_blocks(chunks: DataFrame) -> DataFrame:
    """The blocks (``block``) with a field line: one per record."""
    return all_blocks(chunks).filter(_is_record()).select("block")


def _line(key: str) -> Column:
    """The last field line that starts with ``key``, or null."""
    return F.try_element_at(F.filter("_fields", lambda line: line.startswith(key)), F.lit(-1))


def _tokens(line: Column) -> Column:
    return F.split(F.regexp_replace(line, "(?U)\\s+", " "), " ")


def _second_part(line: Column) -> Column:
    """Text between the first and the second colon, without the white space around it."""
    return F.regexp_extract(line, "(?U)^[^:]*:\\s*([^:]*?)\\s*(?::|$)", 1)


def _rewritten_reviews() -> Column:
    """The lines that name a customer, those in the usual order rewritten to their values."""
    lines = F.filter(F.split("_body", "\n"), lambda line: line.contains(REVIEW_KEYS[0]))
    return F.regexp_replace(F.array_join(lines, "\n"), _ordered_review(), _VALUES)


def _review_lines() -> Column:
    """The lines that name a customer: those that can be read in full begin with the mark. Lines that are not rewritten
    yet are looked at once more; what then still has no mark cannot be read."""
    rest = F.col("_rewritten").rlike(f"(?m)^[^{_MARK}]")
    return F.split(F.when(rest, F.regexp_replace("_rewritten", _any_review(), _VALUES)).otherwise(F.col("_rewritten")),
                   "\n")


def _reviews() -> Column:
    """Review lines that can be read in full, as an array of structs."""

    def review(text: Column) -> Column:
        value = F.split(text, "\t")
        return F.struct(F.substring(F.get(value, F.lit(0)), 2, 1 << 30).alias("date"),
                        F.get(value, F.lit(1)).alias("customer"),
                        *[F.get(value, F.lit(i)).try_cast("int").alias(name)
                          for i, name in enumerate(("rating", "votes", "helpful"), 2)])

    return F.transform(F.filter(_review_lines(), lambda text: text.startswith(_MARK)), review)


# Why something of the text was not taken over.
NO_FIELD, BAD_ID, BAD_TOTALS, BAD_REVIEW = "no field line", "unreadable id", "unreadable totals", "unreadable review line"


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, "(?U)^\\s+|\\s+$", "")


def _rejects() -> Column:
    """What of a record could not be read: its number, its totals (the field is null then), review lines (left out)."""
    def reject(reason: str, text: Column) -> Column:
        return F.struct(F.lit(reason).alias("reason"), _stripped(text).alias("text"))

    def one(found: Column, reason: str, text: Column) -> Column:
        return F.when(found, F.array(reject(reason, text))).otherwise(
            F.array().cast("array<struct<reason:string,text:string>>"))

    number, summary = _line("Id:"), _line("reviews:")
    values = [F.get("_summary", F.lit(at)).try_cast(kind) for at, kind in ((2, "int"), (4, "int"), (7, "double"))]
    lines = F.filter(_review_lines(), lambda text: ~text.startswith(_MARK) & (text != ""))
    return F.concat(one(number.isNotNull() & _second_part(number).try_cast("bigint").isNull(), BAD_ID, number),
                    one((F.size("_summary") >= 8) & (values[0].isNull() | values[1].isNull() | values[2].isNull()),
                        BAD_TOTALS, summary),
                    F.transform(lines, lambda text: reject(BAD_REVIEW, text)))


def parse_blocks(blocks: DataFrame, *more: Column) -> DataFrame:
    """Blocks of text to records; other columns of ``blocks`` that are wanted, and expressions over the lines found, can
    be given.

    The ``n`` lines after a ``categories: n`` header belong to it whatever they hold. When the block has fewer, the
    header takes all of them and the record has no categories.
    """
    # 1. Set the category lines apart.
    header = F.nullif(F.regexp_extract("block", f"(?m)^{_BLANK}*+categories:[^\\n]*", 0), F.lit(""))
    kept = [c for c in blocks.columns if c != "block"]
    df = blocks.select(*kept, "block", header.alias("_header"), F.split("block", "\n").alias("_lines"))
    count = F.greatest(F.coalesce(_second_part(F.col("_header")).try_cast("int"), F.lit(0)), F.lit(0))
    df = df.select(*kept, "block", "_header", "_lines",
                   F.array_position("_lines", F.col("_header")).cast("int").alias("_at"),
                   F.least(count, F.size("_lines")).alias("_count"))
    rest = F.concat(F.slice("_lines", F.lit(1), F.col("_at")),
                    F.slice("_lines", F.col("_at") + F.col("_count") + 1, F.size("_lines")))
    df = df.select(*kept, "_header", "_count", F.slice("_lines", F.col("_at") + 1, F.col("_count")).alias("_paths"),
                   F.when(F.col("_count") > 0, F.array_join(rest, "\n")).otherwise(F.col("block")).alias("_body"))

    # 2. Find the line of each field once.
    df = df.withColumns({"_fields": F.regexp_extract_all("_body", F.lit(_FIELD_LINE), F.lit(1)),
                         "_rewritten": _rewritten_reviews()})
    df = df.withColumns({"_listed": _tokens(_line("similar:")), "_summary": _tokens(_line("reviews:")),
                         "_title": _line("title:"), "_rank": _line("salesrank:")})

    # 3. Read the values.
    def total(token: int, kind: str) -> Column:
        value = F.get("_summary", F.lit(token)).try_cast(kind)
        return F.when(F.size("_summary") >= 8, value).when(F.col("_summary").isNotNull(), F.lit(0).cast(kind))

    names = F.transform("_paths", lambda line: F.regexp_extract_all(line, F.lit(_CATEGORY_NAME), F.lit(1)))
    categories = F.when(F.size("_paths") >= F.col("_count"), F.filter(names, lambda path: F.size(path) > 0))
    return df.select(
        _second_part(_line("Id:")).try_cast("bigint").alias("id"),
        _second_part(_line("ASIN:")).alias("asin"),
        F.regexp_replace("_title", "(?U)^title:\\s*", "").alias("title"),
        _second_part(_line("group:")).alias("product_group"),
        F.when(F.col("_rank").isNotNull(),
               F.coalesce(_second_part(F.col("_rank")).try_cast("bigint"), F.lit(0))).alias("salesrank"),
        F.slice("_listed", F.lit(3), F.size("_listed")).alias("similar"),
        F.when(F.col("_header").isNotNull(), categories).alias("categories"),
        total(2, "int").alias("total_reviews"),
        total(4, "int").alias("downloaded_reviews"),
        total(7, "double").alias("avg_rating"),
        _reviews().alias("reviews"), *more
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Parse a text file, or a folder of them, into one row per product record."""
    return parse_blocks(split_blocks(read_chunks(spark, path)))


def parse_text(spark: SparkSession, path: str) -> DataFrame:
    """Everything that one pass over the text gives: the columns of a record, and ``file``, ``is_record``, ``rejects``
    (array of reason and text). A block without any field line is no record, and its own reject.

    Records and rejects account for the whole text: every block is a record or a reject, and every line that names a
    customer, in a record, is one of its reviews or one of its rejects.
    """
    blocks = all_blocks(read_chunks(spark, path)).withColumns({
        "is_record": _is_record(), "_junk": F.when(~_is_record(), _stripped(F.col("block")))})
    junk = F.array(F.struct(F.lit(NO_FIELD).alias("reason"), F.col("_junk").alias("text")))
    rejects = F.when(F.col("is_record"), _rejects()).otherwise(junk)
    return parse_blocks(blocks, F.col("file"), F.col("is_record"), rejects.alias("rejects"))


def records_of(parsed: DataFrame) -> DataFrame:
    """The records of :func:`parse_text`, as :func:`read_records` gives them."""
    return parsed.filter("is_record").drop("file", "is_record", "rejects")


def rejects_of(parsed: DataFrame) -> DataFrame:
    """The rejects of :func:`parse_text`: file, id and asin of the record (null for a block that is none), reason, text."""
    return parsed.filter(F.size("rejects") > 0).select("file", "id", "asin", F.inline("rejects"))


def parse_counts(parsed: DataFrame) -> DataFrame:
    """How much of the text was taken over and how much was not: reason (null for what was), part (block, review line or
    field), n_rows."""
    parts = F.array(
        F.struct(F.lit("block").alias("part"), F.when(~F.col("is_record"), F.lit(NO_FIELD)).alias("reason"),
                 F.lit(1).cast("bigint").alias("n")),
        F.struct(F.lit("review line").alias("part"), F.lit(None).cast("string").alias("reason"),
                 F.when(F.col("is_record"), F.size("reviews")).otherwise(0).cast("bigint").alias("n")))
    lost = F.transform(F.filter("rejects", lambda r: r["reason"] != NO_FIELD), lambda r: F.struct(
        F.when(r["reason"] == BAD_REVIEW, F.lit("review line")).otherwise(F.lit("field")).alias("part"),
        r["reason"].alias("reason"), F.lit(1).cast("bigint").alias("n")))
    return (parsed.select(F.inline(F.concat(parts, lost))).groupBy("part", "reason").agg(F.sum("n").alias("n_rows"))
            .filter("n_rows > 0"))
