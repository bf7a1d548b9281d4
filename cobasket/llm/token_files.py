"""Token ids as Parquet list columns.

A token file is a Parquet file with a row per document, in ascending key order over all files:

* ``doc_id`` and ``n_tokens`` (both ascending or small: delta encoding),
* ``ids`` (array<int>, a dictionary page per row group: the ids of a vocabulary below 65,536 take two bytes or less).

Row groups and pages are small and have page indexes, so a reader can fetch the token counts without the tokens, or the
tokens of a key range without the rest of the file. Everything is written by Spark's own Parquet writer and committer:
a lost task's half-written files never become visible, and any store that Spark writes to will do.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cobasket.llm.bpe_codec import Memo, WORD_PATTERN, byte_letters, laid_out
from cobasket.llm.common import coded_words, id_and_text, record_batch, slices

END_ID = 2
TOGETHER = 512  # pieces in a text that the library gets
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")  # one word, and nothing in it to normalise
ROW_GROUP_BYTES = 16 << 20
PAGE_ROWS = 512  # rows of a page at most: what a selective read fetches

WRITE_OPTIONS = {
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    "parquet.page.size": str(256 << 10),
    "parquet.writer.version": "PARQUET_2_0",  # delta encoding where a dictionary doesn't pay
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.dictionary.page.size": str(512 << 10),
    "compression": "zstd",
}

TOKENS = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])


@lru_cache(maxsize=2)
def library_memo(path: str) -> Memo:
    """The tokenizers library over distinct pieces of text between ASCII white space, which no token spans."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task a core already
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_padding()
    library.no_truncation()

    special = [t.content for t in library.get_added_tokens_decoder().values() if t.special and not (t.lstrip or t.rstrip)]
    plain = plain_words(path)

    def encode(pieces: list[bytes]) -> list[bytes]:
        """Plain words at little cost; of the others, many at a time, parted by a special token, which the library encodes
        by itself wherever it stands; those that hold the beginning of one, one by one."""
        known: dict[bytes, bytes] = {}
        if plain:
            words = [p for p in pieces if p.isalpha() and p.islower() or PLAIN.fullmatch(p)]
            known = dict(zip(words, plain(words)))
        rest = [p for p in pieces if p not in known]
        if special:
            first = special[-1][:2].encode()
            joint = [p for p in rest if first not in p]
            known |= zip(joint, together(joint, special[-1]))
            rest = [p for p in rest if first in p]
        known |= zip(rest, alone(rest))
        return [known[p] for p in pieces]

    def together(pieces: list[bytes], mark: str) -> list[bytes]:
        end, out = library.token_to_id(mark), []
        texts = [mark.join(p.decode() for p in pieces[at:at + TOGETHER]) + mark for at in range(0, len(pieces), TOGETHER)]
        for found in library.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(found.ids, "<u4")
            out += cut(ids, np.flatnonzero(ids == end), 1)
        return out

    def alone(pieces: list[bytes]) -> list[bytes]:
        found = library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    return Memo(encode)


def cut(ids: np.ndarray, stops: np.ndarray, skip: int = 0) -> list[bytes]:
    """The ids before each stop from behind the stop before on, without the ``skip`` ids from each stop on."""
    flat, begin, out = ids.tobytes(), 0, []
    for stop in (4 * stops).tolist():
        out.append(flat[begin:stop])
        begin = stop + 4 * skip
    return out


def plain_words(path: str) -> Callable[[list[bytes]], list[bytes]] | None:
    """The ids of words of lower-case ASCII and Latin-1 letters, for a file whose normaliser keeps and whose splitter doesn't
    part them: the library's model alone, behind its splitter at white space. The token that ends a word says so."""
    from tokenizers import Tokenizer, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    split = [(p["type"], p.get("pattern", {}).get("Regex")) for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    suffix = spec["model"].get("end_of_word_suffix")
    if kinds != ["NFC", "Replace", "Lowercase"] or split != [("Split", WORD_PATTERN), ("ByteLevel", None)] or not suffix:
        return None
    model = Tokenizer.from_file(path)
    model.no_padding()
    model.no_truncation()
    model.normalizer, model.pre_tokenizer = None, pre_tokenizers.WhitespaceSplit()
    ends = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
    ends[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
    letters = {b: ord(c) for b, c in enumerate(byte_letters())} | {32: 32}

    def encode(words: list[bytes]) -> list[bytes]:
        texts = [b" ".join(words[at:at + TOGETHER]).decode("latin-1").translate(letters)
                 for at in range(0, len(words), TOGETHER)]
        out = []
        for found in model.encode_batch_fast(texts, add_special_tokens=False):
            ids = np.array(found.ids, "<u4")
            out += cut(ids, np.flatnonzero(ends[ids]) + 1)
        return out

    return encode


def write_tokens(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", partitions: int | None = None) -> None:
    """Encode every text, append ``end_id``, and write token files under ``path``.

    Texts, which are smaller than their ids, are dealt out by ranges of the key and sorted by it; encoding follows in
    the same task, in order. A range holds about as many rows as any other, whatever the keys are. Rows with the same
    key stay, in the order of their texts; rows without a key come first. Null and empty texts get the end id alone. An empty
    table gives files without rows. Keys must be integers; other columns are not read.
    """
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = library_memo(tokenizer)
        for rows in slices(batches, "text"):
            sizes, codes, words = coded_words(rows.column("text"), "<|")  # special tokens have a case
            ids, sizes = laid_out(*memo.table(words, end_id), codes, sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(ids.view("<i4")))
            yield pa.record_batch([rows.column("id"), pa.array(sizes), lists], schema=TOKENS)

    rows = id_and_text(docs, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "id").sortWithinPartitions("id", "text")
    (dealt.mapInArrow(mapped, "id long, n_tokens long, ids array<int>").withColumnRenamed("id", id_col)
     .write.options(**WRITE_OPTIONS).parquet(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """All columns. Selecting the key and ``n_tokens`` alone leaves the token pages unread, and so does a key filter
    for the row groups and pages outside its range."""
    return spark.read.parquet(path)


CHECKED = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("file", pa.string()),
                     ("place", pa.int64())])


def summary(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: key, start (the number of ids in all documents before), n_tokens (of the list
    itself), ids_crc32 (of the ids as little-endian unsigned 32-bit integers).

    The sums of the files come first, from the column of counts alone, a row each; their running sum is the only window
    without partitions. Inside a file, which holds a range of keys of bounded size, counts add up in its order.
    """
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            values, at = lists.values.to_numpy(zero_copy_only=False).astype("<i4"), lists.offsets.to_numpy()
            yield record_batch(CHECKED, batch.column("id"), np.diff(at).astype(np.int64),
                               [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])], batch.column("file"),
                               batch.column("place"))

    file = F.input_file_name().alias("file")
    sums = tokens.select(F.col(id_col).alias("id"), "n_tokens", file).groupBy("file").agg(
        F.sum("n_tokens").alias("sum"), F.min("id").alias("low"), F.max("id").alias("high"))
    before = Window.orderBy(F.asc_nulls_first("low"), F.asc_nulls_first("high"), "file") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("file", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("offset"))
    rows = tokens.select(F.col(id_col).alias("id"), "ids", file, F.monotonically_increasing_id().alias("place")) \
        .mapInArrow(mapped, "id long, n_tokens long, ids_crc32 long, file string, place long")
    inside = Window.partitionBy("file").orderBy(F.asc_nulls_first("id"), "place") \
        .rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return within.join(offsets, "file").select(F.col("id").alias(id_col), (F.col("offset") + F.col("within"))
                                               .alias("start"), "n_tokens", "ids_crc32")
