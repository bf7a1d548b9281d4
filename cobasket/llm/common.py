"""What the operators share: narrow inputs, Arrow batches in bounded blocks, and tables in the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cobasket.session import scratch_path

BLOCK_BYTES = 4 << 20  # text handled at a time inside a task
SENT_KEYS = 200_000  # some 20 MB where they are digests
WORDS = r"[^\x20\x09-\x0D]+"  # a word, as most operators see it: bytes.split() gives the same


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the workers this package, unless they find it where the driver does."""
    root, sc = Path(__file__).resolve().parents[2], spark.sparkContext
    if sc.applicationId in _shipped:
        return
    _shipped.add(sc.applicationId)
    if str(root) not in os.environ.get("PYTHONPATH", "").split(os.pathsep) and Path.cwd() != root:
        with zipfile.ZipFile(Path(tempfile.mkdtemp()) / f"{root.name}-package.zip", "w") as archive:
            for file in (root / "cobasket").rglob("*.py"):
                archive.write(file, file.relative_to(root))
        sc.addPyFile(archive.filename)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text's UTF-8 bytes, under the names ``id`` and ``text``; null text is empty.

    Whatever else the input holds stays out, so its columns can't clash with an operator's own.
    """
    return docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))


def crc_mod(key: str | Column, n: int) -> Column:
    """crc32 of the key as text, modulo n: the fold of a row."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % n


def ascii_lower(text: Column) -> Column:
    """A-Z to lower case, nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def free(df: DataFrame, name: str) -> str:
    """``name``, or something like it that is no column of ``df``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def dropped(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` isn't in ``gone``. The keys are stored; up to :data:`SENT_KEYS` of them, numbers or digests
    and so of a known size, are sent to the tasks and the rows stay where they are. Beyond, both sides are shuffled."""
    gone = written(gone.select(key).distinct(), "gone")
    few = gone.limit(SENT_KEYS + 1).count() <= SENT_KEYS
    return rows.join(F.broadcast(gone) if few else gone, key, "left_anti")


def about(rows: DataFrame, n: int, total: int, key: str = "id") -> DataFrame:
    """About ``n`` of ``total`` rows, the same ones every time: those whose key has a small hash. Nothing is sorted, and
    no task passes on more than its share."""
    if total <= n:
        return rows
    return rows.filter(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 30)) < int(n / total * (1 << 30)))


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """Rows with the largest ``n``, ``limit`` at most: all from the smallest count on that keeps to the limit, by classes
    of counts that are a twelfth of a doubling wide. Only the size of each class reaches the driver."""
    level = F.floor(F.log2(F.col("n")) * 12).cast("int")
    left, least = limit, None
    for at, size in counts.filter("n > 0").groupBy(level.alias("at")).agg(F.count("*")).orderBy(F.desc("at")).collect():
        if size > left:
            break
        left, least = left - size, at
    return counts.filter((F.col("n") > 0) & (level >= least)) if least is not None else counts.filter("false")


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Keys and texts of consecutive rows, about ``limit`` bytes of text at a time, a row at least."""
    for batch in batches:
        keys, texts = batch.column("id").to_pylist(), batch.column("text")
        rows: list[bytes] = []
        first, size = 0, 0
        for i in range(len(texts)):
            text = texts[i].as_py() or b""
            if rows and size + len(text) > limit:
                yield keys[first:i], rows
                rows, first, size = [], i, 0
            rows.append(text)
            size += len(text)
        if rows:
            yield keys[first:], rows


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows with about ``limit`` bytes in a binary column at a time, a row at least; nothing is copied."""
    for batch in batches:
        ends, at = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64)), 0
        while at < len(ends):
            stop = int(np.searchsorted(ends, limit + (ends[at - 1] if at else 0), side="right"))
            stop = max(stop, at + 1)
            yield batch.slice(at, stop - at)
            at = stop


def coded_words(texts: pa.Array, cased: str | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """The words of texts (binary) between ASCII white space, A-Z in lower case but for texts that hold ``cased``: how many
    each text has, the place of each one in the list of distinct words, and that list (string)."""
    strings = pa.Array.from_buffers(pa.string(), len(texts), texts.buffers(), offset=texts.offset)
    lower = pc.ascii_lower(strings)
    if cased:
        lower = pc.if_else(pc.match_substring(strings, cased), strings, lower)
    split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(lower))
    found = split.flatten().dictionary_encode()
    codes, words = found.indices.to_numpy(), found.dictionary
    sizes = pc.list_value_length(split).fill_null(0).to_numpy().astype(np.int64)
    blank = pc.index(words, "").as_py()
    if blank >= 0:  # the one word of an empty text
        gone = codes == blank
        sizes[np.repeat(np.arange(len(sizes)), sizes)[gone]] = 0
        codes = codes[~gone]
    return sizes, codes, words


def record_batch(schema: pa.Schema, *columns: Any) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, read back: cuts lineage, and can be read column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
