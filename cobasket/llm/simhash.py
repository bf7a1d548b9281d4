"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

Each of the 64 bits gets a vector of ``radius + 1`` binary digits. For each such vector v that isn't zero there is a
table, keyed by the bits whose vectors have an odd product with v. Vectors of ``radius`` differing bits leave some v
with which all their products are even, so two fingerprints within the radius have the same key in at least one table:
the masks cover every pair, whatever the data.

A key shared by many fingerprints isn't turned into pairs. Its members differ in the uncovered bits alone. Each is
written down together with its neighbours at half the radius in those bits; members that meet at a neighbour are within
the radius, and any two within the radius meet. A neighbour has a bounded number of members, which are linked in a star.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.common import blocks, dropped, free, record_batch, written
from cobasket.llm.components import connected_components

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
PART = 1 << 18  # shingles counted at a time
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """In how many of the hashes each bit is set, bit 0 first."""
    flat = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return flat.sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Unsigned 64 bits: those set in over half of the hashes of all shingles of words. No word: 0."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths) - 1
    starts = (ends + 1 - lengths).tolist()
    stops = ends.tolist()[shingle - 1:] or [len(joined)]
    digest, sums = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for first in range(0, len(stops), PART):
        ranges = zip(starts[first:first + PART], stops[first:first + PART])
        sums += bit_sums(np.array([digest(joined[a:b], seed) for a, b in ranges], np.uint64))
    return int(((1 << np.arange(BITS, dtype=np.uint64)) * (2 * sums > len(stops)).astype(np.uint64)).sum(dtype=np.uint64))


PRINTS = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id",
                 text_col: str = "text", row: Column | None = None) -> DataFrame:
    """id, row (a number of its own, unless given), fp (the fingerprint as a signed number) of every row. One pass over
    whole texts, no shuffle."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin = 0
            for keys, texts in blocks(iter([batch])):
                prints = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)
                yield record_batch(PRINTS, keys, batch.column("row").slice(begin, len(keys)), prints)
                begin += len(keys)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
                       .alias("text"), (F.monotonically_increasing_id() if row is None else row).alias("row"))
    return rows.mapInArrow(mapped, "id long, row long, fp long")


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """The bits that each table is keyed by."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between distinct fingerprints in column ``fp`` that keep all connections within the radius.

    Any linked pair is within the radius. Of the pairs within it, those left out are connected by links.
    """
    if radius % 2 or radius < 2:
        raise ValueError("the radius must be even")
    tables = masks(radius)
    keys = F.array(*[F.struct(F.lit(n).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for n, m in enumerate(tables)])
    keyed = prints.select("fp", F.inline(keys))
    shared = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1").select("t", "key")
    candidates = keyed.join(shared, ["t", "key"], "left_semi")
    flips = []  # per table: nothing, and all changes of up to half the radius in bits outside the key
    for mask in tables:
        open_bits = [1 << i for i in range(BITS) if not mask >> i & 1]
        flips.append([_signed(sum(c)) for n in range(radius // 2 + 1) for c in combinations(open_bits, n)])
    changes = F.element_at(F.array(*[F.array(*[F.lit(f).cast("long") for f in one]) for one in flips]),
                           F.col("t") + 1)
    met = candidates.select("fp", F.explode(changes).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at")).groupBy("at").agg(
        F.sort_array(F.collect_set("fp")).alias("members")).filter(F.size("members") > 1)
    return met.select(F.get("members", F.lit(0)).alias("a"),
                      F.explode(F.slice("members", F.lit(2), F.size("members"))).alias("b")).distinct()


def _components(docs: DataFrame, radius: int, shingle: int, seed: int, id_col: str, text_col: str,
                row: Column | None = None) -> DataFrame:
    """id, row, fp, component_id, keep_row (the row of the component that comes first by id)."""
    prints = written(fingerprints(docs, shingle, seed, id_col, text_col, row), "fingerprints")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("low")
    distinct = written(prints.groupBy("fp").agg(first), "distinct-fingerprints")
    roots = written(connected_components(links(distinct, radius)), "roots")
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = written(rooted.groupBy("root").agg(F.min("low").alias("least")), "lowest")
    of = rooted.join(lowest, "root").select("fp", F.col("least.id").alias("component_id"),
                                            F.col("least.row").alias("keep_row"))
    return prints.join(of, "fp")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, fingerprint (16 hexadecimal digits), component_id: the smallest id reachable over links of
    fingerprints that differ in at most ``radius`` bits, equal ones included.

    Null, empty and blank texts have fingerprint zero and are linked like others. Repeated rows are in one component.
    A component whose rows have no id has none. An empty table gives no rows; other columns are not read. Copies are
    reduced to one fingerprint before anything is compared.
    """
    found = _components(docs, radius, shingle, seed, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """One row of each component, the first by id (rows without one last), with all columns of ``docs``. Rows are told
    apart by their number in a stored copy: of rows that share an id, only those go that are copies."""
    own = free(docs, "_row")
    stored = written(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    found = _components(stored, radius, shingle, seed, id_col, text_col, F.col(own))
    gone = found.filter(F.col("row") != F.col("keep_row")).select(F.col("row").alias(own))
    return dropped(stored, gone, own).drop(own)
