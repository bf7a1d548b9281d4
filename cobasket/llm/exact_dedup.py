"""Exact duplicates by an index of cuckoo filters.

Texts are equal when their normalised forms have the same SHA-256 digest; only digests are moved. The index is dealt
out by digest. Within a part, :class:`CuckooIndex` answers whether a digest is live: its filter holds short
fingerprints in buckets of four, and a fingerprint that matches is verified against the digest stored for that very
place, so an answer is never a guess. A digest can be deleted again. When an insertion finds no room, the filter is
doubled and filled anew from the stored digests.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.common import WORDS, free, record_batch, written

SLOTS = 4  # fingerprints in a bucket
KICKS = 64  # moves before the filter counts as full
LIVE = 1 << 18  # digests of an index in a task; more are given out and the index starts anew
SPACES = WORDS.replace("^", "")


class CuckooIndex:
    """A cuckoo filter over 32-byte digests, with the digests themselves stored under handles.

    ``find`` gives the handle of a live digest or -1. Handles of deleted digests are used again.
    """

    def __init__(self, buckets: int = 1 << 8):
        self.digests: list[bytes | None] = []
        self.free: list[int] = []
        self.resizes = 0
        self._empty(buckets)

    def _empty(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = [0] * (buckets * SLOTS)
        self.handles = [-1] * (buckets * SLOTS)

    def __len__(self) -> int:
        return len(self.digests) - len(self.free)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        """Fingerprint (never 0) and the two buckets it may be in; each follows from the other and the fingerprint."""
        mark = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return (bucket ^ (mark * 0x5BD1E995 >> 3)) & self.mask

    def _slot(self, digest: bytes) -> int:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self.prints[slot] == mark and self.digests[self.handles[slot]] == digest:
                    return slot
        return -1

    def find(self, digest: bytes) -> int:
        slot = self._slot(digest)
        return self.handles[slot] if slot >= 0 else -1

    def insert(self, digest: bytes) -> int:
        """The handle of ``digest``, which is live from now on."""
        found = self.find(digest)
        if found >= 0:
            return found
        if self.free:
            handle = self.free.pop()
            self.digests[handle] = digest
        else:
            handle = len(self.digests)
            self.digests.append(digest)
        if not self._place(digest, handle):
            self._resize()
        return handle

    def _place(self, digest: bytes, handle: int) -> bool:
        mark, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.handles[slot] = mark, handle
                    return True
        bucket = first
        for kick in range(KICKS):  # the one put out goes to its other bucket
            slot = bucket * SLOTS + kick % SLOTS
            mark, self.prints[slot] = self.prints[slot], mark
            handle, self.handles[slot] = self.handles[slot], handle
            bucket = self._other(bucket, mark)
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if not self.prints[slot]:
                    self.prints[slot], self.handles[slot] = mark, handle
                    return True
        return False

    def _resize(self) -> None:
        """Twice the buckets, until every stored digest finds a place again."""
        self.resizes += 1
        self._empty(2 * (self.mask + 1))
        gone = set(self.free)
        if not all(self._place(d, h) for h, d in enumerate(self.digests) if h not in gone):
            self._resize()

    def delete(self, digest: bytes) -> bool:
        """Take out a live digest; False if it wasn't there."""
        slot = self._slot(digest)
        if slot < 0:
            return False
        handle = self.handles[slot]
        self.prints[slot], self.handles[slot], self.digests[handle] = 0, -1, None
        self.free.append(handle)
        return True


def normalised(text: Column) -> Column:
    """Runs of white space as one blank; null as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACES, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, digest and a number for each row, stored: the number tells repeated rows apart."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), digest(F.col(text_col)).alias("digest"))
    return written(rows.withColumn("row", F.monotonically_increasing_id()), "digests")


GROUPS = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("keep_row", pa.int64()),
                    ("group_size", pa.int64())])
GROUPS_SQL = "digest binary, keep_id long, keep_row long, group_size long"


def _order(entry: tuple[int | None, int]) -> tuple[bool, int, int]:
    return (entry[0] is None, entry[0] or 0, entry[1])


def _indexed(batches: Iterator[pa.RecordBatch], by_digest: bool) -> Iterator[pa.RecordBatch]:
    """One row per live digest: the smallest (id, row) and the number of rows. When rows come ordered by digest, a
    full index is given out between two digests, so each comes once; else a digest may come again later."""
    index, best, sizes = CuckooIndex(), [], []

    def out() -> pa.RecordBatch:
        return record_batch(GROUPS, index.digests, [b[0] for b in best], [b[1] for b in best], sizes)

    for batch in batches:
        for key, one, row, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
            handle = index.find(key)
            if handle < 0:
                if len(index) >= LIVE:
                    yield out()
                    index, best, sizes = CuckooIndex(), [], []
                index.insert(key)
                best.append((one, row))
                sizes.append(size)
            else:
                best[handle] = min(best[handle], (one, row), key=_order)
                sizes[handle] += size
        if not by_digest and len(index) >= LIVE:
            yield out()
            index, best, sizes = CuckooIndex(), [], []
    if len(index):
        yield out()


def build_index(rows: DataFrame) -> DataFrame:
    """The live digests of rows (id, digest, row): digest, keep_id, keep_row, group_size.

    Each input task indexes its own rows first, so a digest that a third of all rows share crosses the shuffle once a
    task; the parts by digest then index those.
    """
    ones = rows.select("digest", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"),
                       F.lit(1).cast("long").alias("group_size"))
    local = ones.mapInArrow(lambda batches: _indexed(batches, False), GROUPS_SQL)
    return (local.repartition("digest").sortWithinPartitions("digest")
            .mapInArrow(lambda batches: _indexed(batches, True), GROUPS_SQL))


def _updated(changes: Iterable[tuple], index: CuckooIndex, counts: dict[int, int]) -> None:
    for key, n in changes:
        handle = index.find(key)
        if n > 0:
            handle = index.insert(key) if handle < 0 else handle
            counts[handle] = counts.get(handle, 0) + n
        elif handle >= 0:
            counts[handle] += n
            if counts[handle] <= 0:
                del counts[handle]
                index.delete(key)


def update_index(index: DataFrame, inserted: DataFrame, deleted: DataFrame) -> DataFrame:
    """Live digests after changes: digest, group_size. All three have ``digest``, and the index ``group_size``.

    Insertions come before deletions; a digest is live while more copies were inserted than deleted. Deleting what
    isn't there changes nothing. Changes are counted before they are dealt out.
    """
    one = F.count("*").alias("group_size")
    parts = [index.select("digest", "group_size", F.lit(0).alias("step")),
             inserted.groupBy("digest").agg(one).select("digest", "group_size", F.lit(1).alias("step")),
             deleted.groupBy("digest").agg(one).select("digest", (-F.col("group_size")).alias("group_size"),
                                                       F.lit(2).alias("step"))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    schema = pa.schema([("digest", pa.binary()), ("group_size", pa.int64())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, counts, last = CuckooIndex(), {}, None

        def out() -> pa.RecordBatch:
            return record_batch(schema, [filters.digests[h] for h in counts], list(counts.values()))

        for batch in batches:
            for key, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != last and len(filters) >= LIVE:
                    yield out()
                    filters, counts = CuckooIndex(), {}
                last = key
                _updated([(key, n)], filters, counts)
        if counts:
            yield out()

    return (rows.repartition("digest").sortWithinPartitions("digest", "step").select("digest", "group_size")
            .mapInArrow(mapped, "digest binary, group_size long"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, keep_id, group_size, kept, text_sha256.

    Of rows with equal texts the one with the smallest id is kept; of several rows with that id, one. Null and empty
    texts are equal to each other; a row without an id is kept only where no other has its text. An empty table gives
    none; other columns are not read. A group of copies of any size is joined by Spark's skew join, not gathered.
    """
    rows = digests(docs, id_col, text_col)
    joined = rows.join(build_index(rows), "digest")
    return joined.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row"))
                         .alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_duplicates` keeps, with all their columns."""
    found = written(exact_duplicates(docs, id_col, text_col), "duplicates")
    gone = found.filter(~F.col("kept"))
    own, sha = free(docs, "_id"), free(docs, "_sha")
    body = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    key = [F.col(id_col).cast("long").eqNullSafe(F.col(own)), F.col(sha) == body]
    whole = gone.filter(~F.col("keep_id").eqNullSafe(F.col(id_col)))
    out = docs.join(whole.select(F.col(id_col).alias(own), F.col("text_sha256").alias(sha)).distinct(), key, "left_anti")
    if gone.filter(F.col("keep_id").eqNullSafe(F.col(id_col))).isEmpty():
        return out
    return out.withColumn(sha, body).dropDuplicates([id_col, sha]).drop(sha)  # repeated ids: one row each
