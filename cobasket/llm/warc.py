"""Web archives as tables of chunked records.

An archive row is one WARC/1.1 record of bounded size. A payload beyond that size becomes a first segment and numbered
continuation records, as the format provides, so a row is named by its record's serial and its chunk number. The reader
never holds more of a payload than a chunk; the writer gets a payload whole in its row, and adds one copy of it and no more
than a chunk of each record. A chunk carries its own digest and that of the payload up to
its end, taken step by step; the reader takes them again the same way and compares.

Rows are written and read by Spark's text source, whose separators are the ends of records: any store that Spark writes
to will do, and a lost task leaves no half-written archive. A chunk is cut where its content would look like the
start of a record.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cobasket.llm.common import record_batch, written

CHUNK = 64 << 10  # payload bytes of a record
MIN_SHARED = 100  # payloads below are always written out
BATCH_BYTES = 4 << 20

# The archive format.
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"  # pages carry no date
SEPARATOR = END + VERSION
START = SEPARATOR[:-2]


def payloads(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))


def revisits(rows: DataFrame, min_shared: int = MIN_SHARED) -> DataFrame:
    """page_id, digest, refers_to of the pages whose payload an earlier page has. Only digests are moved."""
    digests = written(rows.select("page_id", "digest", F.octet_length("payload").alias("n")), "payloads")
    shared = digests.filter(F.col("n") >= min_shared)
    first = shared.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")) \
        .filter("n > 1").select("digest", "refers_to")
    found = shared.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return found.filter("refers_to is not null").select("page_id", "digest", "refers_to").distinct()


def chunks(payload: bytes, size: int = CHUNK) -> Iterator[memoryview]:
    """Cuts between characters, and inside anything that looks like the start of a record; one empty chunk for none."""
    view, at, n = memoryview(payload), 0, len(payload)
    while True:
        end = min(at + size, n)
        # What stands before a chunk ends like a record, so a start may also lie across the chunk's beginning.
        look = (END + payload[at:end]).find(START)
        if look >= 0:
            end = at + look + 2
        while end < n and end > at + 1 and payload[end] & 0xC0 == 0x80:
            end -= 1
        yield view[at:end]
        at = end
        if at >= n:
            return


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, serial: str,
            size: int = CHUNK) -> Iterator[bytes]:
    """The archive records of one page: a revisit without content, or a response in as many segments as needed."""
    target = " ".join((url or f"urn:page:{page_id}").split())
    own = record_id(page_id, digest)
    head = [("WARC-Date", DATE), ("WARC-Target-URI", target), ("X-Serial", serial),
            ("X-Page-Id", "" if page_id is None else page_id), ("X-Payload-Length", len(payload)),
            ("WARC-Payload-Digest", f"sha256:{digest}")]

    def record(kind: str, name: str, block: bytes, *more: tuple) -> bytes:
        fields = [("WARC-Type", kind), ("WARC-Record-ID", name), *head, *more,
                  ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
                  ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
        return VERSION + "\r\n".join(f"{k}: {v}" for k, v in fields).encode() + END + block

    if refers_to is not None:
        yield record("revisit", own, HTTP_HEAD, ("WARC-Refers-To", record_id(refers_to, digest)),
                     ("X-Refers-To-Page", refers_to),
                     ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        return
    so_far, done, number = hashlib.sha256(), 0, 0
    for chunk in chunks(payload, size):
        number, done = number + 1, done + len(chunk)
        so_far.update(chunk)
        last = done == len(payload)
        more = [("X-Digest-So-Far", f"sha256:{so_far.hexdigest()}"), ("X-Last", int(last))]
        if number > 1 or not last:
            more.append(("WARC-Segment-Number", number))
        if number == 1:
            yield record("response", own, HTTP_HEAD + bytes(chunk), *more)
        else:
            more += [("WARC-Segment-Origin-ID", own)]
            more += [("WARC-Segment-Total-Length", len(HTTP_HEAD) + len(payload))] if last else []
            yield record("continuation", f"{own[:-1]}#{number}>", bytes(chunk), *more)


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html", min_shared: int = MIN_SHARED, size: int = CHUNK) -> None:
    """Write a record per row as compressed archive files under ``path``.

    Of rows with equal payloads of ``min_shared`` bytes or more, the one with the smallest id is a response and the
    others revisit it. Null payloads are empty; repeated rows give repeated records; rows without an id give
    responses without one. An empty table gives no record.
    """
    rows = payloads(pages, id_col, url_col, payload_col)
    marked = rows.join(revisits(rows, min_shared), ["page_id", "digest"], "left").select(
        "page_id", "url", "payload", "digest", "refers_to")
    schema = pa.schema([("value", pa.string())])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held, bytes_held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (
                    c[i].as_buffer().to_pybytes() if k == 2 else c[i].as_py() for k, c in enumerate(columns))
                n += 1
                for one in records(page_id, url, payload, digest, refers_to, f"{part}-{n}", size):
                    held.append(one)
                    bytes_held += len(one)
                    if bytes_held > BATCH_BYTES:
                        yield pa.record_batch([pa.array(held, pa.binary()).cast(pa.string())], schema=schema)
                        held, bytes_held = [], 0
        if held:
            yield pa.record_batch([pa.array(held, pa.binary()).cast(pa.string())], schema=schema)

    (marked.mapInArrow(mapped, "value string").write.option("lineSep", END.decode()).option("compression", "gzip")
     .text(path))


SEGMENTS = pa.schema([("serial", pa.string()), ("number", pa.int64()), ("last", pa.bool_()), ("page_id", pa.int64()),
                      ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                      ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("so_far", pa.string()),
                      ("chunk", pa.binary())])
SEGMENTS_SQL = ("serial string, number long, last boolean, page_id long, url string, record_type string, "
                "refers_to long, payload_bytes long, payload_digest string, so_far string, chunk binary")


def parse_record(raw: bytes) -> tuple:
    """One segment row from a record as the separators leave it. A record whose digest doesn't fit is an error."""
    head, _, rest = raw.removeprefix(VERSION).partition(END)
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
    block = rest[:int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    kind = fields["WARC-Type"]
    page_id, refers = fields["X-Page-Id"], fields.get("X-Refers-To-Page")
    return (fields["X-Serial"], int(fields.get("WARC-Segment-Number", 1)), fields.get("X-Last", "1") == "1",
            int(page_id) if page_id else None, fields["WARC-Target-URI"], kind, int(refers) if refers else None,
            int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"),
            fields.get("X-Digest-So-Far", "").removeprefix("sha256:") or None,
            None if kind == "revisit" else block if kind == "continuation" else block[len(HTTP_HEAD):])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table: serial, number, last, page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, so_far, chunk."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [parse_record(v.as_buffer().to_pybytes()) for v in batch.column(0)]
            if rows:
                yield record_batch(SEGMENTS, *zip(*rows))

    lines = spark.read.option("lineSep", SEPARATOR.decode()).text(path)
    return lines.filter(F.length("value") > 4).select(F.col("value").cast("binary")).mapInArrow(mapped, SEGMENTS_SQL)


RECORDS = pa.schema([f for f in SEGMENTS if f.name in ("page_id", "payload_bytes", "payload_digest", "record_type",
                                                       "refers_to")])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Per record: page_id, record_type, refers_to, payload_bytes, payload_digest, checked against the content.

    A record of one segment is finished where it is read, and only its summary moves on. The segments of the others
    are brought together in order and digested one by one.
    """
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, size, expected = hashlib.sha256(), 0, 1
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["number"] == 1:
                    state, size, expected = hashlib.sha256(), 0, 1
                if row["chunk"] is not None:
                    state.update(row["chunk"])
                    size += len(row["chunk"])
                    if row["number"] != expected or state.hexdigest() != row["so_far"]:
                        raise ValueError(f"segment {row['number']} of page {row['page_id']} doesn't fit")
                expected += 1
                if row["last"]:
                    if row["chunk"] is not None and (size != row["payload_bytes"]
                                                     or row["so_far"] != row["payload_digest"]):
                        raise ValueError(f"the payload of page {row['page_id']} doesn't fit")
                    out.append(tuple(row[f] for f in RECORDS.names[:1]) + (
                        "revisit" if row["record_type"] == "revisit" else "response", row["refers_to"],
                        row["payload_bytes"], row["payload_digest"]))
            if out:
                yield record_batch(RECORDS, *zip(*out))

    segments = read_segments(spark, path)
    single = F.col("last") & (F.col("number") == 1)
    checked = single & (F.col("record_type") == "response") & (F.octet_length("chunk") == F.col("payload_bytes")) & (
        F.sha2("chunk", 256) == F.col("payload_digest"))
    slim = segments.withColumn("chunk", F.when(~checked, F.col("chunk")))
    return (slim.repartition("serial").sortWithinPartitions("serial", "number")
            .mapInArrow(finish, "page_id long, record_type string, refers_to long, payload_bytes long, "
                                "payload_digest string"))
