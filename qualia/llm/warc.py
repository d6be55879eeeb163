"""WARC files: writing records in segments, and reassembling them.

A payload longer than ``segment_bytes`` is written as a first segment (WARC-Segment-Number 1)
and ``continuation`` records that name it by WARC-Segment-Origin-ID; the last one gives
WARC-Segment-Total-Length. The block of a response is an HTTP message whose body is in
chunked transfer framing; a revisit has the HTTP head alone and refers to the response with
the same payload. Reading parses files record by record, groups segments by their origin
over all files, orders them by number, verifies number and total length, and undoes the
chunked framing.

Defined results: a null html is an empty payload; a null page id is a record like others
(refers_to may not name it: the largest id that is not null does); repeated rows are written
each, and those that equal the response in id and payload are responses too; an empty table
gives no records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualia.llm.binfiles import read_files, write_records
from qualia.llm.shared import fresh_path, ship

VERSION = b"WARC/1.1"
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: Records of a file, each at most a segment and its head.
FILE_RECORDS = 2000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def chunked(body: bytes, size: int) -> bytes:
    """Chunked transfer framing (RFC 9112, section 7.1)."""
    parts = []
    for a in range(0, len(body), size):
        part = body[a:a + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(framed: bytes) -> bytes:
    """The body of chunked framing; chunk extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        line = framed.index(b"\r\n", at)
        n = int(framed[at:line].split(b";")[0], 16)
        at = line + 2
        if n == 0:
            return b"".join(parts)
        parts.append(framed[at:at + n])
        if len(parts[-1]) != n or framed[at + n:at + n + 2] != b"\r\n":
            raise ValueError("a chunk ends too early")
        at += n + 2


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that follow its block (the file writer puts them)."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    return VERSION + b"\r\n" + head.encode() + b"\r\n" + block


def records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers in lower case, block) of each record of a file."""
    at, end = 0, len(raw)
    while at < end:
        head_end = raw.index(b"\r\n\r\n", at)
        lines = raw[at:head_end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {}
        for line in lines[1:]:
            k, _, v = line.partition(b":")
            headers[k.strip().lower().decode()] = v.strip().decode()
        n = int(headers["content-length"])
        at = head_end + 4 + n
        if raw[at:at + 4] != b"\r\n\r\n":
            raise ValueError(f"a record's block does not end at byte {at}")
        yield headers, raw[head_end + 4:at]
        at += 4


def _writer(segment_bytes: int, chunk_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            out, size = [], 0
            for k in range(batch.num_rows):
                body = cols["payload"][k].as_py()
                page, url, refers = cols["page"][k].as_py(), cols["url"][k].as_py(), cols["refers_to"][k].as_py()
                revisit = not cols["is_response"][k].as_py()
                name = f"<urn:uuid:{cols['uuid'][k].as_py()}>"
                head = [("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", "".join((url or "urn:none").split())),
                        ("WARC-Payload-Digest", f"sha1:{payload_digest(body)}"), ("Content-Type", "application/http;msgtype=response"),
                        ("X-Payload-Bytes", str(len(body)))]
                if page is not None:
                    head.append(("X-Page-ID", str(page)))
                if revisit:
                    head += [("WARC-Type", "revisit"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                    if refers is not None:
                        head.append(("X-Refers-To-Page-ID", str(refers)))
                    out.append(record(head, HTTP_HEAD))
                else:
                    block = HTTP_HEAD + chunked(body, chunk_bytes)
                    size += len(block)
                    head.append(("WARC-Type", "response"))
                    parts = [block[a:a + segment_bytes] for a in range(0, len(block), segment_bytes)]
                    if len(parts) > 1:
                        head.append(("WARC-Segment-Number", "1"))
                    out.append(record(head, parts[0]))
                    for number, part in enumerate(parts[1:], 2):
                        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{cols['uuid'][k].as_py()}-{number}>"), ("WARC-Date", date),
                                ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", str(number))]
                        if number == len(parts):
                            more.append(("WARC-Segment-Total-Length", str(len(block))))
                        out.append(record(more, part))
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
    return run


_KEPT = ["page_id", "record_type", "payload_bytes", "payload_digest", "refers_to"]
_SEGMENTS = ("origin string, number long, total long, record_type string, page_id long, payload_bytes long, payload_digest string, refers_to long, block binary")


def _reader(segmented: bool):
    """Rows of the records that are whole, or of those that are segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = lambda h, k: int(h[k]) if k in h else None
        names = [x.split()[0] for x in _SEGMENTS.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        schema = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in _SEGMENTS.split(", ")])

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, schema.field(n).type) for n, c in zip(names, zip(*rows))], schema=schema)

        for batch in batches:
            for value in batch.column(1):
                rows = []
                for h, block in records(gzip.decompress(value.as_buffer())):
                    kind = h["warc-type"]
                    if kind not in ("response", "revisit", "continuation"):
                        continue
                    if ("warc-segment-number" in h) != segmented:
                        continue
                    origin = h["warc-segment-origin-id"] if kind == "continuation" else h["warc-record-id"]
                    rows.append((origin, whole(h, "warc-segment-number") or 1, whole(h, "warc-segment-total-length"), kind, whole(h, "x-page-id"),
                                 whole(h, "x-payload-bytes"), h.get("warc-payload-digest", "").removeprefix("sha1:"), whole(h, "x-refers-to-page-id"), block))
                    if len(rows) == 500:
                        yield out(rows)
                        rows = []
                if rows:
                    yield out(rows)
    return run


def _finisher():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, size, digest, block = (batch.column(batch.schema.get_field_index(n)) for n in ("record_type", "payload_bytes", "payload_digest", "block"))
            out = []
            for k in range(batch.num_rows):
                http = block[k].as_py()
                head, _, body = http.partition(b"\r\n\r\n")
                if kind[k].as_py() == "response":
                    payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
                    if len(payload) != size[k].as_py() or payload_digest(payload) != digest[k].as_py():
                        raise ValueError("a payload does not match its record")
                    out.append(payload)
                else:
                    out.append(None)
            keep = [n for n in batch.schema.names if n != "block"]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(n)) for n in keep), pa.array(out, pa.binary())], [*keep, "payload"])
    return run


def plan_records(pages: DataFrame, *, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page, url, payload, uuid, is_response, refers_to): of equal payloads of at least
    ``min_bytes`` the one with the largest id is the response, the others revisit it."""
    p = pages.select(F.col(page_id).cast("long").alias("page"), F.col(url).cast("string").alias("url"),
                     F.coalesce(F.col(html), F.lit("")).cast("binary").alias("payload"))
    p = p.withColumn("digest", F.unhex(F.sha1("payload")))
    light = p.select("page", "digest", F.octet_length("payload").alias("size"))
    same = light.where(f"size >= {min_bytes}").groupBy("digest").agg(F.max("page").alias("last"), F.count("*").alias("n")).where("n > 1")
    # only payloads that repeat are looked up, so that the join stays small
    out = p.join(same.withColumnRenamed("digest", "_d"), F.col("digest") == F.col("_d"), "left").drop("_d")
    first = F.col("last").isNull() | (F.col("page") == F.col("last"))
    return out.withColumn("is_response", F.coalesce(first & (F.col("n").isNull() | F.col("page").isNotNull()), F.lit(True))).select(
        "page", "url", "payload", F.expr("uuid()").alias("uuid"), "is_response", F.when(~F.col("is_response"), F.col("last")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, *, min_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES,
               file_records: int = FILE_RECORDS, date: str = "2026-01-31T00:00:00Z", **columns) -> None:
    """One response or revisit for each row, as gzipped WARC/1.1 files of at most ``file_records`` records (so of bounded size).

    The lookup of equal payloads deals the pages out; its partitions are written as they are.
    """
    ship(pages.sparkSession)
    made = plan_records(pages, min_bytes=min_bytes, **columns).mapInArrow(_writer(segment_bytes, chunk_bytes, date), "record binary")
    write_records(made, "record", path, end="\r\n\r\n", most=file_records, compression="gzip")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to, payload) of every response and revisit.

    Whole records pass straight on; only those in segments are grouped, by their origin.
    """
    ship(spark)
    whole = read_files(spark, path).mapInArrow(_reader(False), _SEGMENTS).select(*_KEPT, "block")
    seg = read_files(spark, path).mapInArrow(_reader(True), _SEGMENTS)
    part = F.struct("number", "total", F.col("record_type").alias("type"), *[c for c in _KEPT if c != "record_type"], "block")
    joined = seg.groupBy("origin").agg(F.sort_array(F.collect_list(part)).alias("s"))
    ok = F.expr("transform(s, x -> x.number) = sequence(1L, cast(size(s) as long)) and element_at(s, -1).total = "
                "aggregate(s, 0L, (a, x) -> a + octet_length(x.block))")
    joined = joined.withColumn("block", F.when(F.coalesce(ok, F.lit(False)), F.expr("aggregate(s, cast('' as binary), (a, x) -> a || x.block)")).otherwise(
        F.raise_error(F.concat(F.lit("segments are missing or too short: "), F.col("origin"))).cast("binary")))
    first = F.col("s")[0]
    out = joined.select(*[first["type" if c == "record_type" else c].alias(c) for c in _KEPT], "block")
    schema = "page_id long, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
    return whole.union(out).mapInArrow(_finisher(), schema)


def write_and_read_back(pages: DataFrame, **options) -> DataFrame:
    path = fresh_path(pages.sparkSession, "warc")
    write_warc(pages, path, **options)
    return read_warc(pages.sparkSession, path)
