"""WARC archives: records per page, segmented and chunk-framed, and their reassembly.

`write_warc` writes standard WARC/1.1 files, gzipped, with Spark's text writer: a row is a
whole record, and the line separator is the CR LF CR LF that ends a record. The
payload stands in an HTTP message with chunked transfer framing. Records longer
than SEGMENT_BYTES are segmented: the first keeps its type with segment number
1, the rest are continuation records that name it as their origin, and the last
one states the total length. `read_warc` reads the files by Content-Length,
groups continuation records by origin, orders them by segment number, verifies
numbers and total length, and decodes the chunked framing.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ship

#: Longest block of one record, and records of one file: together they bound a file.
SEGMENT_BYTES = 32 << 10
RECORDS_PER_FILE = 4000
#: Bytes of a chunk of the transfer framing.
FRAME_BYTES = 8 << 10
#: Payloads shorter than this are never revisits.
LEAST_REVISIT = 100
_EOL = "\r\n"
#: Fixed value of the format: the profile of revisits with a payload digest.
_SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def _cuts(raw: bytes, size: int) -> Iterator[bytes]:
    """Pieces of about `size` bytes that end between UTF-8 characters."""
    at = 0
    while at < len(raw):
        end = min(at + size, len(raw))
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end += 1
        yield raw[at:end]
        at = end


def frame_chunked(payload: bytes) -> bytes:
    """The payload in chunked transfer framing."""
    return b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in _cuts(payload, FRAME_BYTES)) + b"0\r\n\r\n"


def unframe_chunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        eol = body.index(b"\r\n", at)
        n = int(body[at:eol].split(b";")[0], 16)
        at = eol + 2
        if n == 0:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        out.append(body[at : at + n])
        at += n + 2


def _record(fields: list[tuple[str, str]], block: bytes) -> str:
    head = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return _EOL.join(head) + block.decode()


def page_records(key: str, page_id, url, payload: bytes, digest: str, refers_to) -> Iterator[str]:
    """The records of one page: a revisit without block, or a response in one or more segments."""
    named = [("WARC-Record-ID", f"<urn:record:{key}>"), ("WARC-Date", "1970-01-01T00:00:00Z")]
    about = [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", str(len(payload)))]
    if page_id is not None:
        about.append(("X-Page-ID", str(page_id)))
    if url is not None:
        about.append(("WARC-Target-URI", "".join(c for c in url if c >= " ")))
    if refers_to is not None:
        yield _record([("WARC-Type", "revisit"), *named, ("WARC-Profile", _SAME_PAYLOAD), *about, ("X-Refers-To-Page-ID", str(refers_to))], b"")
        return
    block = _HTTP + frame_chunked(payload)
    pieces = list(_cuts(block, SEGMENT_BYTES))
    first = [("WARC-Segment-Number", "1")] if len(pieces) > 1 else []
    yield _record([("WARC-Type", "response"), *named, ("Content-Type", "application/http;msgtype=response"), *about, *first], pieces[0])
    for i, p in enumerate(pieces[1:], 2):
        total = [("WARC-Segment-Total-Length", str(len(block)))] if i == len(pieces) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:record:{key}:{i}>"), named[1],
                       ("WARC-Segment-Origin-ID", f"<urn:record:{key}>"), ("WARC-Segment-Number", str(i)), *total], p)


def _recorder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out: list[str] = []
        size = 0
        for key, page, url, html, digest, refers in zip(*(b.column(c).to_pylist() for c in ("key", "page", "url", "html", "digest", "refers"))):
            for r in page_records(str(key), page, url, (html or "").encode(), digest, refers):
                out.append(r)
                size += len(r)
            if size > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                out, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Writes one WARC record per row of pages (more when segmented) under path.

    Of rows with equal payloads of at least LEAST_REVISIT bytes, those with the
    smallest id are responses and the others revisit it; a row without id is a
    revisit if a row with id has its payload. Null html is an empty payload.
    Rows that repeat an id are records of their own. The smallest id per payload
    is aggregated before the shuffle, on digests alone.
    """
    ship(pages)
    source = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"),
                          F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    source = source.withColumn("digest", F.sha2(F.encode("html", "UTF-8"), 256))
    long = source.where(F.octet_length("html") >= LEAST_REVISIT)
    shared = (long.groupBy("digest").agg(F.min("page").alias("lowest"), F.count("*").alias("n"))
              .where("n > 1 and lowest is not null").select("digest", "lowest"))
    marked = source.join(shared, "digest", "left").select(
        F.monotonically_increasing_id().alias("key"), "page", "url", "html", "digest",
        F.when(F.col("lowest").isNotNull() & ~F.col("page").eqNullSafe(F.col("lowest")), F.col("lowest")).alias("refers"))
    (marked.mapInArrow(_recorder, "value string").write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of every record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(_EOL)
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no record starts at byte {at}")
        fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        begin = end + 4
        stop = begin + int(fields["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} is not as long as it says")
        yield fields, data[begin:stop]
        at = stop + 4


def _decoded(block: bytes) -> bytes:
    head = block.index(b"\r\n\r\n")
    body = block[head + 4 :]
    framed = any(x.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for x in block[:head].split(b"\r\n"))
    return unframe_chunked(body) if framed else body


_PAGE = "page string, url string, type string, payload binary, bytes long, digest string, refers string"
_PART = "origin string, segment int, total long, page string, url string, block binary"


def _row(fields: dict[str, str], block: bytes) -> tuple:
    page, url = fields.get("X-Page-ID"), fields.get("WARC-Target-URI")
    if fields["WARC-Type"] == "revisit":
        return page, url, "revisit", None, int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].split(":")[1], fields["X-Refers-To-Page-ID"]
    payload = _decoded(block)
    return page, url, "response", payload, len(payload), hashlib.sha256(payload).hexdigest(), None


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


_PAGE_ARROW = (["page", "url", "type", "payload", "bytes", "digest", "refers"],
               [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string()])
_PART_ARROW = (["origin", "segment", "total", "page", "url", "block"],
               [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary()])


def _parser(segments: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = _PART_ARROW if segments else _PAGE_ARROW
        for b in batches:
            for data in b.column("content"):
                rows: list[tuple] = []
                raw = data.as_py()
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                for fields, block in parse_records(raw):
                    if ("WARC-Segment-Number" in fields) != segments:
                        continue
                    if segments:
                        total = fields.get("WARC-Segment-Total-Length")
                        rows.append((fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"]), int(fields["WARC-Segment-Number"]),
                                     int(total) if total else None, fields.get("X-Page-ID"), fields.get("WARC-Target-URI"), block))
                    else:
                        rows.append(_row(fields, block))
                    if len(rows) == 256:
                        yield _batch(rows, *shape)
                        rows = []
                yield _batch(rows, *shape)
    return run


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for origin, parts in zip(b.column("origin").to_pylist(), b.column("parts")):
            parts = parts.as_py()
            if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                raise ValueError(f"record {origin} lacks a segment")
            block = b"".join(p["block"] for p in parts)
            if parts[-1]["total"] != len(block):
                raise ValueError(f"record {origin} has {len(block)} bytes, not {parts[-1]['total']}")
            first = {"WARC-Type": "response"}
            for name, value in (("X-Page-ID", parts[0]["page"]), ("WARC-Target-URI", parts[0]["url"])):
                if value is not None:
                    first[name] = value
            yield _batch([_row(first, block)], *_PAGE_ARROW)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page, url, type, payload, bytes, digest, refers) of every page in the archives under path.

    payload is null for revisits, whose length and digest come from their
    header. A missing segment, a wrong length or broken framing raises an error.
    The segments of one page meet in one group, which is as long as the page.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    ship(files)
    whole = files.mapInArrow(_parser(False), _PAGE)
    parts = files.mapInArrow(_parser(True), _PART)
    grouped = parts.groupBy("origin").agg(F.sort_array(F.collect_list(F.struct("segment", "total", "page", "url", "block"))).alias("parts"))
    return whole.unionByName(grouped.mapInArrow(_assemble, _PAGE))


def round_trip(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Writes the archives of pages to the shared folder and reads them back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_warc(pages, path, id_col)
    kind = pages.schema[id_col].dataType
    return read_warc(pages.sparkSession, path).select(
        F.col("page").cast(kind).alias(id_col), F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers").cast(kind).alias("refers_to"))
