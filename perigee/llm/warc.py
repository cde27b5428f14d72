"""Web archives: pages to legacy ARC files, ARC to WARC, and WARC back to rows.

Archives are written by Spark's text writer, whose tasks commit as a whole, so a lost executor leaves no half archive;
every file is one gzip stream of records in UTF-8. Readers decompress and parse a file as a stream, record by record,
by the lengths that the headers declare; payloads may hold anything, line ends and header look-alikes included.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perigee.llm.common import arrow_map, batch, store, table
from perigee.session import scratch_path

# Fixed by the file formats: header fields of an ARC record by version of the file, and their description lines.
ARC_FIELDS = {
    "1": ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    "2": ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "20200101000000"
MIN_REVISIT_BYTES = 1000
OUT_BYTES = 8 << 20


def http_block(page_id: int | None, payload: bytes) -> bytes:
    ident = "" if page_id is None else str(page_id)
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {ident}\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload


def split_http(block: bytes) -> tuple[dict[str, str], bytes]:
    """Lower-case header fields and payload of an HTTP message; without a header end, all is payload."""
    head, end, payload = block.partition(b"\r\n\r\n")
    if not end or not head.startswith(b"HTTP/"):
        return {}, block
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}, payload


def arc_url(url: str | None) -> str:
    """The URL as one field of a header line: white space and control characters escaped, nothing as a dash."""
    out = re.sub(r"[\x00-\x20\x7f\x85  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")
    return out or "-"


def arc_version_block(name: str, version: str) -> bytes:
    body = f"{version} 0 perigee\n{' '.join(ARC_FIELDS[version])}\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": "0.0.0.0", "Archive-date": DATE, "Content-type": "text/plain", "Result-code": "200", "Filename": name}
    return arc_header(version, values, len(body)) + body


def arc_header(version: str, values: dict[str, str], length: int) -> bytes:
    values = values | {"Archive-length": str(length)}
    return (" ".join(values.get(f) or "-" for f in ARC_FIELDS[version]) + "\n").encode()


class Stream:
    """Reads lines and byte counts from a gzip stream of one or several members, holding one record at most."""

    def __init__(self, data: bytes):
        self.data, self.at, self.buffer, self.start = memoryview(data), 0, bytearray(), 0
        self.inflate = zlib.decompressobj(31)

    def _more(self) -> bool:
        while self.at < len(self.data):
            piece = self.data[self.at : self.at + (1 << 18)]
            out = self.inflate.decompress(piece)
            self.at += len(piece) - len(self.inflate.unused_data)
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            if out:
                del self.buffer[: self.start]
                self.start = 0
                self.buffer += out
                return True
        return False

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the stream."""
        seen = self.start
        while (end := self.buffer.find(b"\n", seen)) < 0:
            seen = len(self.buffer) - self.start
            if not self._more():
                rest = bytes(self.buffer[self.start :])
                self.start = len(self.buffer)
                return rest or None
            seen += self.start
        out = bytes(self.buffer[self.start : end])
        self.start = end + 1
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.start < n and self._more():
            pass
        if len(self.buffer) - self.start < n:
            raise ValueError("archive ends inside a record")
        out = bytes(self.buffer[self.start : self.start + n])
        self.start += n
        return out


def read_arc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header, block)`` of every record after the version block, whose second line names the header's fields."""
    stream = Stream(data)
    fields: list[str] = []
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        parts = line.decode("utf-8").split(" ")
        block = stream.take(int(parts[-1]))
        if parts[0].startswith("filedesc://"):
            version, names = block.decode().split("\n")[:2]
            fields = names.split(" ")
            if tuple(fields) != ARC_FIELDS.get(version.split(" ")[0]):
                raise ValueError(f"unknown ARC version {version!r} with fields {names!r}")
            continue
        if len(parts) != len(fields):
            raise ValueError(f"ARC header has {len(parts)} fields, {len(fields)} are declared")
        yield dict(zip(fields, parts)), block


def read_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header, block)`` of every record; names of header fields are lower-case."""
    stream = Stream(data)
    while (line := stream.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        head: dict[str, str] = {}
        while line := stream.line().rstrip(b"\r"):
            name, _, value = line.decode("utf-8").partition(":")
            head[name.strip().lower()] = value.strip()
        yield head, stream.take(int(head["content-length"]))


def record_id(page_id: str, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>"


def warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def texts(parts: Iterator[bytes]) -> Iterator[pa.RecordBatch]:
    """Record bytes as rows of text for the text writer, which ends every row with a line feed: the record's last byte."""
    held, size = [], 0
    for part in parts:
        held.append(part[:-1].decode("utf-8"))
        size += len(part)
        if size >= OUT_BYTES:
            yield batch(value=pa.array(held, pa.string()))
            held, size = [], 0
    if held:
        yield batch(value=pa.array(held, pa.string()))


def write_texts(df: DataFrame, path: str) -> None:
    df.write.option("compression", "gzip").option("lineSep", "\n").text(path)


def write_arc(pages: DataFrame, path: str, version: str | None = None) -> None:
    """One ARC file per partition of ``(page_id, url, html)``; without ``version``, odd partitions have version 2."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        v = version or "12"[part % 2]

        def records() -> Iterator[bytes]:
            yield arc_version_block(f"part-{part}.arc", v)
            for b in batches:
                for page_id, url, html in zip(*(c.to_pylist() for c in b.columns)):
                    block = http_block(page_id, html or b"")
                    values = {"URL": arc_url(url), "IP-address": "0.0.0.0", "Archive-date": DATE, "Content-type": "text/html", "Result-code": "200", "Filename": f"part-{part}.arc"}
                    yield arc_header(v, values, len(block)) + block + b"\n"

        yield from texts(records())

    write_texts(arrow_map(pages.select("page_id", "url", F.col("html").cast("binary").alias("html")), run, "value string"), path)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")


def arc_index(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, url, digest, bytes)`` of every ARC record; payloads stay where they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows = []
                for head, block in read_arc(data.as_py()):
                    http, payload = split_http(block)
                    rows.append((http.get("x-page-id", ""), head["URL"], hashlib.sha1(payload).hexdigest(), len(payload)))
                cols = list(zip(*rows)) or [[], [], [], []]
                yield batch(page_id=pa.array(cols[0], pa.string()), url=pa.array(cols[1], pa.string()), digest=pa.array(cols[2], pa.string()), bytes=pa.array(cols[3], pa.int64()))

    return arrow_map(archive_files(spark, path), run, "page_id string, url string, digest string, bytes bigint")


def revisits(index: DataFrame, min_bytes: int) -> DataFrame:
    """``(page_id, url, digest, first_page, first_url)`` of records whose payload the record with the largest page id holds.

    Page ids order as numbers. Copies are reduced to one row per payload before the shuffle. Of repeated rows of one
    page, all but none are revisits: rows that equal the kept one in every column stay responses with one identifier.
    """
    big = index.filter(F.col("bytes") >= min_bytes)
    best = big.groupBy("digest", "bytes").agg(F.max(F.struct(F.col("page_id").try_cast("long").alias("n"), "page_id", "url")).alias("m"), F.count("*").alias("copies"))
    best = best.filter("copies > 1").select("digest", "bytes", F.col("m.page_id").alias("first_page"), F.col("m.url").alias("first_url"))
    return big.join(best, ["digest", "bytes"]).filter("page_id <> first_page or url <> first_url").select("page_id", "url", "digest", "first_page", "first_url").distinct()


def arc_to_warc(spark: SparkSession, arc: str, warc: str, min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Converts a folder of ARC files to WARC files: identifiers from the content, ISO dates, types, SHA-1 digests.

    First the index decides which records revisit others; then records meet these decisions. The table of revisits is
    stored, so Spark sends it to all tasks if it is small and otherwise shuffles both sides.
    """
    decided = store(revisits(store(arc_index(spark, arc)), min_bytes).withColumnsRenamed({"page_id": "_p", "url": "_u", "digest": "_d"}))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows, size = [], 0
                for head, block in read_arc(data.as_py()):
                    http, payload = split_http(block)
                    rows.append((http.get("x-page-id", ""), head["URL"], hashlib.sha1(payload).hexdigest(), head["IP-address"], head["Archive-date"], block))
                    size += len(block)
                    if size >= OUT_BYTES:
                        yield parsed(rows)
                        rows, size = [], 0
                yield parsed(rows)

    def parsed(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [[]] * 6
        names = ("page_id", "url", "digest", "ip", "date")
        return batch(**{n: pa.array(c, pa.string()) for n, c in zip(names, cols)}, block=pa.array(cols[5], pa.binary()))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for b in batches:
                for page_id, url, digest, ip, date, block, first_page, first_url in zip(*(c.to_pylist() for c in b.columns)):
                    when = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
                    fields = [("WARC-Record-ID", record_id(page_id, url, digest)), ("WARC-Date", when), ("WARC-Target-URI", url), ("WARC-IP-Address", ip), ("WARC-Payload-Digest", f"sha1:{digest}")]
                    if first_page is None:
                        yield warc_record([("WARC-Type", "response"), *fields, ("Content-Type", "application/http; msgtype=response")], block)
                    else:
                        head = block.partition(b"\r\n\r\n")[0] + b"\r\n\r\n"
                        more = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(first_page, first_url, digest)), ("WARC-Refers-To-Target-URI", first_url)]
                        yield warc_record([("WARC-Type", "revisit"), *fields, *more, ("Content-Type", "application/http; msgtype=response")], head)

        yield from texts(records())

    records = arrow_map(archive_files(spark, arc), parse, "page_id string, url string, digest string, ip string, date string, block binary")
    same = (F.col("page_id") == F.col("_p")) & (F.col("url") == F.col("_u")) & (F.col("digest") == F.col("_d"))
    joined = records.join(decided, same, "left").select("page_id", "url", "digest", "ip", "date", "block", "first_page", "first_url")
    write_texts(arrow_map(joined, write, "value string"), warc)


def warc_rows(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every record of a folder of WARC files.

    A response's digest is computed anew and must be the declared one. A revisit gets its payload's size and page id
    from the record it refers to, found by a join on the record identifier.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows = []
                for head, block in read_warc(data.as_py()):
                    http, payload = split_http(block)
                    declared = head["warc-payload-digest"].removeprefix("sha1:")
                    if head["warc-type"] == "response" and hashlib.sha1(payload).hexdigest() != declared:
                        raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
                    page = http.get("x-page-id", "")
                    rows.append((int(page) if page else None, len(payload), declared, head["warc-type"], head["warc-record-id"], head.get("warc-refers-to")))
                cols = list(zip(*rows)) or [[]] * 6
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string())
                yield batch(**{n: pa.array(c, t) for n, c, t in zip(("page_id", "payload_bytes", "payload_digest", "record_type", "id", "refers"), cols, types)})

    rows = store(arrow_map(archive_files(spark, path), run, "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, id string, refers string"))
    first = rows.filter("record_type = 'response'").groupBy(F.col("id").alias("refers")).agg(F.first("page_id").alias("first_page"), F.first("payload_bytes").alias("full_bytes"))
    found = rows.filter("record_type = 'revisit'").join(first, "refers", "left")
    common = ("payload_digest", "record_type")
    return rows.filter("record_type <> 'revisit'").select("page_id", "payload_bytes", *common, F.lit(None).cast("bigint").alias("refers_to")).unionByName(
        found.select("page_id", F.col("full_bytes").alias("payload_bytes"), *common, F.col("first_page").alias("refers_to"))
    )


def op8_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    arc_to_warc(spark, arc, warc)
    return warc_rows(spark, warc)


QUERIES = {"op8_arc_to_warc": op8_arc_to_warc}
ORACLES = {
    "op8_arc_to_warc": """
with p as (select page_id, encode(coalesce(html, '')) as b from pages),
d as (select page_id, octet_length(b)::bigint as payload_bytes, sha1(b) as payload_digest from p),
m as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as last_page from d)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < last_page then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < last_page then last_page end as refers_to
from m
"""
}
