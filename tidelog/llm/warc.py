"""Legacy web archives: ARC files of either version, converted to WARC.

An ARC file begins with a version block that names the fields of its header lines; every record then
has one header line, ending in its declared length, and that many bytes.  The converter synthesises
what WARC asks for: record ids, timestamps, types and digests; a payload seen before becomes a revisit.
Files are written by Spark's text writer, one record a row, and read whole by its binary reader; the
number of archives follows the bytes, so that an archive is small enough for a task.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.common import checkpointed, column, forget, slices
from tidelog.session import scratch_folder

#: Payload bytes of an archive before compression.
ARCHIVE_BYTES = 24 << 20
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT_BYTES = 0
#: Up to so many payloads that occur twice or more are sent to every task (about 100 bytes each); more are joined by
#: a shuffle.
MAX_SENT = 100_000
#: Fixed values of the formats: header fields of ARC versions 1 and 2, and the WARC revisit profile.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORDS = "page_id long, url string, date string, content_type string, head binary, payload binary, digest string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _http(page_id: int | None, size: int) -> bytes:
    own = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{own}Content-Length: {size}\r\n\r\n".encode()


def arc_version_block(version: int, date: str) -> str:
    """The first record of an archive, without its last newline."""
    body = f"{version} 0 tidelog\n{ARC_FIELDS[version]}\n"
    own = f"filedesc://pages-v{version}.arc 0.0.0.0 {date} text/plain"
    rest = "" if version == 1 else " 200 - - 0 pages-v2.arc"
    return f"{own}{rest} {len(body)}\n{body}"


def arc_record(version: int, page_id: int | None, url: str | None, date: str, html: str | None) -> bytes:
    """Header line and content of a page; spaces in a url, which would end the field, are escaped."""
    payload = (html or "").encode()
    content = _http(page_id, len(payload)) + payload
    target = re.sub(r"\s", lambda m: "".join(f"%{b:02X}" for b in m.group().encode()), url or "") or "-"
    rest = "" if version == 1 else " 200 - - 0 pages-v2.arc"
    return f"{target} 0.0.0.0 {date} text/html{rest} {len(content)}\n".encode() + content


def _arc_rows(date: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    version, begun = 1 + TaskContext.get().partitionId() % 2, False
    for batch in batches:
        for part in slices(batch, 2):
            rows = [arc_record(version, p, u, date, h) for p, u, h in zip(*[part.column(i).to_pylist() for i in range(3)])]
            if rows and not begun:
                rows.insert(0, arc_version_block(version, date).encode())
                begun = True
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])


def write_arc(pages: DataFrame, folder: str, date: str = "20240101000000") -> None:
    """Pages (page_id, url, html) as gzipped ARC files, of versions 1 and 2 in turn."""
    total = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    count = max(1, -(-total // ARCHIVE_BYTES))
    (pages.select("page_id", "url", "html").repartition(count, "page_id", "url")
     .mapInArrow(partial(_arc_rows, date), "value binary").select(F.col("value").cast("string"))
     .write.option("compression", "gzip").option("lineSep", "\n").text(folder))


def _exactly(stream, size: int, path: str) -> bytes:
    data = stream.read(size)
    if len(data) != size:
        raise ValueError(f"{path}: a record is shorter than its declared length")
    return data


def _fields(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines if x)}


def _split_http(content: bytes) -> tuple[bytes, bytes]:
    at = content.find(b"\r\n\r\n")
    return (content[:at + 4], content[at + 4:]) if content.startswith(b"HTTP/") and at >= 0 else (b"", content)


def parse_arc(data: bytes, path: str) -> Iterator[tuple]:
    """Records of an ARC file: page_id, url, date, content type, HTTP head, payload, digest."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    names: list[str] = []
    while line := stream.readline():
        if not line.strip():
            continue  # the newline between records
        text = line.rstrip(b"\r\n").decode("utf-8", "replace")
        if not names:  # the version block stands first; a later record may have any url
            if not text.startswith("filedesc://"):
                raise ValueError(f"{path}: no version block")
            body = _exactly(stream, int(text.rsplit(" ", 1)[1]), path).decode().split("\n")
            version = int(body[0].split(" ")[0])
            names = body[1].split(" ")
            if version not in ARC_FIELDS or names != ARC_FIELDS[version].split(" "):
                raise ValueError(f"{path}: unknown ARC version block {body[:2]}")
            continue
        header = dict(zip(names, text.rsplit(" ", len(names) - 1)))  # old urls may hold spaces
        head, payload = _split_http(_exactly(stream, int(header["Archive-length"]), path))
        page_id = _fields(head).get("x-page-id") if head else None
        yield (None if page_id is None else int(page_id), header["URL"], header["Archive-date"], header["Content-type"],
               head, payload, digest_of(payload))


def _files(parse, types: list[tuple[str, pa.DataType]], pick, batches: Iterator[pa.RecordBatch]):
    """Rows of whole files, in batches of a bounded number of bytes."""
    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), types)],
                                          names=[n for n, _ in types])

    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            rows, size = [], 0
            for record in parse(content.as_py(), path.as_py()):
                rows.append(pick(record))
                size += sum(len(v) for v in rows[-1] if isinstance(v, bytes)) + 100
                if size > 8 << 20:
                    yield made(rows)
                    rows, size = [], 0
            if rows:
                yield made(rows)


def _opened(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).where("length > 0").select("path", "content")


def _digests_only(record):
    return record[0], record[6], len(record[5])


def _whole(record):
    return record


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all ARC files of a folder."""
    types = [("page_id", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("content_type", pa.string()),
             ("head", pa.binary()), ("payload", pa.binary()), ("digest", pa.string())]
    return _opened(spark, folder).mapInArrow(partial(_files, parse_arc, types, _whole), RECORDS)


def first_copies(spark: SparkSession, folder: str, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """digest and smallest page_id of every payload that occurs twice or more."""
    types = [("page_id", pa.int64()), ("digest", pa.string()), ("size", pa.int64())]
    found = _opened(spark, folder).mapInArrow(partial(_files, parse_arc, types, _digests_only),
                                              "page_id long, digest string, size long")
    return (found.where(F.col("size") >= min_bytes).groupBy("digest")
            .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first"))


def warc_record(kind: str, page_id: int | None, url: str, date: str, head: bytes, payload: bytes, digest: str,
                first: int | None) -> bytes:
    """A WARC record without its last newline."""
    block = head + payload if kind == "response" else head
    when = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {when}",
             f"WARC-Target-URI: {url}", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{digest_of(block)}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(first, digest)}",
                  f"X-Refers-To-Page-Id: {first}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r"


def _warc_info() -> bytes:
    body = "software: tidelog\r\nformat: WARC File Format 1.0\r\n"
    own = uuid.uuid5(uuid.NAMESPACE_URL, f"warcinfo:{TaskContext.get().partitionId()}")
    return (f"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{own}>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n{body}\r\n\r").encode()


def _warc_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begun = False
    for batch in batches:
        rows = []
        for page_id, url, date, head, payload, digest, first in zip(*[c.to_pylist() for c in batch.columns]):
            kind = "revisit" if first is not None and (page_id is None or page_id > first) else "response"
            rows.append(warc_record(kind, page_id, url, date, head, payload, digest, first))
        if rows and not begun:
            rows.insert(0, _warc_info())
            begun = True
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])


def convert(spark: SparkSession, arc_folder: str, warc_folder: str, min_bytes: int = MIN_REVISIT_BYTES,
            max_sent: int = MAX_SENT) -> None:
    """Write the records of all ARC files as gzipped WARC files.

    Of equal payloads of ``min_bytes`` or more the one with the smallest page id is a response and the
    others are revisits of it.  Rows that repeat the smallest id stay responses; a record without an id
    is a revisit if a copy has one, else a response.
    """
    firsts = checkpointed(first_copies(spark, arc_folder, min_bytes))
    if firsts.count() <= max_sent:
        firsts = F.broadcast(firsts)
    records = read_arc(spark, arc_folder).join(firsts, "digest", "left")
    (records.select("page_id", "url", "date", "head", "payload", "digest", "first")
     .mapInArrow(_warc_rows, "value binary").select(F.col("value").cast("string"))  # the bytes as they are
     .write.option("compression", "gzip").option("lineSep", "\n").text(warc_folder))


def parse_warc(data: bytes, path: str) -> Iterator[tuple]:
    """page_id, payload bytes and digest, record type and page referred to, of each response and revisit."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data))) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := stream.readline():
        if line != b"WARC/1.0\r\n":
            raise ValueError(f"{path}: not a WARC record: {line[:40]!r}")
        lines = [line]
        while (line := stream.readline()) not in (b"\r\n", b""):
            lines.append(line)
        header = _fields(b"".join(lines))
        block = _exactly(stream, int(header["content-length"]), path)
        if _exactly(stream, 4, path) != b"\r\n\r\n":
            raise ValueError(f"{path}: a record does not end after its declared length")
        kind = header["warc-type"]
        if kind not in ("response", "revisit"):
            continue
        head, payload = _split_http(block)
        http = _fields(head)
        digest = header["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and digest_of(payload) != digest:
            raise ValueError(f"{path}: payload does not match its digest")
        size = len(payload) if kind == "response" else int(http["content-length"])
        page, refers = http.get("x-page-id"), header.get("x-refers-to-page-id")
        yield (None if page is None else int(page), size, digest, kind, None if refers is None else int(refers))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """What the responses and revisits of all WARC files of a folder say."""
    types = [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64())]
    return _opened(spark, folder).mapInArrow(
        partial(_files, parse_warc, types, _whole),
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages written as ARC, converted to WARC, and read back, in new folders below the shared one.

    A null page has an empty payload, which counts as equal to other empty ones; a null url is kept as
    "-"; an empty table gives no rows.  Other columns are not read.
    """
    spark = pages.sparkSession
    arc, warc = scratch_folder(spark, "arc"), scratch_folder(spark, "warc")
    write_arc(pages.select(column(id_col).alias("page_id"), column(url_col).alias("url"), column(html_col).alias("html")), arc)
    convert(spark, arc, warc)
    forget(spark, arc)
    return read_warc(spark, warc)
