"""Legacy web archives to WARC.

An ARC file starts with a version block; its second line gives the version, and with it the fields
of the header line of each record: five in version 1, ten in version 2. Records are cut by their
declared lengths. Each becomes a WARC record with an identifier made from the file's name and the
record's offset, its date in ISO form, a type and digests of payload and block. The type comes from
the record, not from its URL: warcinfo for the version block, response for what starts with an HTTP
status line, resource for the rest (such as dns: records). Of responses with equal payloads the one
with the smallest order key stays; the others become revisits that refer to it.

Archives are read as streams, record by record: a task holds one file as it is stored (these formats
usually have 100 MB) and one record. ``write_arc`` and ``write_warc`` write gzip files of at most
``per_file`` records; plain files are read as well.

Nulls: a null payload is empty, a null url is written as "unknown:", a null id is left out and
read back as null. Equal rows become separate records. Empty tables give archives without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import mapped

#: The header lines of the two versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CONVERTED = "page_id long, type string, record_id string, uri string, ip string, date string, mime string, head binary, payload binary, payload_length long, payload_digest string, block_digest string"
READ = "page_id long, type string, record_id string, refers_to_id string, uri string, date string, payload_length long, payload_digest string, digest_ok boolean"
BATCH_BYTES = 4 << 20
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def parse_arc(stream: BinaryIO) -> Iterator[tuple[int, list[str], bytes]]:
    """Offset, header fields and content of each record; the first is the version block."""
    at, width = 0, 0
    while line := stream.readline():
        start = at
        at += len(line)
        if line.strip(b"\r\n") == b"":
            continue
        fields = line.decode("utf-8", "replace").rstrip("\r\n")
        if width:
            fields = fields.rsplit(" ", width - 1)
            if len(fields) != width or not fields[-1].isdigit():
                raise ValueError(f"bad record header at {start}: {line[:80]!r}")
        elif fields.startswith("filedesc:"):
            fields = fields.split(" ")
        else:
            raise ValueError(f"no version block at {start}: {line[:80]!r}")
        size = int(fields[-1])
        content = stream.read(size)
        if len(content) < size:
            raise ValueError(f"record at {start} declares {size} bytes; the file ends before")
        at += size
        if not width:
            version = int(content.split(b" ", 1)[0])
            if version not in FIELDS:
                raise ValueError(f"unknown ARC version {version}")
            width = FIELDS[version].count(" ") + 1
        yield start, fields, content


def iso_date(stamp: str) -> str:
    """From 14 digits, or fewer (missing parts are the first of their range)."""
    full = stamp + "00000101000000"[len(stamp) :]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


HEAD_END = re.compile(rb"\r?\n\r?\n")


def http_header(head: bytes, name: str) -> str | None:
    for line in head.split(b"\n"):
        key, colon, value = line.partition(b":")
        if colon and key.strip().lower() == name.encode():
            return value.strip().decode("utf-8", "replace")
    return None


def page_of(head: bytes) -> int | None:
    """The number in our own header; anything else that an archive has there is none."""
    found = http_header(head, "x-page-id")
    return int(found) if found and re.fullmatch("-?[0-9]{1,18}", found) else None


def split_http(content: bytes) -> tuple[bytes, bytes] | None:
    """Header and payload of an HTTP response, whose header may end in plain line feeds."""
    end = HEAD_END.search(content) if content.startswith(b"HTTP/") else None
    return (content[: end.end()], content[end.end() :]) if end else None


def convert_record(file: str, offset: int, fields: list[str], content: bytes) -> tuple:
    uri, ip, stamp, mime = fields[:4]
    parts = split_http(content) if offset else None
    head, payload = parts or (b"", content)
    kind = "response" if parts else "resource" if offset else "warcinfo"
    name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{offset}')}>"
    return (page_of(head), kind, name, uri, ip, iso_date(stamp), mime, head, payload, len(payload), sha1_32(payload), sha1_32(content))


def converted(file: str, data: bytes) -> Iterator[tuple]:
    """The records of a file; where it breaks off or isn't an archive, a row of the type "broken" with the file and the
    error ends them."""
    try:
        for record in parse_arc(_plain(data)):
            yield convert_record(file, *record)
    except (ValueError, IndexError, EOFError, OSError, zlib.error) as error:
        name = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#broken')}>"
        yield (None, "broken", name, file, None, None, f"{type(error).__name__}: {error}"[:500], b"", b"", 0, sha1_32(b""), sha1_32(b""))


def _rows(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of about BATCH_BYTES."""
    part, size = [], 0
    for row, n in rows:
        part.append(row)
        size += n
        if size > BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split(" ") for x in ddl.split(", "))])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def _plain(data: bytes) -> BinaryIO:
    """A stream of what a file holds, inflated as it is read."""
    raw = io.BytesIO(data)
    return gzip.GzipFile(fileobj=raw) if data[:2] == b"\x1f\x8b" else raw


def _first_in_file(per_file: int) -> Column:
    """True for the rows of a partition with which a file of ``per_file`` records starts."""
    return F.pmod(F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1), F.lit(per_file)) == 0


def write_arc(pages: DataFrame, path: str, *, version: int | Column = 1, url: str = "url", html: str = "html", key: str = "page_id", per_file: int = 20_000) -> None:
    """Each page as an ARC record that holds an HTTP response; ``version`` may depend on the partition."""
    version = F.lit(version) if isinstance(version, int) else version
    content = F.coalesce(F.col(html), F.lit(""))
    link = F.coalesce(F.regexp_replace(F.col(url), "[\\x00-\\x20\\x7F]", "%20"), F.lit("unknown:"))
    stamp = F.date_format(F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.coalesce(F.col(key), F.lit(0)).cast("long"), F.lit(1 << 28))), "yyyyMMddHHmmss")
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col(key).cast("string"), F.lit("\r\n")), F.lit("")),
        F.lit("Content-Length: "), F.octet_length(content).cast("string"), F.lit("\r\n\r\n"),
    )
    block = F.concat(head, content)
    size = F.octet_length(block).cast("string")
    line = F.when(F.col("v") == 1, F.concat_ws(" ", "link", F.lit("0.0.0.0"), "stamp", F.lit("text/html"), "size")).otherwise(
        F.concat_ws(" ", "link", F.lit("0.0.0.0"), "stamp", F.lit("text/html"), F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc"), "size")
    )
    about = {v: f"{v} 0 millrace\n{FIELDS[v]}\n" for v in FIELDS}
    start = F.when(F.col("v") == 1, f"filedesc://pages.arc 0.0.0.0 20240101000000 text/plain {len(about[1])}\n{about[1]}\n").otherwise(
        f"filedesc://pages.arc 0.0.0.0 20240101000000 text/plain 200 - - 0 pages.arc {len(about[2])}\n{about[2]}\n"
    )
    rows = pages.select(version.alias("v"), link.alias("link"), stamp.alias("stamp"), size.alias("size"), block.alias("block"), _first_in_file(per_file).alias("first"))
    rows.select(F.concat(F.when(F.col("first"), start).otherwise(""), line, F.lit("\n"), "block").alias("value")).write.options(**GZIP, lineSep="\n", maxRecordsPerFile=per_file).text(path)


def convert(spark: SparkSession, path: str) -> DataFrame:
    """Records of the ARC files below ``path``, with what their WARC headers need. Records are named by their file's place
    below ``path``. A file that is broken gives its records up to there, then one of the type "broken" (uri: the file,
    mime: the error), which ``write_warc`` leaves out; the others don't suffer."""
    schema, root = _arrow(CONVERTED), path.rstrip("/").rsplit("/", 1)[-1] + "/"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = ((p.as_py(), c.as_py()) for batch in batches for p, c in zip(batch.column(0), batch.column(1), strict=True))
        yield from _rows(((r, len(r[8])) for p, c in files for r in converted(p.split(f"/{root}", 1)[-1], c)), schema)

    return mapped(_files(spark, path), run, CONVERTED)


def write_warc(records: DataFrame, path: str, *, order: str = "page_id", least: int = 0, per_file: int = 20_000) -> None:
    """Converted records as WARC files. Of responses with equal payloads of ``least`` bytes at
    least, the first by ``order`` (null last) is written whole, the others as revisits."""
    records = records.filter(F.col("type") != "broken")
    eligible = (F.col("type") == "response") & (F.col("payload_length") >= least)
    rank = F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("by"), F.col("record_id").alias("id"), F.col("uri").alias("uri"), F.col("date").alias("date"))
    first = records.filter(eligible).groupBy("payload_digest").agg(F.min(rank).alias("first"))
    first = first.select(F.col("payload_digest").alias("same"), F.col("first.id").alias("origin"), F.col("first.uri").alias("origin_uri"), F.col("first.date").alias("origin_date"))
    joined = records.join(first, eligible & (F.col("payload_digest") == F.col("same")), "left")
    again = F.col("origin").isNotNull() & (F.col("origin") != F.col("record_id"))
    field = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))
    block = F.when(again, F.col("head")).otherwise(F.concat("head", "payload"))
    is_http = F.col("type") == "response"
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.when(again, "revisit").otherwise(F.col("type"))),
        field("WARC-Record-ID", F.col("record_id")),
        field("WARC-Date", F.col("date")),
        field("WARC-Target-URI", F.when(F.col("type") != "warcinfo", F.col("uri"))),
        field("WARC-IP-Address", F.when(F.col("type") != "warcinfo", F.col("ip"))),
        field("WARC-Filename", F.when(F.col("type") == "warcinfo", F.regexp_replace("uri", "^filedesc://", ""))),
        field("Content-Type", F.when(is_http, "application/http; msgtype=response").when(F.col("type") == "warcinfo", "application/warc-fields").otherwise(F.col("mime"))),
        field("WARC-Payload-Digest", F.when(F.col("type") != "warcinfo", F.concat(F.lit("sha1:"), "payload_digest"))),
        field("WARC-Block-Digest", F.when(~again, F.concat(F.lit("sha1:"), "block_digest"))),
        field("WARC-Profile", F.when(again, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        field("WARC-Refers-To", F.when(again, F.col("origin"))),
        field("WARC-Refers-To-Target-URI", F.when(again, F.col("origin_uri"))),
        field("WARC-Refers-To-Date", F.when(again, F.col("origin_date"))),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    joined.select(F.concat(head, block.cast("string")).alias("value")).write.options(**GZIP, lineSep="\r\n\r\n", maxRecordsPerFile=per_file).text(path)


def parse_warc(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Named fields (in lower case) and block of each record."""
    at = 0
    while line := stream.readline():
        if not line.strip(b"\r\n"):
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record at record {at}: {line[:80]!r}")
        fields = {}
        while (line := stream.readline()).strip(b"\r\n"):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"record {at} declares {size} bytes; the file ends before")
        yield fields, block
        at += 1


def _read_record(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["warc-type"]
    head, payload = (split_http(block) if kind in ("response", "revisit") else None) or (b"", block)
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    whole = kind in ("response", "resource")
    size = len(payload) if whole else None
    return (page_of(head), kind, fields["warc-record-id"], fields.get("warc-refers-to"), fields.get("warc-target-uri"), fields["warc-date"], size, digest, sha1_32(payload) == digest if whole else None)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files below ``path``; digest_ok tells whether a whole payload has its
    digest. A revisit has no payload: its payload_length is null, and that of the record it refers to is its own."""
    schema = _arrow(READ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = (c.as_py() for batch in batches for c in batch.column(1))
        yield from _rows(((_read_record(*r), 300) for c in files for r in parse_warc(_plain(c))), schema)

    return mapped(_files(spark, path), run, READ)


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, octet_length(encode(html))::bigint AS payload_bytes, sha1(html) AS hex FROM p),
n AS (SELECT *, list_transform(range(40), lambda i: instr('0123456789abcdef', hex[i + 1]) - 1) AS nib FROM h),
b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(((nib[(5 * i) // 4 + 1] * 16 + coalesce(nib[(5 * i) // 4 + 2], 0)) >> (3 - (5 * i) % 4)) & 31) + 1]), '') AS payload_digest FROM n)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = min(page_id) OVER w THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = min(page_id) OVER w THEN NULL ELSE min(page_id) OVER w END AS refers_to
FROM b WINDOW w AS (PARTITION BY payload_digest)
"""
