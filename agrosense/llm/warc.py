"""WARC archives with revisit records for repeated payloads.

Only headers (page id, payload length, digests) decide which record stands for a payload:
grouped by digest they give the smallest page id of each payload that occurs more than once.
Pages joined with those originals become ``revisit`` records without payload; all others are
``response`` records. The archives are plain WARC 1.1 files written by Spark's text writer:
a record is one string and the record end (two line breaks) is the line separator, so task
commit and any file system Spark knows apply. They are read back as binary files and parsed
record by record along their ``Content-Length``.

Defined cases: a null html is an empty payload; a null url is written as ``urn:page:<id>``;
pages below ``min_bytes`` are always responses; rows that repeat a page id with its payload
agree with each other; a null page id never stands for a payload unless no other row has it;
an empty table gives no record. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrosense.llm.common import ship, stored

ship(__name__)

CRLF = "\r\n"
RECORD_END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 4_000
BASE32_HEX, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base32 digits."""
    hexed = F.sha1(payload.cast("binary"))
    parts = [F.lpad(F.upper(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32)), 4, "0")
             for i in range(8)]
    return F.translate(F.concat(*parts), BASE32_HEX, BASE32)


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", page_id.cast("string"), digest).cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]),
                    F.lit(">"))


def resolve_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, bytes, digest, first_id, first_url``: ``first_id`` is the page
    whose record a revisit refers to, null for responses."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    heads = pages.select("page_id", F.col("url").cast("string").alias("url"), html.alias("html"),
                         F.octet_length(html).cast("long").alias("bytes"),
                         base32_sha1(html).alias("digest"), F.xxhash64(html).alias("check"))
    key = ["digest", "bytes", "check"]
    originals = (heads.select("page_id", "url", *key).where(F.col("bytes") >= min_bytes)
                 .groupBy(*key).agg(F.min("page_id").alias("first_id"),
                                    F.min_by("url", "page_id").alias("first_url"),
                                    F.count(F.lit(1)).alias("n"))
                 .where("n > 1").drop("n"))
    out = heads.join(stored(originals, "warc-originals"), key, "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return out.select("page_id", "url", "html", "bytes", "digest",
                      F.when(revisit, F.col("first_id")).alias("first_id"),
                      F.when(revisit, F.col("first_url")).alias("first_url"))


def _target(url: Column, page_id: Column) -> Column:
    named = F.coalesce(F.nullif(F.regexp_replace(url, r"[\x00-\x20]+", "%20"), F.lit("")),
                       F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("none"))))
    return named


def warc_records(resolved: DataFrame, date: str) -> DataFrame:
    """One string column ``value`` with each row's whole record (without the record end)."""
    revisit = F.col("first_id").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                          "Content-Length: "), F.col("bytes"), F.lit(RECORD_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"))
    head = F.concat_ws(
        CRLF, F.lit("WARC/1.1"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", _target(F.col("url"), F.col("page_id"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first_id"), F.col("digest")))),
        line("WARC-Refers-To-Target-URI", F.when(revisit, _target(F.col("first_url"), F.col("first_id")))),
        line("X-Page-Id", F.col("page_id")),
        line("X-Refers-To-Page-Id", F.col("first_id")),
        line("X-Payload-Length", F.col("bytes")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length(block)))
    return resolved.select(F.concat(head, F.lit(RECORD_END), block).alias("value"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z",
                   min_bytes: int = 0) -> None:
    """Write deduplicated gzip archives of ``pages`` (url, html, page_id) below ``path``."""
    (warc_records(resolve_revisits(pages, min_bytes), date)
     .write.option("lineSep", RECORD_END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def parse_archive(data: bytes):
    """``(headers, block)`` of every record of one (gzip or plain) archive."""
    if data[:2] == b"\x1f\x8b":
        parts, rest = [], data
        while rest:                                   # one or more gzip members
            member = zlib.decompressobj(31)
            parts.append(member.decompress(rest))
            rest = member.unused_data
        data = b"".join(parts)
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {}
        for text in lines[1:]:
            name, _, value = text.partition(b": ")
            headers[name.decode().lower()] = value.decode("utf-8", "replace")
        start = end + 4
        stop = start + int(headers["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield headers, data[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str, page_type: str = "bigint") -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, html`` of the records
    below ``path``. Responses are measured and digested anew from the payload that was read,
    and must agree with their headers; revisits have no payload and carry their headers'."""
    def parse(batches):
        import base64
        import hashlib

        import pyarrow as pa

        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]
        for b in batches:
            for content in b.column(0):
                rows = []
                for headers, block in parse_archive(content.as_py()):
                    kind = headers["warc-type"]
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                    n, html = int(headers["x-payload-length"]), None
                    if kind == "response":
                        html = block[block.index(b"\r\n\r\n") + 4:]
                        own = base64.b32encode(hashlib.sha1(html).digest()).decode()
                        if own != digest or n != len(html):
                            raise ValueError(f"payload of {headers['warc-record-id']} is damaged")
                    rows.append((headers.get("x-page-id"), n, digest, kind,
                                 headers.get("x-refers-to-page-id"), html))
                    if len(rows) >= 500:
                        yield _batch(pa, rows, names)
                        rows = []
                if rows:
                    yield _batch(pa, rows, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    out = files.mapInArrow(parse, "page_id string, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to string, html binary")
    return out.withColumns({"page_id": F.col("page_id").cast(page_type),
                            "refers_to": F.col("refers_to").cast(page_type)})


def _batch(pa, rows, names):
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
