"""WARC archives: writing records in segments, and putting them together again.

A record larger than a segment is written as a first record and ``continuation`` records
that name its id, their number, and, in the last, the total length. HTTP bodies are framed
in chunks. Archives are plain files of a bounded number of bounded records, written and
read by Spark's own file sources, so they may lie in any store. Reading parses records by
their Content-Length; whole records are decoded where they are read, segments are grouped
by origin id and ordered by number, and the sum of their bytes is checked.
"""
from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealhouse.llm.common import map_rows, materialize

SEGMENT_BYTES = 32 * 1024   # block bytes of a record, at most
ARCHIVE_RECORDS = 1024      # records of an archive file, at most: with the above, 32 MB and headers
CHUNK_BYTES = 8 * 1024      # body bytes of a chunk
DATE = "2024-01-01T00:00:00Z"
CRLF = b"\r\n"
END = "\r\n\r\n"            # after every record
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: URLs


class WarcError(ValueError):
    """An archive that is not what its headers say."""


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# --- writing ----------------------------------------------------------------------------

def chunked(body: bytes, size: int = CHUNK_BYTES) -> bytes:
    """``body`` in chunked transfer framing."""
    parts = [body[i:i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%b\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One record, without the line ends that close it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + CRLF + CRLF + block


def _one_line(value: str) -> str:
    """A header value: line ends would end the header, so they are percent-encoded."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def page_records(page_id: int | None, url: str | None, payload: bytes, first_page: int | None, row: int,
                 segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    """The records of one page: a revisit if ``first_page`` names another, else a response, in segments if long."""
    digest = payload_digest(payload)
    origin = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}/{digest}/{row}')}>"
    revisit = first_page is not None and first_page != page_id
    about = [("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}")]
    about += [("WARC-Target-URI", _one_line(url))] if url is not None else []
    about += [("Page-Id", str(page_id))] if page_id is not None else []
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    if revisit:
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", origin), *about,
                      ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                      ("Refers-To-Page-Id", str(first_page)),
                      ("Content-Type", "application/http; msgtype=response")], (http + "\r\n").encode())
        return
    block = (http + "Transfer-Encoding: chunked\r\n\r\n").encode() + chunked(payload)
    parts = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    kind = [("WARC-Type", "response"), ("WARC-Record-ID", origin), *about,
            ("Content-Type", "application/http; msgtype=response")]
    if len(parts) == 1:
        yield record(kind, block)
        return
    yield record([*kind, ("WARC-Segment-Number", "1")], parts[0])
    for n, part in enumerate(parts[1:], 2):
        last = [("WARC-Segment-Total-Length", str(len(block)))] if n == len(parts) else []
        yield record([("WARC-Type", "continuation"),
                      ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{origin}/{n}')}>"),
                      ("WARC-Date", DATE), ("WARC-Segment-Origin-ID", origin),
                      ("WARC-Segment-Number", str(n)), *last], part)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
                   archive_records: int = ARCHIVE_RECORDS) -> None:
    """Write a record for each row of ``pages`` (page_id, url, html) under ``path``.

    Of rows with equal html (null counts as empty) those with the smallest page_id become
    responses, the others revisits of it; without any page_id all are responses.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    keyed = pages.select(F.col("page_id").alias("page"), F.sha2(html, 256).alias("same"))
    groups = keyed.groupBy("same").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Only rows that revisit carry more than themselves: theirs is the one side of the join that is short.
    repeats = (keyed.join(groups, "same").filter("page is not null and page <> first")
               .groupBy("page", "same").agg(F.min("first").alias("first")))
    rows = (pages.select("page_id", "url", html.alias("html"), F.sha2(html, 256).alias("_same"))
            .join(repeats, (F.col("page_id") == F.col("page")) & (F.col("_same") == F.col("same")), "left")
            .select("page_id", "url", "html", "first", F.monotonically_increasing_id().alias("row")))

    def records(source: Iterator[tuple]) -> Iterator[tuple]:
        for page_id, url, text, first, row in source:
            payload = text.encode("utf-8", "surrogatepass")
            for part in page_records(page_id, url, payload, first, row, segment_bytes):
                yield (part,)

    written = map_rows(rows, ["page_id", "url", "html", "first", "row"], records,
                       T.StructType([T.StructField("record", T.BinaryType())]))
    # A cast keeps the bytes as they are; the writer puts the end of record after each.
    (written.select(F.col("record").cast("string").alias("value")).write
     .option("lineSep", END).option("maxRecordsPerFile", archive_records).option("compression", "gzip").text(path))


# --- reading ----------------------------------------------------------------------------

def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, by Content-Length."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        if head < 0 or not data.startswith(b"WARC/1.", at):
            raise WarcError(f"no record header at byte {at}")
        lines = data[at:head].decode("utf-8", "surrogatepass").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        if not re.fullmatch("[0-9]+", fields.get("content-length", "")):
            raise WarcError(f"no content length at byte {at}")
        start = head + 4
        end = start + int(fields["content-length"])
        if data[end:end + 4] != b"\r\n\r\n":
            raise WarcError(f"record at byte {at} is not as long as it says")
        yield fields, data[start:end]
        at = end + 4


def unchunked(body: bytes) -> bytes:
    """The body of chunked transfer framing; chunk extensions and trailers are passed over."""
    out, at = [], 0
    while True:
        line = body.find(b"\r\n", at)
        size = body[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            raise WarcError(f"no chunk size at byte {at}")
        n, at = int(size, 16), line + 2
        if not n:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise WarcError(f"chunk at byte {at} is not as long as it says")
        out.append(body[at:at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes:
    """The body of an HTTP response, taken out of its transfer framing."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        raise WarcError("no end of the HTTP header")
    coded = re.search(rb"(?im)^transfer-encoding:[ \t]*chunked[ \t]*\r?$", head)
    return unchunked(body) if coded else body


def assemble(segments: list[tuple[int, int | None, bytes]]) -> bytes:
    """The block of ``(number, total length, bytes)``, checked for gaps, repeats and length."""
    ordered = sorted(segments, key=itemgetter(0))
    numbers = [n for n, _, _ in ordered]
    if numbers != list(range(1, len(ordered) + 1)):
        raise WarcError(f"segments {numbers[:20]} have a gap or a repeat")
    block, total = b"".join(b for _, _, b in ordered), ordered[-1][1]
    if total is None or total != len(block):
        raise WarcError(f"segments add up to {len(block)} bytes, not {total}")
    return block


SEGMENT = T.StructType([
    T.StructField("origin", T.StringType()), T.StructField("number", T.IntegerType()),
    T.StructField("total", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("refers_to", T.LongType()),
    T.StructField("digest", T.StringType()), T.StructField("uri", T.StringType()),
    T.StructField("block", T.BinaryType())])
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("digest", T.StringType()),
    T.StructField("uri", T.StringType()), T.StructField("payload", T.BinaryType())])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``, segments apart. A file is bounded, and so is a row here."""
    def rows(source: Iterator[tuple]) -> Iterator[tuple]:
        for (content,) in source:
            data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
            for fields, block in parse_archive(data):
                number, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
                page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
                yield (fields.get("warc-segment-origin-id", fields["warc-record-id"]), number and int(number),
                       total and int(total), fields["warc-type"], page and int(page), refers and int(refers),
                       fields.get("warc-payload-digest", "").removeprefix("sha1:"),
                       fields.get("warc-target-uri"), block)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return map_rows(files.filter("length > 0"), ["content"], rows, SEGMENT)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``(page_id, kind, refers_to, digest, uri, payload)`` of every response and revisit under ``path``.

    ``digest`` is that of the decoded payload for responses (it must equal the header's), the
    header's for revisits, which have no payload. Missing, repeated or short segments raise.
    """
    def finish(head: tuple, block: bytes) -> tuple:
        _, _, _, kind, page, refers, said, uri, _ = head
        if kind == "revisit":
            return page, kind, refers, said, uri, None
        payload = http_payload(block)
        if (digest := payload_digest(payload)) != said:
            raise WarcError(f"payload of page {page} has digest {digest}, not {said}")
        return page, kind, refers, digest, uri, payload

    def whole(source: Iterator[tuple]) -> Iterator[tuple]:
        for row in source:
            yield finish(row, row[-1])

    def joined(source: Iterator[tuple]) -> Iterator[tuple]:
        for _, segments in groupby(source, itemgetter(0)):
            rows = list(segments)  # one record's segments: no more than the page it came from
            yield finish(rows[0], assemble([(r[1], r[2], r[-1]) for r in rows]))

    segments = read_segments(spark, path)
    parts = segments.filter("number is not null").repartition("origin").sortWithinPartitions("origin", "number")
    return map_rows(segments.filter("number is null"), SEGMENT.names, whole, RECORD).unionByName(
        map_rows(parts, SEGMENT.names, joined, RECORD))


def archived_pages(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` to archives under ``path``, read them back, and report a row per record:
    ``(page_id, payload_bytes, payload_digest, record_type, refers_to)``.

    Null html counts as empty, a null url is left out, line ends in a url are percent-encoded.
    A revisit's bytes are those of the responses with its digest. Rows that repeat page_id and
    html are responses or revisits alike; rows without a page_id are responses. An empty table
    gives empty archives and an empty table.
    """
    write_archives(pages, path)
    seen = materialize(read_archives(pages.sparkSession, path).select(
        "page_id", "kind", "refers_to", "digest", F.octet_length("payload").cast("long").alias("size")), "warc-records")
    sizes = seen.filter("kind = 'response'").groupBy("digest").agg(F.max("size").alias("full"))
    responses = seen.filter("kind = 'response'")
    revisits = seen.filter("kind = 'revisit'").join(sizes, "digest").withColumn("size", F.col("full"))
    return responses.unionByName(revisits.select(responses.columns)).select(
        "page_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("kind").alias("record_type"), "refers_to")


def oracle_sql() -> str:
    """The registered query's rows in DuckDB SQL: what the pages say, without archives."""
    nibbles = ", ".join(f"'{i:04b}'" for i in range(16))
    five = " + ".join(f"{16 >> k} * CAST(substr(bits, 5 * i + {k + 1}, 1) AS INTEGER)" for k in range(5))
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first,
        array_to_string(list_transform(range(40), lambda i: [{nibbles}][strpos('0123456789abcdef', substr(hex, i + 1, 1))]),
                        '') AS bits FROM p),
r AS (SELECT *, page_id IS NOT NULL AND page_id <> first AS again FROM b)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + {five}, 1)), '')
    AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to
FROM r"""
