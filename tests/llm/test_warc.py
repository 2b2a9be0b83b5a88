"""WARC archives: round trips, segments, and what broken archives raise."""
from __future__ import annotations

import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from dealhouse.llm import warc

SCHEMA = "page_id long, url string, html string"


def brute(rows):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in rows:
        body = (html or "").encode()
        revisit = page_id is not None and page_id != first[html or ""]
        out.append((page_id, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", first[html or ""] if revisit else None))
    return sorted(out, key=str)


def pages(spark):
    rng = random.Random(8)
    rows = [(i, f"http://h/{i}", "".join(rng.choice(["<p>", "é", "😀", "\r\n", "WARC/1.1\r\n\r\n", "x" * 50])
                                         for _ in range(rng.choice([0, 1, 5, 3000])))) for i in range(40)]
    rows += [(100 + i, "http://copy", rows[3][2]) for i in range(9)] + [(50, None, None), (51, "a\r\nb: c", "")]
    rows += [(60, "u", "same"), (60, "u", "same"), (60, "u", "other"), (None, "n", "no id"), (None, None, None)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_archives_give_the_pages_back(spark, tmp_root):
    rows, df = pages(spark)
    df = df.withColumn("digest", F.lit("clash")).withColumn("page", F.lit("clash")).withColumn("row", F.lit(1))
    assert result(warc.archived_pages(df, tmp_root)) == brute(rows)
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, tmp_root).collect()
           if r["kind"] == "response" and r["page_id"] is not None and r["page_id"] < 40}
    assert got == {i: h for i, _, h in rows if i in got}
    segments = warc.read_segments(spark, tmp_root).filter("number is not null")
    assert segments.filter("number > 1").count() > 10
    assert segments.agg(F.max(F.octet_length("block"))).first()[0] <= warc.SEGMENT_BYTES


def test_odd_sizes_cut_inside_characters(spark, tmp_root):
    rows, df = pages(spark)
    warc.write_archives(df, tmp_root, segment_bytes=333, archive_records=5)
    got = warc.read_archives(spark, tmp_root).filter("kind = 'response' and page_id < 40").collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in got} == {
        i: h for i, _, h in rows if i is not None and i < 40 and i in {r["page_id"] for r in got}}


def test_empty_table(spark, tmp_root):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA), tmp_root).count() == 0


def test_broken_archives_raise():
    whole = warc.record([("WARC-Type", "response")], b"abc") + b"\r\n\r\n"
    assert [b for _, b in warc.parse_archive(whole * 2)] == [b"abc"] * 2
    for bad in (whole[:-5], b"x" + whole, whole.replace(b"Length: 3", b"Length: 9"), whole.replace(b"h: 3", b"h: x")):
        with pytest.raises(warc.WarcError):
            list(warc.parse_archive(bad))
    for bad in ([(1, None, b"a"), (3, 2, b"b")], [(1, None, b"a"), (2, 9, b"b")], [(1, None, b"a"), (2, None, b"b")],
                [(1, None, b"a"), (2, 3, b"b"), (2, 3, b"b")]):
        with pytest.raises(warc.WarcError):
            warc.assemble(bad)
    assert warc.assemble([(2, 3, b"c"), (1, None, b"ab")]) == b"abc"


def test_chunked_framing():
    for n in (0, 1, 9, 8192, 20000):
        body = bytes(range(256)) * (n // 256 + 1)
        assert warc.unchunked(warc.chunked(body[:n])) == body[:n]
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\nTrailer: 1\r\n\r\n") == b"abc"
    for bad in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"zz\r\n", b"-1\r\na"):
        with pytest.raises(warc.WarcError):
            warc.unchunked(bad)
