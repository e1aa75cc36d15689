import gzip
import hashlib
import os

import pytest

from snapfeed.llm import warc
from snapfeed.session import read_table
from llm_cases import SF_SMALL

ROWS = [(1, "http://a\r\nX", "x" * 2000), (2, None, "x" * 2000), (3, "u", "é" * 600), (3, "u", "é" * 600), (4, "u", None), (5, "", ""), (None, "u", "y" * 3000),
        (6, "u", "y" * 3000), (7, "u", "short"), (8, "u", "short"), (9, "u", "z" * 300_000), (10, "u", "w" * 1000), (11, "v", "w" * 1000), (12, "v", "w" * 1000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], "page_id long, url string, html string, first long")


def brute(rows):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, body in data:
        same = [j for j, other in data if other == body and j is not None]
        first = max(same, default=None)
        revisit = len(body) >= 1000 and first is not None and i != first
        out.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def test_round_trip(pages):
    got = warc.round_trip(pages).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(ROWS)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_whole_table(spark):
    pages = read_table(spark, SF_SMALL, "pages")
    got = warc.round_trip(pages).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])


@pytest.mark.parametrize("level", [0, 1, 9])
def test_archives(spark, pages, tmp_dir, level):
    warc.register(spark)
    path = os.path.join(tmp_dir, f"level{level}")
    warc.page_records(pages).write.format("warc").mode("append").option("level", level).option("roll_bytes", 500).save(path)
    files = [f for f in os.listdir(path) if f.endswith((".warc", ".warc.gz"))]
    assert len(files) > 1
    records = spark.read.format("warc").option("partition_bytes", 1000).load(path)
    assert records.rdd.getNumPartitions() > 1
    full = {(r.record_id, r.record_type): bytes(r.payload) if r.payload is not None else None for r in records.collect()}
    assert full["<urn:page:9>", "response"] == b"z" * 300_000 and full["<urn:page:1>", "revisit"] is None and full["<urn:page:4>", "response"] == b""
    assert records.where("record_type = 'revisit' and refers_to = '<urn:page:12>'").count() == 2
    assert records.where("target_uri like 'http://a%'").first().target_uri == "http://a%0D%0AX"
    plan = records.where("record_type = 'revisit'")._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")  # the source filters
    assert spark.read.format("warc").option("payload", "false").load(path).where("payload is not null").count() == 0
    if level:  # the members are ordinary gzip
        text = b"".join(gzip.open(os.path.join(path, f)).read() for f in files)
        assert text.count(b"WARC/1.1\r\n") == len(ROWS)


def test_foreign_archive(spark, tmp_dir):
    """Members without skip lengths, records without HTTP heads, other record types."""
    warc.register(spark)
    path = os.path.join(tmp_dir, "foreign")
    os.makedirs(path)
    body = "héllo\r\n\r\nworld".encode()
    parts = [b"WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: 0\r\n\r\n\r\n\r\n",
             b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:b>\r\nContent-Type: text/plain\r\nWARC-Payload-Digest: sha1:" + hashlib.sha1(body).hexdigest().encode()
             + b"\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"]
    for name, data in (("x.warc.gz", b"".join(map(gzip.compress, parts))), ("y.warc", b"".join(parts))):
        with open(os.path.join(path, name), "wb") as f:
            f.write(data)
    rows = spark.read.format("warc").load(path).where("record_type = 'resource'").collect()
    assert [(bytes(r.payload), r.payload_bytes, r.payload_sha1) for r in rows] == [(body, len(body), hashlib.sha1(body).hexdigest())] * 2
