import base64
import gzip
import hashlib
import io
import uuid

import pytest
from pyspark.sql import functions as F

from prosemill.llm.runtime import checkpoint_root
from prosemill.llm.warc import ArcRecord, arc_archive, arc_to_warc, convert, http_number, pages_to_arc, parse_arc, parse_warc, read_warc, split_http, warc_date, warc_record, with_revisits, write_warc

BODY = b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"


@pytest.mark.parametrize("version", [1, 2])
def test_archives_parse_by_their_lengths(version):
    tricky = b"http://x 0.0.0.0 20200101000000 text/html 5\nabcde\n\n"
    records = [("http://a/", "1.2.3.4", "20010203040506", "text/html", BODY), ("http://b/ c", "-", "20010203", "text/plain", tricky), ("http://c/", "-", "x", "text/plain", b"")]
    got = list(parse_arc(arc_archive("n.arc", records, version)))
    assert [r.body for r in got[1:]] == [r[4] for r in records]
    assert got[0].fields["URL"] == "filedesc://n.arc" and got[2].fields["URL"] == "http://b/%20c"
    assert all(r.version == version and not r.truncated for r in got)
    assert len(got[1].fields) == (5 if version == 1 else 10)
    assert len({r.offset for r in got}) == 4


def test_damaged_archives():
    data = arc_archive("n.arc", [("http://a/", "-", "20010203040506", "text/html", BODY)], 1)
    cut = list(parse_arc(data[:-10]))
    assert cut[-1].truncated and "WARC-Truncated" in convert("n", cut[-1])[0]
    assert [r.body for r in parse_arc(data + b"no header here\n" + data)][1] == BODY
    assert list(parse_arc(b"")) == []


def test_synthesised_fields():
    record = ArcRecord(10, 1, {"URL": "http://a/", "IP-address": "1.1.1.1", "Archive-date": "20010203040506", "Content-type": "text/html"}, BODY, False)
    headers, head, payload = convert("n.arc", record)
    assert payload == b"abc" and head.endswith(b"\r\n\r\n")
    assert headers["WARC-Date"] == "2001-02-03T04:05:06Z" and headers["WARC-Type"] == "response"
    assert headers["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    assert uuid.UUID(headers["WARC-Record-ID"][10:-1]).version == 5
    assert headers["WARC-Record-ID"] == convert("n.arc", record)[0]["WARC-Record-ID"] != convert("m.arc", record)[0]["WARC-Record-ID"]
    assert warc_date("20010203") == "2001-02-03T00:00:00Z" and warc_date("soon") == "1970-01-01T00:00:00Z"
    assert split_http(b"plain") == (b"", b"plain") and split_http(b"HTTP/1.0 200") == (b"HTTP/1.0 200", b"")


def test_records_with_record_like_payloads():
    block = warc_record({"WARC-Type": "response"}, b"x\r\n\r\nWARC/1.1\r\n")
    stream = gzip.compress(block) + gzip.compress(b"") + gzip.compress(warc_record({"WARC-Type": "resource"}, b"")) + gzip.compress(b"")
    got = list(parse_warc(gzip.GzipFile(fileobj=io.BytesIO(stream))))
    assert [(h["warc-type"], b) for h, b in got] == [("response", b"x\r\n\r\nWARC/1.1\r\n"), ("resource", b"")]
    with pytest.raises(ValueError):
        list(parse_warc(io.BytesIO(b"nothing\r\n")))


def written_and_read(spark, pages, least=0):
    records = arc_to_warc(pages_to_arc(pages, archive_bytes=200)).withColumn("page_id", http_number("X-Page-Id"))
    path = f"{checkpoint_root(spark)}/t-{uuid.uuid4().hex}"
    write_warc(with_revisits(records, "page_id", least), path)
    return read_warc(spark, path).withColumn("page_id", http_number("X-Page-Id"))


def test_pages_round_trip(spark):
    same, long = "<p>é\r\n\r\nWARC/1.1</p>", "<b>x</b>" * 60_000
    rows = [(1, "http://a/ b", same), (9, "http://b/", same), (4, None, same), (5, "http://c/", None), (6, "http://d/", ""), (7, "http://e/", long), (8, "http://f/\n", "\x00ü" * 50), (None, "http://g/", same), (7, "http://e/", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("content", F.lit("clash")).withColumn("name", F.lit(1)).repartition(3)
    back = written_and_read(spark, pages).filter("warc_type in ('response', 'revisit')").collect()
    assert len(back) == len(rows)
    responses = {r["record_id"]: r for r in back if r["warc_type"] == "response"}
    assert sorted(r["page_id"] for r in responses.values()) == [6, 7, 8, 9]
    html = {i: (t or "").encode() for i, _, t in rows}
    for r in back:
        expected = html[r["page_id"]]
        if r["warc_type"] == "response":
            assert bytes(r["payload"]) == expected and r["payload_digest"] == r["declared_digest"]
        else:
            assert r["payload"] is None and bytes(responses[r["refers_to"]]["payload"]) == expected
        assert r["declared_digest"] == base64.b32encode(hashlib.sha1(expected).digest()).decode()


def test_small_payloads_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    kinds = {r["page_id"]: r["warc_type"] for r in written_and_read(spark, pages, 3).filter("page_id is not null").collect()}
    assert kinds == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert written_and_read(spark, pages.limit(0)).count() == 0


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    rows = spark.createDataFrame([(i, bytes([i % 7]) * 90) for i in range(100)], "i int, member binary").repartition(2)
    write_warc(rows.withColumn("archive", F.lit("clash")), f"file://{tmp_path}/w", archive_bytes=1000)
    sizes = [f.stat().st_size for f in tmp_path.rglob("part-*") if "crc" not in f.name]
    empty = len(gzip.compress(b"", mtime=0))
    assert len(sizes) >= 8 and max(sizes) <= 1000 + 90 + 13 * empty
