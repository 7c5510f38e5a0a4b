"""The archive converter: both ARC versions, its SQL, round trips and odd rows."""

import hashlib
import io

import pytest
from pyspark.sql import functions as F

from check_sql import compare
from tradeloom.llm.arc_to_warc import (
    arc_head,
    arc_record,
    iso_date,
    pages_through_archives,
    parts_of,
    read_arc,
    read_warc,
    warc_record,
)
from tradeloom.llm.queries import QUERIES, SQL

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_sql(spark, sf):
    name = "op3_arc_to_warc"
    text, _, ok = compare(spark, f"/root/testdata/{sf}", name, QUERIES[name], SQL[name])
    assert ok, text


@pytest.mark.parametrize("version", [1, 2])
def test_versions(version):
    http = b"HTTP/1.0 200 OK\r\nX-Page-Id: 12\r\n\r\nline\n\nhttp://looks.like/ 1.2.3.4 20200101000000 text/html 3\nabc"
    data = arc_head("a.arc", version, "20010203040506")
    data += arc_record(version, "http://a.com/x y", "1.2.3.4", "20010203040506", "text/html", http, 7, "a.arc")
    data += arc_record(version, "dns:a.com", "-", "2001", "text/dns", b"")
    data += arc_record(version, "http://b.com/", "1.2.3.4", "20010203040506", "text/html", b"no status line")
    name, records = read_arc(io.BytesIO(data))
    found = list(records)
    assert name == "a.arc" and [r.number for r in found] == [0, 1, 2]
    assert found[0].url == "http://a.com/x%20y" and found[0].body == http and found[1].body == b""
    kinds = [(parts_of(r).kind, parts_of(r).key) for r in found]
    assert kinds == [("response", 12), ("resource", None), ("resource", None)]
    assert parts_of(found[0]).payload.endswith(b"\nabc")


def test_urls_with_spaces_and_wrong_lengths():
    block = b"1 0 Old\nURL IP-address Archive-date Content-type Archive-length\n"
    head = b"filedesc://old.arc 0.0.0.0 19990101000000 text/plain %d\n" % len(block) + block + b"\n"
    _, records = read_arc(io.BytesIO(head + b"http://x.org/a b c 1.1.1.1 19990101000000 text/html 2\nhi\n\n"))
    assert [(r.url, r.body) for r in records] == [("http://x.org/a b c", b"hi")]
    for bad in (b"http://x.org/ 1.1.1.1 19990101000000 text/html 20\nhi\n", b"too few fields\n"):
        _, records = read_arc(io.BytesIO(head + bad))
        with pytest.raises(ValueError):
            list(records)
    with pytest.raises(ValueError):
        read_arc(io.BytesIO(b"WARC/1.0\r\n"))


def test_dates():
    assert iso_date("20010203040506") == "2001-02-03T04:05:06Z"
    assert iso_date("200102030405") == "2001-02-03T04:05:00Z"
    assert iso_date("2001") == "2001-01-01T00:00:00Z" and iso_date("") == "0001-01-01T00:00:00Z"
    assert iso_date("99999999999999") == "9999-12-31T23:59:59Z"


def test_warc_round_trip():
    data = warc_record([("WARC-Type", "resource")], b"a\r\n\r\nWARC/1.1\r\n") + warc_record([("WARC-Type", "x")], b"")
    assert [(f["warc-type"], b) for f, b in read_warc(io.BytesIO(data))] == [("resource", b"a\r\n\r\nWARC/1.1\r\n"), ("x", b"")]


def test_odd_rows(spark):
    long = "é" * 300_000
    rows = [
        (5, "http://a.com/", "x" * 100), (3, "http://b.com/ q\n", "x" * 100), (9, None, "x" * 100), (9, None, "x" * 100),
        (1, "http://c.com/", "y" * 99), (2, "http://d.com/", "y" * 99), (7, "ftp", None), (8, "", ""),
        (None, "http://e.com/", long), (None, "http://e.com/", long), (11, "http://f.com/", long + "\r\n\r\n"),
    ]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"path": F.lit("p"), "digest": F.lit(1), "id": F.lit("i")})
    got = pages_through_archives(pages, file_bytes=1000).collect()
    assert len(got) == len(rows)
    view = sorted((str(r.id), r.record_type, str(r.refers_to)) for r in got)
    assert view == sorted([
        ("3", "response", "None"), ("5", "revisit", "3"), ("9", "revisit", "3"), ("9", "revisit", "3"),
        ("1", "response", "None"), ("2", "response", "None"), ("7", "response", "None"), ("8", "response", "None"),
        ("None", "response", "None"), ("None", "revisit", "None"), ("11", "response", "None"),
    ])
    want = sorted(hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in rows)
    assert sorted(r.payload_digest for r in got) == want
    assert sorted(r.payload_bytes for r in got) == sorted(len((h or "").encode()) for _, _, h in rows)
    assert len({r.record_id for r in got}) == len(rows)
    assert pages_through_archives(pages.where("false")).count() == 0
