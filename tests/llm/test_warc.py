import hashlib
import io

import pytest

from threadloom.llm import warc


def test_arc_versions():
    for version in (1, 2):
        content = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody\n\nmore"
        fields = {"URL": "http://x.org/", "IP-address": "1.2.3.4", "Archive-date": "19970102030405", "Content-type": "text/html"}
        data = warc.arc_block(version, "t.arc", "1997") + warc.arc_record(version, fields, content) + warc.arc_record(version, fields | {"Content-type": "text/html; charset=x"}, b"")
        head, first, second = warc.read_arc(io.BytesIO(data))
        assert head.version == version and first.content == content and second.content == b""
        assert second.fields["Content-type"] == "text/html; charset=x" and first.fields["URL"] == "http://x.org/"
        ((h, block),) = warc.read_warc(io.BytesIO(warc.convert(first)))
        assert h["WARC-Type"] == "response" and h["WARC-Date"] == "1997-01-02T03:04:05Z" and block == content
        assert h["WARC-Payload-Digest"] == warc.sha1(b"body\n\nmore") and h["WARC-IP-Address"] == "1.2.3.4"
        assert [*warc.read_warc(io.BytesIO(warc.convert(head)))][0][0]["WARC-Type"] == "warcinfo"


def test_damaged_archives():
    block = warc.arc_block(1, "t.arc", "1997")
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(b"http://x 1 2 3 4\n")))
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(block + b"http://x 1.2.3.4 1997 text/html 99\nshort\n")))
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(block + b"http://x 1.2.3.4 99\n")))


def test_report(spark):
    long, other = "é" * 500, "y" * 999
    rows = [(1, "http://a/1", long), (2, None, long), (7, "http://a b\n/3", long), (4, "ftp://q", other), (5, "x", other), (6, "", None), (None, "http://n", long), (8, "u", "\r\n\r\nz\r\n" + "w" * 2000), (8, "u", "\r\n\r\nz\r\n" + "w" * 2000)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    found = sorted((tuple(r)[:5] for r in warc.report(spark, pages).collect()), key=str)
    expected = []
    for k, _, html in rows:
        data = (html or "").encode()
        top = 7 if html == long else None
        kind = "revisit" if top and k != top else "response"
        expected.append((k, len(data), hashlib.sha1(data).hexdigest(), kind, top if kind == "revisit" else None))
    assert found == sorted(expected, key=str)
    assert warc.report(spark, pages.limit(0)).count() == 0


def test_keys_of_any_kind(spark):
    """A key that is the text 'null', one with line breaks and quotes, and a null one come back as they were."""
    rows = [("null", "u", "a"), (None, "u", "b"), ('x\r\ny: "z" é', "u", "c"), ("", "u", "d"), ("p", "u", "e" * 2000), ("q\n", "u", "e" * 2000)]
    found = warc.report(spark, spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert {r["page_id"] for r in found} == {r[0] for r in rows} and len(found) == len(rows)
    assert {r["page_id"]: r["refers_to"] for r in found if r["record_type"] == "revisit"} == {"p": "q\n"}
