"""Archives written, read back and resolved against hand-made expectations; odd rows."""

import hashlib

from sparkcorpus.llm import warc_dedup as warc
from sparkcorpus.session import fresh_path

LONG = "<p>" + "é語 " * 400 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>\r\n\r\n"


def expected(rows, least=1000):
    best, count = {}, {}
    for page, _, html in rows:
        data = (html or "").encode()
        count[data] = count.get(data, 0) + 1
        best[data] = max((x for x in (best.get(data), page) if x is not None), default=None)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= least and count[data] > 1 and best[data] is not None and page != best[data]
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", best[data] if revisit else None, True))
    return sorted(out, key=str)


def test_archive(spark):
    rows = [
        (1, "http://a/1", LONG), (9, "http://a/9", LONG), (5, None, LONG), (2, "http://a\r\nX-Page-ID: 7", "short"),
        (3, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", LONG), (7, "u", "x" * 1000), (8, "u", "x" * 1000),
        (10, "u", "y" * 999), (11, "u", "y" * 999), (20, "u", "z" * 5000), (20, "u", "z" * 5000), (19, "u", "z" * 5000),
        (12, "u", "\r\n\r\n"), (13, "u", "\n" * 1500), (14, "u", "tail\r\n" + "q" * 2_000_000),
    ]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id bigint, url string, html string, block string")
    got = warc.archive_pages(pages, fresh_path(spark, "test"))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_records_are_standard(spark):
    path = fresh_path(spark, "test")
    pages = spark.createDataFrame([(1, "http://a", LONG), (2, "http://b", LONG)], "page_id bigint, url string, html string")
    warc.write_warc(pages.coalesce(1), path)
    data = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(path).orderBy("path").collect())
    records, at = [], 0
    while at < len(data):  # by Content-Length, as any reader does
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        headers = dict(x.split(": ", 1) for x in lines)
        size = int(headers["Content-Length"])
        assert first == "WARC/1.1" and data[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
        records.append((headers, data[end + 4 : end + 4 + size]))
        at = end + 8 + size
    by_type = {h["WARC-Type"]: (h, b) for h, b in records}
    assert set(by_type) == {"warcinfo", "response", "revisit"} and len(records) == 3
    assert by_type["revisit"][0]["WARC-Refers-To"] == by_type["response"][0]["WARC-Record-ID"]
    assert by_type["response"][1].split(b"\r\n\r\n", 1)[1] == LONG.encode()
    assert by_type["revisit"][1].endswith(b"\r\n\r\n") and len({h["WARC-Record-ID"] for h, _ in records}) == 3


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert warc.archive_pages(pages, fresh_path(spark, "test")).count() == 0
