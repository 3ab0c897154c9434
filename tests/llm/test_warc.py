"""WARC: exact round trip, whatever payloads hold and however files are split."""

import hashlib

import pytest

from conftest import SF001
from rivulet.llm import warc


def brute(rows):
    kept = {}
    for i, _, html in rows:
        b = (html or "").encode()
        if len(b) >= 1000 and i is not None:
            kept[b] = max(kept.get(b, i), i)
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        k = kept.get(b)
        same = k is None or k == i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "response" if same else "revisit", None if same else k))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type",
                                       "refers_to").collect()), key=str)


def hostile(n):
    """Payloads with magic, whole fake records, record ends and odd breaks."""
    fake = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999999>\r\n"
            "Content-Length: 5\r\n\r\nhello\r\n\r\n")
    rows = [(0, "http://a/", fake), (1, None, fake * 40), (2, "http://b/\r\nX: y", "WARC/1.0\r\n" * 300),
            (3, "http://c/", "x" * 1500 + "WARC/1.0"), (4, "u", "WARC/1.0\r\nContent-Length: 99999999999999999999\r\n\r\n"),
            (5, "u", "\r\n\r\nWARC/1.0\r\n"), (6, "u", None), (7, "u", ""), (8, "u", "é漢\U0001f600" * 500),
            (9, "u", "é漢\U0001f600" * 500), (10, "u", "same" * 400), (11, "u", "same" * 400), (12, "u", "same" * 400),
            (12, "u", "same" * 400), (None, "u", "same" * 400), (None, None, None), (13, "u", "s" * 999), (14, "u", "s" * 999),
            (15, "u", "WARC/1.0\r\nContent-Length: 7000\r\n\r\n" + "y" * 2000), (16, "u", fake * 40), (17, "u", "z" * 200_000)]
    rows += [(100 + i, f"http://h{i}/", f"<p>{i}</p>" * (i % 50) + ("WARC/1.0\r\n" + "a: b\r\n" * (i % 3) if i % 7 == 0 else ""))
             for i in range(n)]
    return rows


@pytest.mark.parametrize("split", [None, 1000, 4096, 60_000])
def test_hostile_payloads(spark, split):
    rows = hostile(300)
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, kept int")
    conf = {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.minPartitionNum": "1"} if split else {}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert got(warc.round_trip(df.coalesce(2))) == brute(rows)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_empty_table_and_one_row(spark):
    df = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string")
    assert warc.round_trip(df.limit(0)).count() == 0
    assert got(warc.round_trip(df)) == brute([(1, "u", "h")])


def test_files_are_warc(spark, tmp_path):
    """Read a written file by the plain rules of the format."""
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF001}/pages.parquet").collect()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write(df.coalesce(1), str(tmp_path / "w"))
    (file,) = (tmp_path / "w").glob("part-*")
    data, at, seen = file.read_bytes(), 0, {}
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.0"
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        begin = at + len(head) + 4
        block = data[begin:begin + int(fields[b"Content-Length"])]
        assert data[begin + len(block):begin + len(block) + 4] == b"\r\n\r\n"
        at = begin + len(block) + 4
        if fields[b"WARC-Type"] == b"response":
            seen[int(fields[b"WARC-Record-ID"][10:-1])] = block.partition(b"\r\n\r\n")[2].decode()
    kept = {i: h for i, _, h in rows}
    assert seen and all(kept[i] == h for i, h in seen.items())
