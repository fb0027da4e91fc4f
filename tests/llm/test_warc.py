import base64
import glob
import hashlib
import uuid

import pytest

from tidewater.llm import warc
from tidewater.session import shared_path

END = "\r\n\r\n"


def brute(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        lead = first.get(h or "")
        again = len(b) >= min_bytes and lead is not None and i != lead
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode().rstrip("=")
        out.append((i, len(b), digest, "revisit" if again else "response",
                    lead if again else None))
    return sorted(out, key=str)


def pages():
    fake = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:777>\r\n"
            "Content-Length: 5" + END + "hello" + END)
    rows = [(1, "http://a.example/x y", "<p>é\r\n</p>"), (2, None, None), (3, "http://b/", ""),
            (4, "http://c/", "x" * 200_000), (5, "u", f"a{fake}b"), (6, "u", fake),
            (7, "u", fake + fake), (8, "u", "WARC/1.0\r\n"), (9, "u", "z" + END + "WARC/1.0\r\n"),
            (10, "u", "\r\n" * 9), (None, "n", "<p>null id</p>"), (None, "n", "x" * 200_000),
            (11, "http://d/\r\nWARC/1.0\r\nContent-Length: 1", "<b>"), (12, "u", "<p>é\r\n</p>"),
            (13, "u", "WARC/1.0\r\nContent-Length: 99999999" + END)]
    rows += [(100 + i, f"http://h/{i}", f"page {i % 7}") for i in range(60)]
    return [*rows, rows[0]]


@pytest.mark.parametrize(("size", "split"), [(2048, "128m"), (5, "128m"), (2048, "2k")])
def test_round_trip(spark, size, split):
    rows = pages()
    df = spark.createDataFrame([(*r, 1) for r in rows],
                               "page_id long, url string, html string, payload int")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        path = shared_path(spark, "warc-test")
        warc.write(warc.with_revisits(df), path, size)
        got = warc.read(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got], key=str) == brute(rows)
    assert {r.page_id: r.url for r in got}[2] is None


def test_smaller_payloads_are_all_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = warc.with_revisits(df, 3).collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                   for r in got], key=str) == brute(rows, 3)


def test_files_hold_plain_records(spark):
    df = spark.createDataFrame([(5, "http://a/", "body")],
                               "page_id long, url string, html string").coalesce(1)
    path = shared_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write(warc.with_revisits(df), path)
    data = b"".join(open(f, "rb").read() for f in glob.glob(f"{path.removeprefix('file:')}/part*"))
    head, _, block = data.partition(END.encode())
    assert head.startswith(b"WARC/1.0\r\nWARC-Type: response\r\n")
    n = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length"))[15:])
    assert block[n:] == END.encode() and block[:n].endswith(END.encode() + b"body")


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    path = shared_path(spark, "warc-empty")
    warc.write(warc.with_revisits(df), path)
    assert warc.read(spark, path).collect() == []
