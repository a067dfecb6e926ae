"""WARC round trips, with records inside payloads and odd bytes."""

import base64
import hashlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.llm.common import shared_dir
from lexiloom.llm.warc import find_records, mark_revisits, pages_of, payload_digest, read_blocks, read_warc, round_trip, write_warc

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (3, None, None), (4, "http://c/", ""), (5, "u v\nw", "é日\x00\x85 z"),
    (6, "http://d/", FAKE), (7, "http://e/", "x\r\n\r\n" + FAKE * 3), (8, "http://f/", "WARC/1.1"), (9, "http://g/", "\r\n\r\n\r\n"),
    (10, "http://h/", "a\nb\r\nc\n"), (11, "http://i/", "WARC/1.1\r\nContent-Length: 99999\r\n\r\n"), (12, "http://j/", "line\n" * 30000), (13, "x", "<p>one</p>"),
]


def expected(pages, least=0):
    out = []
    for key, _, html in pages:
        body = (html or "").encode()
        same = [k for k, _, h in pages if (h or "") == (html or "") and k is not None]
        first = min(same) if same and len(body) >= least else key
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((key, html or "", len(body), digest, "response" if key == first else "revisit", None if key == first else first))
    return sorted(out, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def frame(spark, pages):
    return spark.createDataFrame([(*p, "c", 1) for p in pages], "page_id long, url string, html string, payload string, first int")


def test_round_trip(spark):
    assert found(round_trip(frame(spark, PAGES), file_records=3)) == expected(PAGES)
    assert found(round_trip(frame(spark, PAGES), least_bytes=1)) == expected(PAGES, 1)


def test_small_splits_give_the_same(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert found(round_trip(frame(spark, PAGES[:11]), compression="none")) == expected(PAGES[:11])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_headers_and_blocks(spark):
    path = shared_dir(spark, "warc-test")
    write_warc(mark_revisits(frame(spark, PAGES)), path, "none")
    rows = {r.record_id: r for r in read_warc(spark, path).collect()}
    assert len(rows) == len(PAGES)
    assert rows["<urn:page:2>"].refers_to == "<urn:page:1>" and rows["<urn:page:2>"].block == ""
    assert rows["<urn:page:3>"].url is None and rows["<urn:page:5>"].url == "uvw"


def test_dates(spark):
    path = shared_dir(spark, "warc-test")
    write_warc(mark_revisits(frame(spark, PAGES)), path, "none", date=datetime(2024, 2, 29, 23, 59, 58, tzinfo=timezone(timedelta(hours=-1))))
    lines = [r.value for r in spark.read.text(path).collect() if r.value.startswith("WARC-Date")]
    assert len(lines) == len(PAGES) and {x.strip() for x in lines} == {"WARC-Date: 2024-03-01T00:59:58Z"}


def test_repeated_ids_of_different_payloads(spark):
    pages = [(1, "a", "x"), (1, "a", "y"), (2, "b", "x"), (3, "c", "y"), (4, "d", "y")]
    got = found(round_trip(frame(spark, pages)))
    assert [(r[0], r[1], r[4], r[5]) for r in got] == [
        (1, "x", "response", None), (1, "y", "response", None), (2, "x", "revisit", 1), (3, "y", "revisit", 1), (4, "y", "revisit", 1)
    ]


def test_blocks_are_read_once_and_payloads_not_moved_unless_used(spark):
    plan = round_trip(frame(spark, PAGES)).drop("payload")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1


def test_revisit_of_nothing_is_an_error(spark):
    path = shared_dir(spark, "warc-test")
    write_warc(mark_revisits(frame(spark, PAGES)).where("id <> 1"), path)
    records = find_records(spark, path)
    with pytest.raises(Exception, match="a payload differs from its digest"):
        pages_of(records, read_blocks(spark, path, records), T.LongType()).collect()


def test_repeated_rows_and_missing_ids(spark):
    pages = [(1, "a", "x"), (1, "a", "x"), (None, "b", "x"), (None, "c", "y"), (2, "d", "x")]
    got = found(round_trip(frame(spark, pages)))
    assert [(r[0], r[4], r[5]) for r in got] == [(1, "response", None), (1, "response", None), (2, "revisit", 1), (None, "revisit", 1), (None, "response", None)]


def test_empty_table(spark):
    assert round_trip(frame(spark, PAGES).limit(0)).count() == 0


def test_broken_chain_is_an_error(spark):
    path = shared_dir(spark, "warc-test")
    text = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 9\r\n\r\nabc"
    spark.createDataFrame([(text,)], "value string").write.option("lineSep", "\r\n\r\n").text(path)
    with pytest.raises(ValueError):
        read_warc(spark, path)


def test_digest(spark):
    row = spark.createDataFrame([("",), ("abc",)], "t string").select("t", payload_digest(F.col("t")).alias("d")).collect()
    assert all(r.d == base64.b32encode(hashlib.sha1(r.t.encode()).digest()).decode() for r in row)
