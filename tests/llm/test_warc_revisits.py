import random

import pytest
from pyspark.sql import functions as F

from grantline.llm import warc_revisits as wr

SCHEMA = (
    "record_id long, url string, time long, revisit boolean, etag string, last_modified string, "
    "digest string, headers map<string,string>, period string, found string"
)


def record(i, url, time, revisit, etag=None, day=None, digest=None, headers=None):
    return (i, url, time, revisit, etag, day, digest, headers, "clash", "clash")


def resolved(spark, records):
    return {
        r.record_id: (r.response_id, r.outcome, r.headers)
        for r in wr.resolve(spark.createDataFrame(records, SCHEMA)).collect()
    }


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("HTTP://Host.NET:80", "http://host.net/"),
        ("https://h.net:443/A?b=2&a=1#x", "https://h.net/A?a=1&b=2"),
        ("https://h.net:80/?utm_source=f&&", "https://h.net:80/"),
        (" http://h.net/a?utm_x=1&k=v ", "http://h.net/a?k=v"),
        ("HTTP://User:PassWord@Host.NET:80/x", "http://User:PassWord@host.net/x"),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, key):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(wr.canonical_url(F.col("url")).alias("k")).first().k == key


def test_latest_earlier_response(spark):
    """Random records of two URLs over many periods, against a plain search."""
    source = random.Random(3)
    records = []
    for i in range(300):
        url = source.choice(["http://a.net/x", "http://b.net/"])
        time = source.randint(0, 20) * 30_000
        records.append(record(i, url, time, source.random() < 0.5, "e", None, None, {}))
    found = resolved(spark, records)
    for i, url, time, revisit, *_ in records:
        if not revisit:
            assert i not in found
            continue
        earlier = [(r[2], r[0]) for r in records if not r[3] and r[1] == url and r[2] < time]
        assert found[i][0] == (max(earlier)[1] if earlier else None)
        assert found[i][1] == ("resolved" if earlier else "orphan")


def test_validators(spark):
    url, full = "http://a.net/", dict(etag='"1"', day="d", digest="x")
    cases = {
        10: (dict(etag='W/"1"'), "resolved"),
        11: (dict(etag='"2"', day="d"), "changed"),
        12: (dict(day="d"), "resolved"),
        13: (dict(day="e", digest="x"), "changed"),
        14: (dict(digest="x"), "resolved"),
        15: (dict(), "unverified"),
    }
    records = [record(1, url, 5, False, **full)]
    records += [record(i, url, 9, True, **given) for i, (given, _) in cases.items()]
    found = resolved(spark, records)
    assert {i: o for i, (_, o, _) in found.items()} == {i: o for i, (_, o) in cases.items()}


def test_merged_headers(spark):
    old = {"Content-Type": "text/html", "Content-Length": "9", "Cache-Control": "a", "X": "1"}
    new = {"content-length": "0", "cache-control": "b", "Date": "d", "CONTENT-TYPE": "no"}
    records = [
        record(1, "http://a.net/", 5, False, headers=old),
        record(2, "http://a.net/", 6, True, headers=new),
        record(3, "http://a.net/", 6, True, headers=None),
        record(4, "http://a.net/", 1, True, headers=new),
    ]
    found = {i: h for i, (_, _, h) in resolved(spark, records).items()}
    lowered = {k.lower(): v for k, v in old.items()}
    assert found == {2: {**lowered, "cache-control": "b", "date": "d"}, 3: lowered, 4: None}


def test_headers_are_those_of_the_response_that_was_found(spark):
    """Ids that occur on several URLs, or several times on one, are told apart."""
    records = [
        record(1, "http://a.com/", 5, False, etag='"x"', headers={"etag": '"x"', "who": "a"}),
        record(1, "http://b.com/", 5, False, etag='"y"', headers={"etag": '"y"', "who": "b"}),
        record(2, "http://b.com/", 9, True, etag='"y"', headers={}),
        record(3, "http://c.com/", 5, False, etag='"1"', headers={"who": "first"}),
        record(3, "http://c.com/", 5, False, etag='"2"', headers={"who": "second"}),
        record(4, "http://c.com/", 6, True, etag='"2"', headers=None),
        record(None, "http://d.com/", 5, False, etag='"n"', headers={"who": "none"}),
        record(5, "http://d.com/", 6, True, etag='"n"', headers=None),
    ]
    found = resolved(spark, records)
    assert found == {
        2: (1, "resolved", {"etag": '"y"', "who": "b"}),
        4: (3, "resolved", {"who": "second"}),
        5: (None, "resolved", {"who": "none"}),
    }


def test_odd_records(spark):
    records = [
        record(1, "http://a.net/", 5, False),
        record(1, "http://a.net/", 5, False),
        record(2, None, 9, True),
        record(3, "http://a.net/", None, True),
        record(4, "http://a.net/", None, False),
        record(5, "http://a.net/", 9, True),
        record(5, "http://a.net/", 9, True),
    ]
    rows = wr.resolve(spark.createDataFrame(records, SCHEMA)).collect()
    assert sorted((r.record_id, r.outcome, r.response_id or 0) for r in rows) == [
        (2, "orphan", 0),
        (3, "orphan", 0),
        (5, "unverified", 1),
        (5, "unverified", 1),
    ]
    assert wr.resolve(spark.createDataFrame([], SCHEMA)).collect() == []
