import re
from itertools import combinations, product

import pytest

from grantline.llm import url_rules as ur
from tests.llm import data

URLS = [
    None,
    "",
    "no scheme",
    "http://",
    "://Host.ORG/a",
    "HTTPS://A.Example.ORG/es/5?x=1",
    "http://example.org/en/1",
    "http://example.org/en/2",
    "http://notexample.org/es/",
    "http://myorg",
    "http://org/",
    "http://a.com/fr/x://y",
    "http://a.com/de/1.html#top",
    "http://a.com?x=/de/",
    "http://a.com#frag://",
    "http://a.net/de/" + "s/" * 3000 + "end.html?k=v",
    "ftp://user@h.net:80/\u00e9/x",
    "line\nbreak://h\n.net/p\nq?z",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lowered, path


def listed(host, path):
    fits = [
        r
        for r in ur.LISTED
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.host + r.path), default=None)


def pages(spark, urls=URLS):
    return data.clashing(
        spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    )


def no_rules(spark):
    return spark.createDataFrame([], "tokens array<array<string>>, confidence double")


def test_hosts_paths_and_listed_rules(spark):
    rows = ur.judge(pages(spark), no_rules(spark)).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path = split(r.url)
        rule = listed(host, path)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (rule and rule.host + rule.path)
        assert r.verdict == (rule.verdict if rule else "allow")
        assert r.component == "clash"


def labelled(spark):
    urls = [
        (f"http://{'bad' if i % 4 == 0 else 'good'}.site{i % 3}.net/en/{i}", i % 4 == 0 and i % 3 != 1)
        for i in range(240)
    ]
    return urls, spark.createDataFrame([*urls, ("http://x.net/", None)], "url string, bad boolean")


def test_mined_rules_match_all_token_combinations(spark):
    urls, frame = labelled(spark)
    rules = {
        tuple(sorted(part)): r.confidence
        for r in ur.mine(frame).collect()
        for part in product(*r.tokens)
    }
    tokens = {r.url: r.tokens_ for r in ur.parsed(frame).collect()}
    total, bad = {}, {}
    for url, is_bad in urls:
        for size in range(1, len(tokens[url]) + 1):
            for part in combinations(tokens[url], size):
                total[part] = total.get(part, 0) + 1
                bad[part] = bad.get(part, 0) + is_bad
    every = {
        p: bad[p] / n
        for p, n in total.items()
        if bad[p] >= ur.SUPPORT * len(urls) and bad[p] >= ur.CONFIDENCE * n
    }
    least = {
        p: c
        for p, c in every.items()
        if not any(set(o) < set(p) and d >= c for o, d in every.items())
    }
    assert rules == pytest.approx(least)
    assert rules
    verdicts = ur.judge(frame.select("url"), ur.mine(frame)).collect()
    for r in verdicts:
        hit = any(set(p) <= set(tokens[r.url]) for p in every)
        assert r.verdict == ("block" if hit else "allow")


def tokens(url):
    """The distinct tokens of a URL, by plain loops."""
    host, path = split(url)
    if not host:
        return None
    labels = [x for x in host.split(".") if x]
    found = {"scheme:" + url.split("://", 1)[0]} | {f"label:{x}" for x in labels}
    if len(host) <= ur.LONGEST_HOST:
        found |= {"domain:" + ".".join(labels[i:]) for i in range(len(labels) - 1)}
    segments = [x for x in path.split("/") if x]
    found |= {f"segment:{x}" for x in segments if re.search("[^0-9]", x)}
    found.add(f"depth:{min(len(segments), 5)}")
    rest = url.split("://", 1)[1].split("#", 1)[0]
    if "?" in rest:
        keys = [part.split("=", 1)[0] for part in rest.split("?", 1)[1].split("&")]
        found |= {f"key:{k}" for k in keys if k}
    ending = re.search(r"\.(\w+)$", path, re.ASCII)
    found |= {f"ending:{ending.group(1)}"} if ending else set()
    found |= {"number"} if re.search("[0-9]", path) else set()
    return sorted(found | ({"fragment"} if "#" in url else set()))


MANY = [
    "https://www.spam-farm.example.com/en/casino/123?a=1&b=2&&=x&c#f?z=1",
    "https://m.casino-win.example.com/12/a1//a1/",
    "https://localhost/",
    "https://..a..b./",
    "https://" + "x." * 20_000 + "com/p?" + "k=1&" * 20_000,
    "https://h.net/" + "".join(f"s{i}/" for i in range(20_000)),
]


def test_tokens_of_every_part(spark):
    for r in ur.parsed(pages(spark, URLS + MANY)).collect():
        assert r.tokens_ == (None if r.url is None else tokens(r.url)), r.url
    first = tokens(MANY[0])
    assert {"label:spam-farm", "domain:spam-farm.example.com", "segment:casino", "key:b"} <= set(first)


def test_middle_labels_are_mined(spark):
    """Only a middle label, a late segment or a late key tells the bad URLs apart."""
    rows = []
    for i in range(300):
        label = "casino" if i % 10 == 0 else f"site{i % 7}"
        segment = "win" if i % 10 == 3 else f"part{i % 5}"
        key = "spam" if i % 10 == 6 else f"k{i % 6}"
        url = f"https://www.{label}.co{i % 3}.net/en/{segment}/{i}?page=1&{key}=2"
        rows.append((url, i % 10 in (0, 3, 6)))
    rules = ur.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    named = [{t for c in r.tokens for t in c} for r in rules.collect()]
    for token in ("label:casino", "segment:win", "key:spam"):
        assert any(token in tokens for tokens in named)
    unseen = [
        ("https://a.casino.org.net/x", "block"),
        ("https://b.net/q/win/q", "block"),
        ("https://c.net/?z=1&spam=5", "block"),
        ("https://d.net/casinos/?q=win", "allow"),
    ]
    found = ur.judge(pages(spark, [u for u, _ in unseen]), rules).collect()
    assert sorted((r.url, r.verdict) for r in found) == sorted(unseen)


def test_copies_of_a_long_url_are_mined(spark):
    """Forty tokens that always come together are one class, not two to the fortieth sets."""
    long_url = "https://a.b.c.net/" + "".join(f"s{i}/" for i in range(40))
    rows = [(long_url, True)] * 200 + [(f"https://h{i}.org/", False) for i in range(400)]
    rules = ur.mine(spark.createDataFrame(rows, "url string, bad boolean")).collect()
    assert any("segment:s39" in c and "label:a" in c for r in rules for c in r.tokens)


def test_labels_of_pages(spark):
    found = spark.createDataFrame(
        [(0, "http://h.net/en/7"), (1, "http://h.net/en/8.html"), (2, "http://h.net/9/"), (3, None), (4, "http://h.net/en/7?a")],
        "page_id long, url string",
    )
    labels = spark.createDataFrame([(7, 0, 0), (8, 1, 1), (9, 1, None), (7, 1, 0), (None, 0, 0)], data.LABELS)
    rows = {r.url: r.bad for r in ur.labelled_pages(found, labels).collect()}
    assert rows == {
        "http://h.net/en/7": True,
        "http://h.net/en/7?a": True,
        "http://h.net/en/8.html": True,
        "http://h.net/9/": False,
    }


def test_empty_tables_and_no_python(spark):
    none = spark.createDataFrame([], "url string, bad boolean")
    assert ur.mine(none).collect() == []
    assert ur.judge(pages(spark, []), no_rules(spark)).collect() == []
    plan = ur.judge(pages(spark), no_rules(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
