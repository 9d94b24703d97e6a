"""Periodic runs against a plain search over all periods and places."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from grantline.llm import periodic_runs, queries
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(found):
    """Every maximal stretch with a smallest period, by trying all of them."""
    n, runs = len(found), {}
    for q in range(1, n // 3 + 1):
        b = 0
        while b + q < n:
            e = b
            while e + q < n and found[e] == found[e + q]:
                e += 1
            if e - b + q >= max(24, 3 * q):
                runs.setdefault((b, e + q), q)
            b = e + 1
    return sorted(((b, e - b, q) for (b, e), q in runs.items()), key=lambda r: (r[0], r[2]))


def expected(found):
    runs = plain_runs(found)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return runs, best, " ".join(w for i, w in enumerate(found) if i not in gone)


def planted(doc_id, found):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(found), h // 10
    if h % 10 or not n:
        return found
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else found[a + (i - a) % p] for i, w in enumerate(found)]


def texts(seed, count):
    """Random words with blocks that repeat, some of them nested, torn or next to each other."""
    source = random.Random(seed)
    made = []
    for _ in range(count):
        found = []
        while len(found) < source.randint(0, 260):
            kind = source.randint(0, 4)
            letters = "ab" if kind < 2 else "abcdefghijklmnopqrst"
            block = source.choices(letters, k=source.randint(1, 20))
            if kind == 1:
                block = block * source.randint(1, 4) + source.choices(letters, k=2)
            times = source.choice([1, 1, 2, 3, 4, 9, 30])
            repeated = block * times
            found += repeated[: max(1, len(repeated) - source.randint(0, 3))]
        made.append(" ".join(found[:400]))
    return made


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_are_found(seed):
    made = texts(seed, 150)
    import pyarrow as pa

    n_words, n_runs, runs, best, collapsed = periodic_runs._results(pa.chunked_array([made]))
    some = 0
    for i, text in enumerate(made):
        wanted, first, kept = expected(text.split())
        assert [tuple(r.values()) for r in runs[i]] == wanted
        assert n_runs[i] == len(wanted) and n_words[i] == len(text.split())
        assert (best[i] and tuple(best[i].values())) == first
        assert collapsed[i] == kept
        some += len(wanted)
    assert some > 100


def test_splitting_keeps_every_run_in_one_segment():
    source = random.Random(9)
    for _ in range(200):
        codes = np.array([source.randint(0, 12) for _ in range(source.randint(0, 150))], np.int64)
        at = source.randint(0, len(codes))
        codes = np.concatenate([codes[:at], np.tile([90, 91, 90], 9), codes[at:]])
        bounds = periodic_runs.segments(codes, np.array([0, len(codes)]))
        assert any(a <= at and at + 27 <= b for a, b in bounds)
        for a, b in bounds:
            assert b - a >= 24 and min(np.bincount(codes[a:b])[np.unique(codes[a:b])]) >= 3


@pytest.mark.parametrize("found", [["na"] * 200_000, ["a", "b", "a"] * 50_000 + ["c"] * 23])
def test_long_texts(found):
    import pyarrow as pa

    _, n_runs, runs, best, collapsed = periodic_runs._results(pa.chunked_array([[" ".join(found)]]))
    period = len(set(found[:3])) + (found[0] != found[1])
    assert n_runs == [1] and tuple(best[0].values())[2] == period
    assert collapsed[0].split()[:period] == found[:period]


def test_long_random_text_with_one_run():
    import pyarrow as pa

    source = random.Random(3)
    found = [str(source.randint(0, 40)) for _ in range(60_000)]
    block = [str(source.randint(0, 40)) for _ in range(7_001)]
    found[20_000:41_003] = block * 3
    _, n_runs, runs, best, _ = periodic_runs._results(pa.chunked_array([[" ".join(found)]]))
    start, length, period = best[0].values()
    assert (n_runs, period) == ([1], 7_001)
    assert 20_000 - 9 <= start <= 20_000 and length >= 21_003


def test_equal_prefix_hashes_are_not_trusted():
    """A stretch that hashes take for longer than it is comes out as the words have it."""
    codes = np.array([0, 1] * 20 + [2, 3, 4] + [0, 1] * 20, np.int64)
    scan = periodic_runs._Scan(codes, np.array([[0, len(codes)]]))
    assert scan._exact(2, 0, len(codes) - 2, 24) == [(0, 38), (43, 81)]


def test_odd_documents(spark):
    docs = data.clashing(data.frame(spark))
    rows = periodic_runs.find_runs(docs).collect()
    assert len(rows) == docs.count()
    for row in rows:
        runs, best, kept = expected(WORD.findall(row.text or ""))
        assert [tuple(r) for r in row.runs] == runs
        assert (row.best and tuple(row.best)) == best
        assert row.collapsed_text == kept and row.key == "clash"
    assert periodic_runs.find_runs(docs.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf).collect()}
    assert len(rows) == len(docs)
    hit = 0
    for doc in docs:
        found = planted(doc.doc_id, WORD.findall(doc.text or ""))
        runs, best, kept = expected(found)
        row = rows[doc.doc_id]
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (best and 1000 * best[1] // best[2])
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
        hit += bool(runs)
    assert hit > 5


def test_null_ids_are_not_rewritten(spark):
    docs = spark.createDataFrame([(None, "a  b"), (None, None), (1, "")], "doc_id long, text string")
    assert sorted(map(str, (r.text for r in queries._with_planted_runs(docs).collect()))) == ["", "None", "a  b"]
