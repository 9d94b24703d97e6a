import math
import re
from collections import Counter

import pytest
import xxhash

from grantline.llm import target_ratio as tr
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    n, repeated = len(words), len(covered)
    return (
        n,
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeated,
        n < 10 or 100 * repeated > 20 * n,
    )


def grams(text):
    words = WORD.findall(text or "")

    def hashed(*parts):
        seed = 42
        for part in parts:
            seed = xxhash.xxh64_intdigest(part.encode(), seed)
        return seed % tr.BUCKETS

    return [hashed(w[-3:]) for w in words] + [
        hashed(a[-2:], b[-2:]) for a, b in zip(words, words[1:])
    ]


def table(rows, trusted):
    raw, target = Counter(), Counter()
    for doc, text in rows:
        raw.update(grams(text))
        if doc in trusted:
            target.update(grams(text))
    all_raw, all_target = sum(raw.values()) + tr.BUCKETS, sum(target.values())
    background = [(raw[b] + 1) / all_raw for b in range(tr.BUCKETS)]
    return [
        math.log((target[b] + tr.PRIOR * p) / (all_target + tr.PRIOR) / p)
        for b, p in enumerate(background)
    ]


@pytest.fixture(scope="module")
def judged(spark):
    frame = data.clashing(data.frame(spark))
    labels = spark.createDataFrame([(0, 1, 0), (9, 1, 1), (16, 0, 0), (None, 1, 0)], data.LABELS)
    found = tr.ratios(frame, labels)
    return found, tr.judged(frame, found).collect()


def test_base_counts(judged):
    for r in judged[1]:
        found = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert (*found, r.base_failed) == counts(r.text), r.text


def test_ratios_and_scores(judged):
    rows = [(r[0], r[1]) for r in data.rows()]
    expected = table(rows, {0, 9})
    assert judged[0] == pytest.approx(expected)
    for r in judged[1]:
        buckets = grams(r.text)
        score = sum(expected[b] for b in buckets) / max(1, len(buckets))
        assert r.target_score == pytest.approx(score, abs=1e-9)
        assert r.kept == (not r.base_failed and r.target_score >= tr.THRESHOLD)
        assert r.block == "clash" and r.lang in ("en", None)


def test_verdicts(judged):
    kept = {r.doc_id: r.kept for r in judged[1]}
    assert kept[0] and kept[9] and not kept[11] and not kept[4]


def test_only_expressions_are_used(spark):
    frame = data.frame(spark)
    plan = tr.judged(frame, [0.0] * tr.BUCKETS)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_empty_table(spark):
    none = spark.createDataFrame([], data.LABELS)
    found = tr.ratios(data.frame(spark, []), none)
    assert found == [0.0] * tr.BUCKETS
    assert tr.judged(data.frame(spark, []), found).collect() == []


def test_every_document_labelled_good_is_target(spark):
    """More good ids than the 20,000 that were once the most: all documents are the target."""
    n = 21_000
    frame = spark.range(n).selectExpr("id AS doc_id", "concat('the w', id) AS text")
    labels = spark.range(n).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    assert tr.trusted_ids(labels).count() == n
    found = tr.ratios(frame, labels)
    rows = [(i, f"the w{i}") for i in range(n)]
    assert found == pytest.approx(table(rows, set(range(n))))
