import random
import zlib

import pytest

from grantline.llm import compression_quality as cq
from tests.llm import data


def labelled(n):
    """Plain sentences labelled good, symbol noise labelled bad."""
    docs, labels = [], []
    for i in range(n):
        source = random.Random(i)
        text = data.sentence(i, source.randint(5, 80))
        if i % 3 == 0:
            text = " ".join(w + source.choice(["$$$", "###", "&&&"]) for w in text.split())
        docs.append((i, text))
        labels.append((i, int(i % 3 != 0), 0))
    return docs, labels


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = labelled(400)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return frame, cq.fit(frame, spark.createDataFrame(labels, data.LABELS))


def test_held_out_accuracy(learned):
    frame, model = learned
    rows = cq.score(frame, model).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 50
    assert sum(r.predicted == int(r.doc_id % 3 != 0) for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_held_out_labels_are_not_learned(spark, learned):
    frame, model = learned
    _, labels = labelled(400)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    assert cq.fit(frame, spark.createDataFrame(turned, data.LABELS)) == model


def test_odd_texts_and_extra_columns(spark, learned):
    docs = data.clashing(data.frame(spark))
    rows = cq.score(docs, learned[1]).collect()
    assert len(rows) == len(data.rows())
    assert {r.held_out for r in rows if r.doc_id is None} == {False}
    assert len({r.score for r in rows if r.doc_id in (4, 5)}) == 1
    kept = cq.keep(docs, learned[1])
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in rows)


@pytest.mark.parametrize(
    ("labels", "score"), [([], 0.5), ([(1, 1, 0), (9, 1, 0)], 1.0), ([(9, None, 0), (9, 0, 0)], 0.0)]
)
def test_missing_classes(spark, labels, score):
    frame = data.frame(spark)
    model = cq.fit(frame, spark.createDataFrame(labels, data.LABELS))
    assert {r.score for r in cq.score(frame, model).collect()} == {score}


def test_contradictions_and_empty_tables(spark):
    labels = spark.createDataFrame([(9, 1, 0), (9, 0, 0)], data.LABELS)
    assert cq.fit(data.frame(spark), labels).share == 0.5
    model = cq.fit(data.frame(spark, []), labels)
    assert cq.score(data.frame(spark, []), model).collect() == []


def long_text(good, size):
    texts = []
    while sum(map(len, texts)) < size:
        text = data.sentence(10_000 + len(texts), 40)
        noisy = " ".join(w + "$$$###&&&"[i % 7 :][:3] for i, w in enumerate(text.split()))
        texts.append(text if good else noisy)
    return "\n".join(texts)


@pytest.mark.parametrize("size", [100_000, 1_000_000, 2_500_000])
def test_long_texts_are_judged_like_their_parts(learned, size):
    good, bad = cq.scores(learned[1], [long_text(kind, size).encode() for kind in (True, False)])
    assert good > 0.9 and bad < 0.1


def test_labelled_texts_of_any_length_are_learned(spark):
    docs = [(i, long_text(i % 2, 40_000 + 1000 * i)) for i in range(40)]
    labels = [(i, i % 2, 0) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    model = cq.fit(frame, spark.createDataFrame(labels, data.LABELS))
    assert all(r.predicted == r.doc_id % 2 for r in cq.score(frame, model).collect())
    whole = {i: t.encode() for i, t in docs}
    sample = cq._sample(frame, spark.createDataFrame(labels, data.LABELS), "quality")
    assert len(sample) > 20
    for _, part in sample:
        assert 8 << 10 < len(part) <= cq.SAMPLE_TEXT
        assert any(part in cq._parts(t, cq.SAMPLE_TEXT) for t in whole.values())
