import math
import re
from collections import Counter

import pytest

from grantline.llm import lm_whole, queries
from grantline.llm.lm_whole import PRIOR
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def tokens(text):
    return WORD.findall((text or "").translate(UPPER))


def counters(texts):
    pairs, unigrams, context = Counter(), Counter(), Counter()
    for text in texts:
        found = tokens(text)
        unigrams.update(found)
        context.update([None, *found][: len(found)])
        pairs.update(zip([None, *found], found))
    return pairs, unigrams, context


def losses(rows, trusted):
    """Mean losses of each text by both models, with plain counters of words. A model is counted
    over the other rows."""
    base = counters(t for _, t in rows)[1]
    total = sum(base.values())
    models = [counters(t for i, t in rows if i in trusted), counters(t for _, t in rows)]

    def loss(model, text, counted):
        own = counters([text] if counted else [])
        pairs, unigrams, context = (Counter(m) for m in model)
        for all_, mine in zip((pairs, unigrams, context), own):
            all_.subtract(mine)
        size, found, sums = sum(unigrams.values()), tokens(text), 0.0
        for p, w in zip([None, *found], found):
            unigram = (unigrams[w] + PRIOR * base[w] / total) / (size + PRIOR)
            sums -= math.log((pairs[p, w] + PRIOR * unigram) / (context[p] + PRIOR))
        return sums / max(1, len(found))

    return [
        (len(tokens(t)), loss(models[0], t, i in trusted), loss(models[1], t, True)) for i, t in rows
    ]


@pytest.mark.parametrize("block_bytes", [3000, 8 << 20])
def test_against_counters(spark, block_bytes):
    many = (50, " ".join(f"rare{i}" for i in range(2500)), "en", "s", 0)
    every = [*data.rows(), many]
    frame = data.clashing(data.frame(spark, every)).repartition(3)
    labels = spark.createDataFrame([(0, 1, 0), (9, 1, 0), (11, 0, 0), (None, 1, 0)], data.LABELS)
    rows = [(r[0], r[1]) for r in every]
    found = lm_whole.score(frame, labels, block_bytes=block_bytes).collect()
    key = lambda r: repr((r[0], r[1], round(r[2], 6)))
    actual = sorted(((r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in found), key=key)
    wanted = sorted(((i, *e) for (i, _), e in zip(rows, losses(rows, {0, 9}))), key=key)
    for a, b in zip(actual, wanted, strict=True):
        assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-9, abs=1e-9)
    assert all(r.score == r.target_loss - r.background_loss for r in found)


def test_rare_words_count_in_the_query(spark, tmp_path):
    """The texts differ in rare words only; 2500 words are more frequent."""
    good, bad = (" ".join(f"{k}{i}" for i in range(20)) for k in ("good", "bad"))
    common = " ".join(f"c{i}" for i in range(2500))
    docs = [*[(i, common) for i in range(5)], (10, good), (11, good), (12, bad), (13, bad)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], data.DOCS)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(10, 1, 0)], data.LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    scores = {r.doc_id: r.score for r in queries.op10_lm_difference(spark, str(tmp_path)).collect()}
    assert scores[11] < scores[12] - 0.01
    # The labelled one learns nothing of itself: only an unlabelled copy is left to know its words.
    assert scores[10] > scores[11] + 0.01


def test_repeated_rows_are_few_in_their_block(spark):
    """A third of all rows are equal, null id and null text included; each is scored."""
    many = [(7, "one and the same text"), (None, None)] * 300
    rest = [(100 + i, data.sentence(i, 12)) for i in range(600)]
    rows = [(i, t, "en", "s", 0) for i, t in [*many, *rest]]
    frame = data.frame(spark, rows).repartition(2)
    labels = spark.createDataFrame([(7, 1, 0), (101, 1, 0)], data.LABELS)
    found = lm_whole.score(frame, labels, block_bytes=3000).collect()
    ids = Counter(r.doc_id for r in found)
    assert ids[7] == 300 and ids[None] == 300 and len(found) == 1200
    (n, target, background), *_ = losses([(i, t) for i, t, *_ in rows], {7, 101})
    same = next(r for r in found if r.doc_id == 7)
    assert same.n_tokens == n
    assert (same.target_loss, same.background_loss) == pytest.approx((target, background), rel=1e-9)
    batch = next(lm_whole._collapse(iter(data.frame(spark, rows).select("doc_id", "text").toArrow().to_batches())))
    assert batch.num_rows < 620


def test_no_target_and_no_documents(spark):
    none = spark.createDataFrame([], data.LABELS)
    rows = lm_whole.score(data.frame(spark), none).collect()
    assert len(rows) == len(data.rows()) and all(math.isfinite(r.score) for r in rows)
    assert lm_whole.score(data.frame(spark, []), none).collect() == []
