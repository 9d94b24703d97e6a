from collections import Counter

import corpus_pipeline
from tests.llm import data


def test_copies_of_one_id_or_of_none_leave_one(spark):
    first, second, third = (data.sentence(seed, 60) for seed in (101, 102, 103))
    texts = [(1, first)] * 3 + [(None, second)] * 3 + [(None, third), (2, "two words")] * 2
    docs = data.frame(spark, [(i, t, "en", "s", len(t)) for i, t in texts])
    left = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in left.collect())
    assert found == Counter(set(texts))
