import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from grantline.llm import substring_dedup as sd
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, width):
    """(n_words, n_removed, kept text, spans) of each row, by comparing every window."""
    last = float("inf")
    smallest = {}
    for doc, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - width + 1):
            window = tuple(words[i : i + width])
            doc_rank = last if doc is None else doc
            smallest[window] = min(smallest.get(window, last), doc_rank)
    result = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - width + 1):
            if smallest[tuple(words[i : i + width])] < (last if doc is None else doc):
                gone[i : i + width] = [True] * width
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        edges = [i for i in range(len(words) + 1) if (i and gone[i - 1]) != (i < len(words) and gone[i])]
        spans = list(zip(edges[::2], edges[1::2]))
        result.append((doc, text, len(words), sum(gone), kept, spans))
    return sorted(result, key=repr)


def found(frame, width, **options):
    result = sd.remove_repeats(frame, width=width, **options).collect()
    return sorted(
        (
            (r.doc_id, r.text, r.n_words, r.n_removed, r.kept_text, [tuple(s) for s in r.spans])
            for r in result
        ),
        key=repr,
    )


@pytest.mark.parametrize("block_bytes", [200, 1 << 20])
def test_against_every_window(spark, block_bytes):
    rows = [(r[0], r[1]) for r in data.rows()]
    assert found(data.frame(spark), 13, block_bytes=block_bytes) == expected(rows, 13)


@given(
    st.lists(
        st.tuples(st.integers(0, 4), st.one_of(st.none(), st.text("ab \n", max_size=30))),
        max_size=8,
    )
)
@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
def test_random_texts_of_few_words(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame, 2, block_bytes=20) == expected(rows, 2)


def test_other_columns_pass_and_results_win(spark):
    docs = data.clashing(data.frame(spark))
    result = sd.remove_repeats(docs)
    assert result.columns.count("n_words") == 1
    assert {(r.block, r.lang) for r in result.where("doc_id = 1").collect()} == {("clash", "en")}
    assert result.where("doc_id = 1").first().n_removed == 60


def test_empty_table(spark):
    assert sd.remove_repeats(data.frame(spark, [])).collect() == []
