import random
import re

import numpy as np
import pytest

from grantline.llm import near_dedup as nd
from grantline.llm.components import components
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def shingles(text, n):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) >= n:
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
    return {tuple(words)} if words else set()


def expected(rows, n, similarity):
    """Rows (id, set size, component) by comparing all pairs."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, one in sets:
        for b, other in sets:
            if None in (a, b) or not one or not other or a >= b:
                continue
            common = len(one & other)
            if 100 * common >= similarity * (len(one) + len(other) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def found(frame, **options):
    rows = nd.near_duplicates(frame, **options).collect()
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


def copies(seed, n, edits):
    """A text and copies with some words changed: a group whose links form chains."""
    source = random.Random(seed)
    words = data.sentence(seed, 150).split()
    texts = [" ".join(words)]
    for _ in range(n):
        changed = list(words)
        for _ in range(source.randint(0, edits)):
            changed[source.randrange(len(words))] = f"w{source.randint(0, 999)}"
        texts.append(" ".join(changed))
    return texts


@pytest.mark.parametrize("shingle", [4, 5])
def test_odd_texts(spark, shingle):
    rows = [(r[0], r[1]) for r in data.rows()]
    result = found(data.clashing(data.frame(spark)), shingle=shingle)
    assert result == expected(rows, shingle, 80)


def test_groups_whose_links_need_the_complete_comparison(spark, monkeypatch):
    """Small cells, so that groups span several of them."""
    monkeypatch.setattr(nd, "GROUP", 7)
    monkeypatch.setattr(nd, "GROUP_SHINGLES", 900)
    texts = [t for seed in (11, 12, 13) for t in copies(seed, 25, 9)]
    order = list(range(len(texts)))
    random.Random(5).shuffle(order)
    rows = list(zip(order, texts))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    result = found(frame, shingle=4)
    assert result == expected(rows, 4, 80)
    groups = {c for _, _, c in result}
    assert 3 < len(groups) < len(texts)


def test_near_signatures_always_share_a_key():
    """The pigeonhole guarantee: up to the threshold, whatever positions differ."""
    source = np.random.default_rng(1)
    indexed = nd.CHUNKS * nd.CHUNK
    threshold = nd.CHUNKS * (nd.ERRORS + 1) - 1
    for _ in range(200):
        one = source.integers(0, 1 << 16, nd._LENGTH, dtype=np.uint16)
        other = one.copy()
        other[source.choice(indexed, threshold, replace=False)] ^= 1
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays(
            [pa.array([1, 2]), pa.array([one.tobytes(), other.tobytes()])], ["id", "signature"]
        )
        keys = next(nd._keyed(iter([batch])))["keys"].to_pylist()
        assert set(keys[0]) & set(keys[1])


def test_empty_table(spark):
    assert nd.near_duplicates(data.frame(spark, [])).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(8, 30)] + [(3, 3), (9, 7)]
    frame = spark.createDataFrame(edges, "u long, v long")
    result = {r.id: r.component for r in components(frame).collect()}
    assert result == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 30)}}
