import math

import numpy as np
import pytest

from grantline.llm import max_score as ms

SCHEMA = "vec_id long, embedding array<float>, label int, id string, block string"


def in_long(score):
    return max(-(2**63), min(2**63 - 1, score))


def brute(rows, k):
    """The contract, pair by pair."""
    valid = []
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        valid.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    result = []
    for q, a in valid:
        if q % 100:
            continue
        scored = [(-in_long(sum(x * y for x, y in zip(a, b))), i) for i, b in valid if i != q]
        result += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(result)


def found(spark, rows, k=10):
    frame = spark.createDataFrame(rows, SCHEMA)
    result = ms.top_k(frame, frame.where("vec_id % 100 = 0"), k=k)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in result.collect())


def vectors(n, width, seed, ties=False):
    random = np.random.default_rng(seed)
    values = random.normal(0, 0.1, (n, width))
    values[:, 0] *= 5  # uneven bounds, so that some terms are not essential
    if ties:
        values = np.round(values, 1)
    return [(i, [float(x) for x in v], 0, "x", "y") for i, v in enumerate(values)]


@pytest.mark.parametrize(("n", "width", "ties"), [(900, 16, False), (700, 3, True), (300, 1, True)])
def test_against_all_pairs(spark, n, width, ties):
    rows = vectors(n, width, n, ties)
    assert found(spark, rows) == brute(rows, 10)


def test_odd_vectors(spark):
    rows = vectors(350, 4, 1)
    rows[0] = (0, [0.5, None, 1.0, 1.0], 0, None, None)
    rows[5] = (5, None, 0, None, None)
    rows[6] = (6, [math.nan] * 4, 0, None, None)
    rows[7] = (7, [math.inf, 1.0, 1.0, 1.0], 0, None, None)
    rows[8] = (8, [], 0, None, None)
    rows[9] = (9, [0.25, 0.5], 0, None, None)
    rows += [rows[20], (None, [1.0] * 4, 0, None, None), (300, [0.0] * 4, 0, "x", "y")][:2]
    assert found(spark, rows) == brute(rows, 10)


@pytest.mark.parametrize("size", [1e5, 7e6, 1e9, 1e30])
def test_large_components_are_exact(spark, size):
    """Scores past the floats' whole numbers, and past a long, which count as the nearest long."""
    random = np.random.default_rng(3)
    rows = [
        (i, [float(x) * size for x in random.integers(-3, 4, 3)] + [float(random.integers(9))], 0, "x", "y")
        for i in range(250)
    ]
    rows += [(400 + i, [0.25 * i, 1.0, 2.0, 3.0], 0, "x", "y") for i in range(20)]
    assert found(spark, rows) == brute(rows, 10)


def test_the_probe_of_scores_that_were_clipped(spark):
    rows = [(0, [100000.0], 0, "", ""), (1, [100000.0], 0, "", ""), (2, [70000.0], 0, "", ""), (3, [1.0], 0, "", "")]
    assert [r[3] for r in found(spark, rows)] == [10485760000000000, 7340032000000000, 104857600000]


def test_repeated_ids_are_queries_and_candidates_each(spark):
    rows = vectors(230, 4, 8)
    rows += [rows[0], rows[100], (200, rows[3][1], 0, "x", "y"), rows[7], rows[7]]
    assert found(spark, rows) == brute(rows, 10)


def test_small_blocks_and_cells_change_nothing(spark, monkeypatch):
    for name, value in (("QUERY_BLOCK", 2), ("SHARD", 60), ("BLOCKS_A_CELL", 1), ("SHARDS_A_CELL", 1)):
        monkeypatch.setattr(ms, name, value)
    rows = vectors(700, 5, 9)
    assert found(spark, rows) == brute(rows, 10)


def test_few_candidates_and_no_rows(spark):
    rows = vectors(3, 4, 2)
    assert found(spark, rows) == brute(rows, 10)
    assert len(found(spark, rows)) == 2
    assert found(spark, rows[1:]) == []
    assert found(spark, []) == []


def test_probing_drops_vectors_that_cannot_win():
    """The shard's own search, with a bar that is reached early."""
    random = np.random.default_rng(0)
    values = random.integers(-1000, 1000, (5000, 24))
    shard = ms.Shard(np.arange(5000), values)
    for q in range(0, 5000, 500):
        ids, scores = shard.top(q, values[q], 10)
        exact = values @ values[q]
        exact[q] = -(10**15)
        order = np.lexsort((np.arange(5000), -exact))[:10]
        assert ids.tolist() == order.tolist() and scores.tolist() == exact[order].tolist()
