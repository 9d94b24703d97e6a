import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from grantline.llm import packing
from tests.llm import data

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def check(rows, capacity):
    """Sequences are gapless and within bounds; returns their number."""
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def bound(rows, capacity):
    return -(-sum(r.length for r in rows) // capacity)


def test_pieces_and_places_of_odd_texts(spark):
    cut = packing.pieces(data.clashing(data.frame(spark)), PATH, with_ids=True)
    packed = packing.pack(cut).collect()
    by_text = defaultdict(list)
    for r in packed:
        assert zlib.crc32(r.piece_ids) == r.ids_crc32 and len(r.piece_ids) == 4 * r.length
        by_text[r.doc_id].append(r)
    expected = defaultdict(list)
    for doc, text, *_ in data.rows():
        ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[start : start + 2048], "<u4").tobytes()
            expected[doc].append((piece, start, len(part) // 4, zlib.crc32(part)))
    for doc, pieces in expected.items():
        found = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by_text[doc])
        assert found == sorted(pieces)
    assert check(packed, 2048) == bound(packed, 2048)


def lengths(spark, values):
    rows = [(i, int(n)) for i, n in enumerate(values)]
    return spark.createDataFrame(rows, "doc_id long, length long")


def test_several_shards_and_levels_come_near_the_bound(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 150)
    random = np.random.default_rng(3)
    packed = packing.pack(lengths(spark, random.integers(1, 2049, 700))).collect()
    assert len(packed) == 700
    # Two pieces of more than half a sequence never share one.
    least = max(bound(packed, 2048), sum(r.length > 1024 for r in packed))
    assert check(packed, 2048) <= 1.03 * least + 1


def test_crossover_improves_on_best_fit():
    """Triples that fill a bin exactly: best fit alone wastes bins."""
    random = np.random.default_rng(4)
    triples = []
    for _ in range(40):
        a, b = random.integers(500, 800, 2)
        triples += [a, b, 2048 - a - b]
    items = np.array(triples)
    start = packing._start(items, 2048, 0.0, random)
    population = [start]
    for _ in range(15):
        population = packing._evolved(population, items, 2048, random)
    best = population[0]
    assert best.quality >= start.quality
    assert (np.bincount(best.bin_of, items) <= 2048).all()
    assert (best.fill == np.bincount(best.bin_of, items)).all()


@pytest.mark.parametrize("values", [[], [2048], [1], [2048, 2048, 1, 2047], [7] * 500])
def test_simple_tables(spark, values):
    packed = packing.pack(lengths(spark, values)).collect()
    assert sorted(r.length for r in packed) == sorted(values)
    assert check(packed, 2048) == -(-sum(values) // 2048)


@pytest.mark.parametrize("others", [[], [300] * 60 + list(range(1, 900, 9))])
def test_more_shards_of_pieces_that_never_fill_a_sequence(spark, monkeypatch, others):
    """Copies of more than half a sequence; the levels end though most bins stay open."""
    solved, levels = packing._solved, []

    def counted(*args):
        levels.append(args)
        assert len(levels) < 9
        return solved(*args)

    monkeypatch.setattr(packing, "SHARD", 50)
    monkeypatch.setattr(packing, "_solved", counted)
    values = [1100] * 160 + others
    packed = packing.pack(lengths(spark, values)).collect()
    assert sorted(r.doc_id for r in packed) == list(range(len(values)))
    assert check(packed, 2048) <= 160 + len(others) // 20
