"""Piece coding against the sentencepiece library, and spans against the source text."""

import random

import public_tokenizers
import pytest
import sentencepiece

from grantline.llm import piece_coding, queries
from tests.llm import data

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    "", " ", "  ", " a", "a ", "\t\n", "▁", "▁▁a▁ b", "<s></s><unk><0x41>", "\x00\x01", " " * 3000,
    "x" * 5000, "漢字" * 300, "\U0001f600 é", "é", "ﬁ  ﬀ", "﻿a", "�", "\U0010ffff",
    " \xa0 ", "ab" * 40 + " " * 17 + "the",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    return piece_coding.Model(piece_coding.read_model(PATH))


def some_texts():
    source = random.Random(5)
    letters = "ab  ▁<>0x\n\té漢\U0001f600theing"
    drawn = ["".join(source.choices(letters, k=source.randint(0, 90))) for _ in range(1500)]
    return ODD + drawn + [t or "" for t in data.texts().values()]


def test_ids_and_spans_are_the_librarys(model, library):
    texts = some_texts()
    counts, (ids, starts, ends) = piece_coding.encoded(model, texts)
    at = 0
    for text, count in zip(texts, counts.tolist()):
        mine = slice(at, at + count)
        at += count
        wanted = library.encode(text, return_type="proto").pieces
        assert ids[mine].tolist() == [p.id for p in wanted]
        assert list(zip(starts[mine].tolist(), ends[mine].tolist())) == [
            (p.begin, p.end) for p in wanted
        ]


def test_forgetting_changes_nothing(library):
    small = piece_coding.Model(piece_coding.read_model(PATH), remembered=3)
    for text in some_texts()[:60]:
        assert piece_coding.encoded(small, [text])[1][0].tolist() == library.encode(text)


def test_heap_and_rows_agree(model):
    source = random.Random(6)
    for _ in range(300):
        unit = "▁" + "".join(source.choices("theiraton", k=source.randint(1, 40)))
        ((_, _, symbols),) = [
            x for x in model._merged_together([unit], 48) if len(x[0])
        ]
        assert [model.texts[s] for s in symbols] == model._merged_long(list(unit))


def test_decodes_any_ids_like_the_library(model, library):
    source = random.Random(7)
    for _ in range(3000):
        ids = [
            source.choice([source.randrange(32000), source.randrange(300), 28705])
            for _ in range(source.randint(0, 12))
        ]
        assert model.decode(ids) == library.decode(ids)
    assert model.decode([-1, 10**6, None]) == library.decode([0, 0, 0])


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("remove", [True, False])
def test_character_map_and_its_alignment(rule, remove):
    """The longest entries of compiled maps, with the source of every character."""
    library = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, remove_extra_whitespaces=remove, escape_whitespaces=True
    )
    top = dict(piece_coding._fields(library.serialized_model_proto()))
    blob = dict(piece_coding._fields(top[piece_coding.NORMALIZER]))[piece_coding.CHARACTER_MAP]
    model = piece_coding.Model(piece_coding.read_model(PATH))
    model.map, model.remove = piece_coding.CharacterMap(blob), remove
    source = random.Random(8)
    letters = "aÅ  ﬁｆ①㍿éが゙ǅß​\t\xa0漢"
    drawn = ["".join(source.choices(letters, k=source.randint(1, 25))) for _ in range(400)]
    for text in [*drawn, "ｆｕｌｌ  ①x ", "   ", " a  b  "]:
        normal, aligned = model.normalised(text)
        wanted, places = library.normalize(text, with_offsets=True)
        assert normal == wanted
        starts = [0]
        for char in normal:
            starts.append(starts[-1] + len(char.encode()))
        offsets = [0]
        for char in text:
            offsets.append(offsets[-1] + len(char.encode()))
        if normal:
            assert [aligned[s] for s in starts] == [offsets[p] for p in places]


def test_spans_through_a_map(model):
    """Pieces of a normalised text cover the source without gaps."""
    other = piece_coding.Model(piece_coding.read_model(PATH))
    other.remove = True
    text = "  the   house is  here "
    _, (ids, starts, ends) = piece_coding.encoded(other, [text])
    words = [text.encode()[a:b].decode().strip() for a, b in zip(starts, ends)]
    assert "".join(words) == "thehouseishere"
    assert all(a <= b for a, b in zip(starts, ends))


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        piece_coding.Model(b"")


def test_rows_pass_through(spark, library):
    docs = data.clashing(data.frame(spark)).withColumnRenamed("n_words", "starts")
    coded = piece_coding.encode(docs, PATH)
    rows = piece_coding.decode(coded, PATH).collect()
    assert len(rows) == docs.count()
    for row in rows:
        wanted = library.encode(row.text or "")
        assert row.token_ids == wanted
        assert row.decoded == library.decode(wanted)
        assert len(row.starts) == len(row.ends) == len(wanted)
        assert row.key == "clash"


def test_null_ids_and_empty_tables(spark):
    ids = spark.createDataFrame([(1, None), (2, []), (3, [1, None])], "doc_id long, token_ids array<int>")
    found = {r.doc_id: r.decoded for r in piece_coding.decode(ids, PATH).collect()}
    assert found[1] is None and found[2] == "" and "⁇" in found[3]
    assert piece_coding.encode(data.frame(spark).limit(0), PATH).collect() == []


def test_query(spark, library):
    import hashlib

    rows = queries.op13_piece_coding(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = {r.doc_id: r.text or "" for r in docs}
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
