"""The registered queries against their reference SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from checks.compare import connect, difference
from grantline.llm import near_dedup, packing, queries, substring_dedup
from tests.llm import data

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return connect(SF)


@pytest.mark.parametrize("name", queries.all_oracles())
def test_query(spark, database, name):
    frame = queries.all_queries()[name](spark, SF)
    assert difference(frame, database, queries.all_oracles()[name]) is None


def test_one_query_for_each_operator():
    numbers = [n[2:].split("_")[0] for n in queries.all_queries() if n != "pipeline"]
    assert numbers == [str(i) for i in range(1, 14)]


def test_stages_in_turn(spark):
    """Each stage on all that the one before kept; decisions take effect."""
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs, texts = source, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, before, SF)
        assert docs.columns == source.columns
        texts[name] = {r.doc_id: r.text for r in docs.collect()}
        assert texts[name].keys() <= {r.doc_id for r in before.collect()}
        if name == "near_dedup":
            again = near_dedup.near_duplicates(docs).collect()
            assert all(r.kept for r in again)
        if name == "substring_dedup":
            assert substring_dedup.remove_repeats(docs).where("n_removed > 0").count() == 0
    assert 0 < len(texts["near_dedup"]) < len(texts["quality_rules"]) <= len(texts["quality_classifier"])
    unchanged = [i for i, t in texts["substring_dedup"].items() if t == texts["near_dedup"][i]]
    assert len(unchanged) > 0.5 * len(texts["substring_dedup"])
    packed = corpus_pipeline.pack(spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == texts["substring_dedup"].keys()
    total = sum(r.length for r in packed)
    assert len({r.sequence_id for r in packed}) <= -(-total // packing.CAPACITY) + 1


def test_stages_take_odd_documents(spark):
    docs = data.frame(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert "sequence_id" in docs.columns
    docs.collect()
