"""Small documents with the odd cases that every operator must handle."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
LABELS = "doc_id long, quality int, toxic int"
VOCABULARY = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re") for b in ("st", "nd", "lt", "rk")]


def sentence(seed: int, n: int) -> str:
    source = random.Random(seed)
    return " ".join(source.choice(VOCABULARY) + str(source.randint(0, 30)) for _ in range(n))


def texts() -> dict:
    """Texts by id; None and empty ones, copies, near copies, repeats, a long one."""
    base = sentence(1, 60)
    words = base.split()
    shared = sentence(2, 20)
    return {
        0: base,
        1: base,
        2: " ".join([*words[:30], "changed", *words[31:]]),
        3: base.upper(),
        4: None,
        5: "",
        6: " \n\t ",
        7: "two words",
        8: "Two  words\n",
        9: sentence(3, 15) + "\n" + shared + "\n" + sentence(4, 15),
        10: sentence(5, 25) + " " + shared,
        11: "na " * 60,
        12: "line one here\nline one here\n" * 8,
        13: sentence(6, 3000),
        14: "x" * 5000,
        15: "über straße été ñandú Σίσυφος 漢字 \U0001f600 <|endoftext|> don't 42",
        16: "a$$$ b### c&&& d%%% " * 12,
        17: shared,
        18: "\x00control\x1fcharacters\x85here",
    }


def rows() -> list:
    found = [(i, t, "en", "s", len(t or "")) for i, t in texts().items()]
    # A repeated row, an id with two texts, a null id.
    return [*found, found[9], (10, sentence(7, 30), None, None, None), (None, sentence(1, 60), "en", "s", 0)]


def frame(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, DOCS)


def clashing(docs):
    """``docs`` with more columns, named like what operators use or return."""
    from pyspark.sql import functions as F

    names = "id block part u v key component score kept n_words bin shard uid row token_ids place"
    for name in names.split():
        docs = docs.withColumn(name, F.lit("clash"))
    return docs
