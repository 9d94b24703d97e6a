"""Quality classifier by compression.

Method: two Zstandard dictionaries are built from good and bad labelled texts. A text is
compressed with each; the normalised difference of the sizes, with the share of its length
that a text shrinks to, becomes a calibrated score by logistic regression.

The model is fitted on a bounded sample of labelled rows of any length: at most ``SAMPLE``
rows of each class, picked by a hash of the id among the rows that are not held out. A text
of more than ``SAMPLE_TEXT`` bytes is cut into equal parts of at most that size, of which the
hash picks one. One half of the sample builds the dictionaries, the other calibrates.

What is scored is a part of a text no longer than most that were learned: a longer text is
cut into equal parts, and its score is their mean by length, over the whole text. So no size
is extrapolated. Documents are scored in Arrow batches, with no shuffle; the broadcast model
has a fixed size.

Defined results: null and empty texts are scored as empty ones. A null id is not held out.
Labels that are null, that contradict each other or that name no document are not used. If
a class has no labelled text, every score is the share of good labels, or 0.5 without any.
Only the id and text columns are read, so other names don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.llm import words

SAMPLE = 4000
SAMPLE_TEXT = 16 << 10
DICTIONARY = 112 << 10
LEVEL = 5
THRESHOLD = 0.3
#: Share of the sampled texts that are no longer than the parts that are scored, and the
#: least size of a part.
PART_SHARE = 0.9
LEAST_PART = 1 << 10
FOLDS = 5
_RIDGE = 1.0


@dataclass(frozen=True)
class Model:
    """Dictionaries of both classes, the weights of the standardised features, and the size
    of the parts that are scored."""

    good: bytes
    bad: bytes
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    share: float
    part: int = SAMPLE_TEXT


def held_out(id_col: Column) -> Column:
    """Rows whose label is never learned: a fifth, by the CRC-32 of the id as text."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _dictionary(samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples: their end serves as it is
        return b"".join(samples)[-DICTIONARY:]


class _Sizes:
    """Compressed sizes of a text: with either dictionary and with none."""

    def __init__(self, good: bytes, bad: bytes):
        shared = [zstandard.ZstdCompressionDict(d) for d in (good, bad)]
        self.compressors = [zstandard.ZstdCompressor(level=LEVEL, dict_data=d) for d in shared]
        self.compressors.append(zstandard.ZstdCompressor(level=LEVEL))

    def features(self, text: bytes) -> list[float]:
        good, bad, plain = (len(c.compress(text)) for c in self.compressors)
        size = len(text) + 1
        return [(bad - good) / (bad + good), good / size, plain / size, np.log(size)]


def _parts(text: bytes, size: int) -> list[bytes]:
    """The whole text in equal parts of at most ``size`` bytes."""
    count = max(1, -(-len(text) // size))
    places = [len(text) * i // count for i in range(count + 1)]
    return [text[a:b] for a, b in zip(places, places[1:])]


def _expanded(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Intercept, standardised features and their squares."""
    x = np.clip((features - mean) / scale, -6, 6)
    return np.hstack([np.ones((len(x), 1)), x, x * x])


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps that never raise the loss."""

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * _RIDGE * w @ w)

    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + _RIDGE * weights
        curvature = (x.T * (p * (1 - p))) @ x + _RIDGE * np.eye(len(weights))
        step = np.linalg.solve(curvature, gradient)
        size = 1.0
        while loss(weights - size * step) > loss(weights) and size > 1e-6:
            size /= 2
        weights = weights - size * step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _sample(docs: DataFrame, labels: DataFrame, label: str) -> list[tuple[int, bytes]]:
    """Good and bad texts by the hash of their ids; the rows are bounded before the join."""
    agreed = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).alias("low"), F.max(label).alias("quality"))
        .where("low = quality")
        .withColumn("place", F.xxhash64("doc_id"))
    )
    classes = [
        agreed.where(F.col("quality") == q).orderBy("place", "doc_id").limit(SAMPLE) for q in (0, 1)
    ]
    picked = classes[0].unionByName(classes[1]).select("doc_id", "quality", "place")
    # The part of a text that the hash picks; nearly all texts have one only.
    size = F.octet_length("text").cast("long")
    count = F.ceil(size / SAMPLE_TEXT)
    number = F.pmod("place", count)
    begin, end = (F.floor(size * n / count) for n in (number, number + 1))
    data = F.col("text").cast("binary")
    part = F.substring(data, (begin + 1).cast("int"), (end - begin).cast("int"))
    rows = (
        docs.where(F.octet_length("text") > 0)
        .join(F.broadcast(picked), "doc_id")
        .select("doc_id", "quality", "place", part.alias("text"))
        .groupBy("doc_id", "quality", "place")
        .agg(F.min("text").alias("text"))
        .orderBy("place", "doc_id")
        .select("quality", "text")
        .limit(2 * SAMPLE)
    )
    return [(r.quality, bytes(r.text)) for r in rows.collect()]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Learn from the labels that are not held out; ``labels`` has ``doc_id`` and the label."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sample = _sample(texts, labels, label_col)
    share = float(np.mean([q for q, _ in sample])) if sample else 0.5
    by_class = [[t for q, t in sample if q == which] for which in (0, 1)]
    if not all(by_class):
        return Model(b"", b"", (), (), (), share)
    bad, good = (_dictionary(texts[::2]) for texts in by_class)
    part = int(np.quantile([len(t) for _, t in sample], PART_SHARE))
    part = min(max(part, LEAST_PART), SAMPLE_TEXT)
    halves = [(q, t) for q, texts in enumerate(by_class) for t in (texts[1::2] or texts)]
    rest = [(q, p) for q, t in halves for p in _parts(t, part)]
    sizes = _Sizes(good, bad)
    features = np.array([sizes.features(t) for _, t in rest])
    mean, scale = features.mean(axis=0), features.std(axis=0) + 1e-9
    target = np.array([q for q, _ in rest], float)
    weights = _logistic(_expanded(features, mean, scale), target)
    return Model(good, bad, tuple(mean), tuple(scale), tuple(weights), share, part)


def scores(model: Model, texts: list[bytes]) -> np.ndarray:
    if not model.weights:
        return np.full(len(texts), model.share)
    sizes = _Sizes(model.good, model.bad)
    parts = [_parts(t, model.part) for t in texts]
    features = np.array([sizes.features(p) for ps in parts for p in ps])
    features = features.reshape(-1, len(model.mean))
    x = _expanded(features, np.array(model.mean), np.array(model.scale))
    good = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))
    owners = np.repeat(np.arange(len(texts)), [len(ps) for ps in parts])
    length = np.array([max(1, len(p)) for ps in parts for p in ps], float)
    total = np.bincount(owners, good * length, len(texts))
    return np.clip(total / np.maximum(np.bincount(owners, length, len(texts)), 1), 0, 1)


def keep(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, that the model predicts to be good."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text_col):
                texts = [(t or "").encode() for t in part[text_col].to_pylist()]
                good = scores(shared.value, texts) >= THRESHOLD
                yield from part.filter(pa.array(good)).combine_chunks().to_batches()

    return docs.mapInArrow(run, docs.schema)


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: the id, ``held_out``, ``score`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                texts = [(t or "").encode() for t in part["text"].to_pylist()]
                found = scores(shared.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [part["id"].combine_chunks(), pa.array(found, pa.float64())], ["id", "score"]
                )

    id_type = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, score double"
    )
    return scored.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
