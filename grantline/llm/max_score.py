"""Exact top-k search by inner product with MaxScore.

Method: each dimension is a term, and its values over the vectors of a shard are its
postings. A term's bound is the most that it can add to a score. Terms are taken by falling
spread of what they add; the essential ones are the first terms after which the bounds of
the rest can't lift a vector over the current k-th score. Their postings are traversed for
all vectors of the shard; the other terms are probed, some at a time, only for vectors that
are still competitive. Tops of the shards are merged by a window.

Components become ``floor(SCALE * x)``; scores are exact integers. How it runs: shards and blocks
of queries are cut from Arrow batches, whatever their ids; groups of both meet in the cells
of a grid, so no key grows with the data and nothing is broadcast or collected.

Defined results: vectors that are null or hold null or non-finite components, also once
scaled, take no part. Vectors of different lengths are padded with zeros. Where a score
might leave the range of a long, whole numbers of any size are used; a score beyond a long counts
as the nearest long. A query never matches rows of its own id; rows that repeat a candidate's
id are candidates each, and rows that repeat a query's id are queries each, with a ranking of
their own. Only the id and vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.llm.cells import met_in_cells

TOP = 10
SCALE = 1024
#: Queries of a block, vectors of a shard, and how many of either share a cell.
QUERY_BLOCK, SHARD = 512, 4096
BLOCKS_A_CELL, SHARDS_A_CELL = 8, 2
#: Vectors scored completely to get a first k-th score, and terms probed at a time.
_FIRST, _PROBE = 256, 8
_LONG = 1 << 63
#: Sums of products below this stay within a long, whatever is added on the way.
_SAFE = float(1 << 60)


def _valid(vector: Column) -> Column:
    odd = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return vector.isNotNull() & ~odd


def _scaled(x: Column) -> Column:
    """Spark's floor gives a long; a double beyond 2**52 has no fraction to cut."""
    return F.when(F.abs(x) < 2.0**52, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE)


def _packed(ids: pa.ChunkedArray, vectors: pa.ChunkedArray) -> dict:
    """Ids and scaled components (a row for each vector) as bytes, short where they are small;
    ``width`` is negative where components are doubles."""
    lists = vectors.to_pylist()
    width = max(map(len, lists))
    values = np.zeros((len(lists), width), np.float64)
    for row, vector in zip(values, lists):
        row[: len(vector)] = vector
    small = not values.size or np.abs(values).max() < 2**31
    return {
        "ids": ids.to_numpy().astype(np.int64).tobytes(),
        "width": width if small else -width,
        "data": values.astype(np.int32).tobytes() if small else values.tobytes(),
    }


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    kind = np.int32 if row["width"] >= 0 else np.float64
    return ids, np.frombuffer(row["data"], kind).reshape(len(ids), abs(row["width"]))


def _cutter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for at in range(0, len(table), size):
                part = table.slice(at, size)
                yield pa.RecordBatch.from_pylist([_packed(part["id"], part["vector"])], _BLOCK)

    return run


_BLOCK = pa.schema([("ids", pa.binary()), ("width", pa.int64()), ("data", pa.binary())])
_ROW = "ids binary, width long, data binary"


def _whole(values: np.ndarray, wide: bool) -> np.ndarray:
    """Whole numbers: of any size where ``wide``."""
    if not wide:
        return values.astype(np.int64)
    return np.array([[int(x) for x in row] for row in values], object).reshape(values.shape)


def _kth(scores: np.ndarray, k: int):
    """The k-th highest score."""
    if scores.dtype == object:
        return sorted(scores, reverse=True)[k - 1]
    return np.partition(scores, len(scores) - k)[len(scores) - k]


def _in_long(scores):
    """Scores beyond a long count as the nearest long."""
    if isinstance(scores, np.ndarray):
        return np.minimum(np.maximum(scores, -_LONG), _LONG - 1)
    return min(max(scores, -_LONG), _LONG - 1)


class Shard:
    """Postings of a shard: for each term its value in every vector."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        """``vectors`` are whole numbers, 64-bit ones or objects."""
        self.ids = ids
        self.wide = vectors.dtype == object
        self.postings = np.ascontiguousarray(vectors.T)
        self.high = self.postings.max(axis=1)
        self.low = self.postings.min(axis=1)

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best vectors but ``own``; ties to the smaller id."""
        bounded = _in_long if self.wide else (lambda scores: scores)
        weights = np.zeros(len(self.postings), self.postings.dtype)
        weights[: len(query)] = query[: len(weights)]
        bound = np.maximum(weights * self.high, weights * self.low)
        least = np.minimum(weights * self.high, weights * self.low)
        order = np.argsort(least - bound, kind="stable")
        # The most and the least that the terms after the first i can add.
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0)
        sure = np.append(np.cumsum(least[order][::-1])[::-1], 0)
        others = self.ids != own
        first = np.flatnonzero(others)[:_FIRST]
        sample = weights @ self.postings[:, first]
        bar = bounded(_kth(sample, k)) if len(sample) >= k else np.iinfo(np.int64).min
        # Essential terms: a vector that gets the least from them all can't reach the bar.
        useless = bounded(sure[0] - sure + rest) < bar
        essential = int(np.argmax(useless)) if useless.any() else len(order)
        head = order[:essential]
        scores = weights[head] @ self.postings[head]
        live = np.flatnonzero((bounded(scores + rest[essential]) >= bar).astype(bool) & others)
        scores = scores[live]
        at = essential
        while at < len(order):
            terms = order[at : at + _PROBE]
            scores = scores + weights[terms] @ self.postings[np.ix_(terms, live)]
            at += len(terms)
            if len(live) > k:
                bar = max(bar, bounded(_kth(scores, k) + sure[at]))
            good = (bounded(scores + rest[at]) >= bar).astype(bool)
            live, scores = live[good], scores[good]
        if self.wide:
            scores = _in_long(scores)
            best = np.array(sorted(range(len(live)), key=lambda i: (-scores[i], self.ids[live[i]])), int)
        else:
            best = np.lexsort((self.ids[live], -scores))
        return self.ids[live[best[:k]]], scores[best[:k]].astype(np.int64)


def _searcher(k: int):
    def run(blocks: pa.Table, shards: pa.Table) -> pa.Table:
        asked = [(row["block"], *_unpacked(row)) for row in blocks.to_pylist()]
        found: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []
        for at in range(len(shards)):
            (row,) = shards.slice(at, 1).to_pylist()
            ids, vectors = _unpacked(row)
            most = np.abs(vectors).max(axis=0, initial=0).sum()
            shard = {}
            for block, own, queries in asked:
                for place, query in enumerate(queries):
                    wide = bool(float(most) * np.abs(query).max(initial=0) >= _SAFE)
                    if wide not in shard:
                        shard[wide] = Shard(ids, _whole(vectors, wide))
                    weights = _whole(query[None], wide)[0]
                    best = shard[wide].top(int(own[place]), weights, k)
                    found.append((block, place, int(own[place]), *best))
        sizes = [len(f[3]) for f in found]
        empty = [np.zeros(0, np.int64)]
        columns = [np.repeat(np.array([f[i] for f in found], np.int64), sizes) for i in range(3)]
        columns += [np.concatenate(empty + [f[i] for f in found]) for i in (3, 4)]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(_FOUND, columns)})

    return run


_FOUND = ("block", "place", "query_id", "vec_id", "score")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = TOP,
) -> DataFrame:
    """The ``k`` best of ``vectors`` for each of ``queries``: ``query_id, rank, vec_id, score``."""

    def usable(rows: DataFrame) -> DataFrame:
        scaled = F.transform(F.col(vector_col), lambda x: _scaled(x.cast("double")))
        named = rows.select(F.col(id_col).cast("long").alias("id"), scaled.alias("vector"))
        return named.where(F.col("id").isNotNull() & _valid(F.col("vector")))

    asked, candidates = queries.count(), vectors.count()
    down = max(1, -(-asked // (QUERY_BLOCK * BLOCKS_A_CELL)))
    across = max(1, -(-candidates // (SHARD * SHARDS_A_CELL)))
    blocks = usable(queries).mapInArrow(_cutter(QUERY_BLOCK), _ROW)
    blocks = written(blocks.withColumn("block", F.monotonically_increasing_id()), "queries")
    shards = usable(vectors).mapInArrow(_cutter(SHARD), _ROW)
    found = met_in_cells(
        blocks, shards, across, down, _searcher(k), ", ".join(f"{n} long" for n in _FOUND)
    )
    best = Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
