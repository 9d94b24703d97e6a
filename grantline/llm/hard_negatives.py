"""Hard-negative mining: rows of another label that an anchor scores nearly like its positives.

An anchor's positives are the ``positives`` best rows of its label. Its hard negatives for a
positive are the best ``negatives`` rows of other labels whose score lies in the window
``LOW * p <= 100 * score <= HIGH * p`` of that positive's score p. Scores are inner products of
components scaled to integers; ties go to the smaller id.

Method: anchor spanning-tree bounds. Anchors that are close to each other share a block, and a
minimal spanning tree of a block links each to a parent at edge distance d. By Cauchy and
Schwarz a candidate x whose score with the parent lies in [s, t] has one with the child in
[s - d|x|, t + d|x|]. Only candidates whose interval meets what is asked for, the scores above
the worst positive so far or the windows, are scored; the others hand their interval on.

How it runs. Anchors are sorted by their signs, range-partitioned, and cut into blocks of a
fixed size; candidates are Arrow batches, cut into shards. Groups of blocks and groups of shards
meet in the cells of a grid, a cogroup on the cell's number: whole blocks and shards are dealt by
hash, so a cell holds a bounded number of either, however often a row is repeated. A cell keeps
the best rows per anchor over all its shards; a window merges the cells. One pass finds the
positives, a second one the negatives.

Defined results: rows with a null id, label or vector, or with null or non-finite components (also
once scaled) take no part. An anchor's partners are rows of other ids; rows that repeat an id are
candidates each, and anchors that repeat one are mined each. Vectors of different lengths are
padded with zeros. Scores are exact; one beyond a long counts as the nearest long. Positive
scores below zero have empty windows. Only the id, vector and label columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.llm.cells import met_in_cells

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: The window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
#: Anchors of a block, candidates of a shard, and how many of either share a cell.
BLOCK, SHARD = 256, 4096
BLOCKS_A_CELL, SHARDS_A_CELL = 16, 2
#: Float sums of integers are exact up to here.
_EXACT = 2.0**53
_LONG = 2**63
#: Share by which bounds are widened for what floats round away.
_SLACK = 1e-9
#: Signs of so many components order the anchors.
_SIGNS = 24

_VECTORS = "ids binary, labels binary, width long, data binary"
_ARROW = pa.schema(
    [("ids", pa.binary()), ("labels", pa.binary()), ("width", pa.int64()), ("data", pa.binary())]
)


_FOUND = ("block", "anchor", "anchor_id", "positive_id", "positive_score")
_MINED = ("block", "anchor", "positive_rank", "negative_id", "negative_score")


def _longs(names: tuple[str, ...]) -> str:
    return ", ".join(f"{n} long" for n in names)


def _usable(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """Rows ``id, label, vector`` that take part; components are scaled doubles."""
    # Spark's floor gives a long; beyond its range a double has no fraction to cut.
    whole = F.transform(
        F.col(vector_col),
        lambda x: F.when(F.abs(x) < 2.0**52, F.floor(x.cast("double") * scale).cast("double"))
        .otherwise(x.cast("double") * scale),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    named = rows.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector")
    )
    return named.where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~odd
    )


def _arrays(part: pa.Table) -> dict[str, np.ndarray]:
    vectors = part["vector"].to_pylist()
    width = max(map(len, vectors))
    data = np.zeros((len(vectors), width))
    for row, vector in zip(data, vectors):
        row[: len(vector)] = vector
    return {
        "ids": part["id"].to_numpy().astype(np.int64),
        "labels": part["label"].to_numpy().astype(np.int64),
        "data": data,
    }


def _row(arrays: dict[str, np.ndarray]) -> dict:
    """Arrays as one row of binaries; components as short as they are exact."""
    data = arrays["data"]
    small = not data.size or np.abs(data).max() < 2**31
    return {
        "ids": arrays["ids"].tobytes(),
        "labels": arrays["labels"].tobytes(),
        "width": data.shape[1] if small else -data.shape[1],
        "data": data.astype(np.int32).tobytes() if small else data.tobytes(),
    }


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
    kind = np.int32 if row["width"] >= 0 else np.float64
    data = np.frombuffer(row["data"], kind).reshape(len(ids), abs(row["width"]))
    return ids, labels, data.astype(np.float64)


def spanning_tree(vectors: np.ndarray) -> np.ndarray:
    """Parents in a minimal spanning tree, and the order in which it grew, as two rows.

    The first anchor is the root; its parent is -1.
    """
    count = len(vectors)
    parents, order = np.full(count, -1, np.int64), np.zeros(count, np.int64)
    squares = (vectors**2).sum(axis=1)
    least = np.full(count, np.inf)
    open_ = np.ones(count, bool)
    open_[0], last = False, 0
    for step in range(1, count):
        distance = squares + squares[last] - 2 * (vectors @ vectors[last])
        closer = open_ & (distance < least)
        least[closer], parents[closer] = distance[closer], last
        last = int(np.where(open_, least, np.inf).argmin())
        if parents[last] < 0:
            parents[last] = order[step - 1]
        open_[last] = False
        order[step] = last
    return np.stack([parents, order])


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _ARROW.append(pa.field("parents", pa.binary()))
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for at in range(0, len(table), BLOCK):
            arrays = _arrays(table.slice(at, BLOCK))
            row = _row(arrays) | {"parents": spanning_tree(arrays["data"]).tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema)


def _to_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        for at in range(0, len(table), SHARD):
            yield pa.RecordBatch.from_pylist([_row(_arrays(table.slice(at, SHARD)))], _ARROW)


class Pair:
    """A block of anchors and a shard of candidates."""

    def __init__(self, block: dict, shard: dict):
        self.anchor_ids, self.anchor_labels, anchors = _unpacked(block)
        self.ids, self.labels, candidates = _unpacked(shard)
        width = max(anchors.shape[1], candidates.shape[1])
        self.anchors, self.candidates = (
            np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (anchors, candidates)
        )
        self.parents, self.order = np.frombuffer(block["parents"], np.int64).reshape(2, -1)
        self.norms = np.sqrt((self.candidates**2).sum(axis=1))
        self.spread = np.abs(self.candidates).sum(axis=1)
        self.scored = 0
        self._wide: dict[int, dict[int, int]] = {}

    def _scores(self, anchor: int, rows: np.ndarray) -> np.ndarray:
        """Scores with some candidates: exact, or rounded where floats can't hold them."""
        self.scored += len(rows)
        return self.candidates[rows] @ self.anchors[anchor]

    def exact(self, anchor: int, rows: np.ndarray, scores: np.ndarray) -> list[int]:
        """Scores as whole numbers, bound to a long."""
        top = np.abs(self.anchors[anchor]).max(initial=0)
        found = []
        for row, score in zip(rows.tolist(), scores.tolist()):
            if self.spread[row] * top >= _EXACT:
                pairs = zip(self.candidates[row].tolist(), self.anchors[anchor].tolist())
                score = sum(int(x) * int(y) for x, y in pairs)
            found.append(max(-_LONG, min(_LONG - 1, int(score))))
        return found

    def rounding(self, anchor: int) -> np.ndarray:
        """How far a float score may be from the exact one, for each candidate."""
        top = np.abs(self.anchors[anchor]).max(initial=0)
        bound = self.spread * top
        return np.where(bound >= _EXACT, bound * _SLACK, 0.0)

    def visit(self, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each anchor, parents first, the candidates that ``wanted`` can't rule out, scored.

        ``wanted(anchor, low, high)`` tells for intervals of scores which candidates to score.
        """
        lows: dict[int, np.ndarray] = {}
        highs: dict[int, np.ndarray] = {}
        children = np.bincount(self.parents[self.parents >= 0], minlength=len(self.parents))
        sizes = np.sqrt((self.anchors**2).sum(axis=1))
        for anchor in self.order.tolist():
            parent = int(self.parents[anchor])
            if parent < 0:
                rows = np.arange(len(self.ids))
                scores = self._scores(anchor, rows)
                slack = self.rounding(anchor)
                low, high = scores - slack, scores + slack
                keep = wanted(anchor, _bound(low), _bound(high))
                yield anchor, rows[keep], _bound(scores[keep])
            else:
                edge = np.sqrt(((self.anchors[anchor] - self.anchors[parent]) ** 2).sum())
                reach = (edge + _SLACK * (sizes[anchor] + sizes[parent])) * self.norms + 1e-6
                low, high = lows[parent] - reach, highs[parent] + reach
                rows = np.flatnonzero(wanted(anchor, _bound(low), _bound(high)))
                scores = self._scores(anchor, rows)
                slack = self.rounding(anchor)[rows]
                low[rows], high[rows] = scores - slack, scores + slack
                yield anchor, rows, _bound(scores)
                children[parent] -= 1
                if not children[parent]:
                    del lows[parent], highs[parent]
            if children[anchor]:
                lows[anchor], highs[anchor] = low, high


def _bound(scores: np.ndarray) -> np.ndarray:
    """Scores beyond a long count as the nearest long."""
    return np.clip(scores, -float(_LONG), float(_LONG))


def _best(entries: list[tuple[int, int]], count: int) -> list[tuple[int, int]]:
    """The first ``count`` of (score, id): higher scores, then smaller ids."""
    return sorted(entries, key=lambda e: (-e[0], e[1]))[:count]


def _leading(scores: np.ndarray, slack: np.ndarray, count: int) -> np.ndarray:
    """Places of scores that may be among the first ``count``."""
    if len(scores) <= count:
        return np.arange(len(scores))
    low = scores - slack
    bar = np.partition(low, len(low) - count)[len(low) - count]
    return np.flatnonzero(scores + slack >= bar)


def _positive_rows(count: int):
    """The best rows of the anchors' labels among the shards of a cell."""

    def run(blocks: pa.Table, shards: pa.Table) -> pa.Table:
        tops: dict[tuple[int, int], list[tuple[int, int]]] = {}
        anchor_ids: dict[tuple[int, int], int] = {}
        for row, shard in _pairs(blocks, shards):
            pair, block = Pair(row, shard), row["block"]

            def wanted(anchor: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                mine = (pair.labels == pair.anchor_labels[anchor]) & (
                    pair.ids != pair.anchor_ids[anchor]
                )
                top = tops.get((block, anchor), [])
                return mine & (high >= top[-1][0]) if len(top) == count else mine

            for anchor, rows, scores in pair.visit(wanted):
                key = block, anchor
                anchor_ids[key] = int(pair.anchor_ids[anchor])
                some = _leading(scores, pair.rounding(anchor)[rows], count)
                if len(some):
                    exact = pair.exact(anchor, rows[some], scores[some])
                    fresh = list(zip(exact, pair.ids[rows[some]].tolist()))
                    tops[key] = _best(tops.get(key, []) + fresh, count)
        return _table(
            [(*key, anchor_ids[key], i, s) for key, top in tops.items() for s, i in top],
            _FOUND,
        )

    return run


def _window(score: int) -> tuple[int, int]:
    """The whole scores of negatives for a positive's score; empty if the second is smaller."""
    return -(-LOW * score // 100), HIGH * score // 100


def _negative_rows(count: int):
    """The best rows of other labels in the windows, among the shards of a cell."""

    def run(blocks: pa.Table, shards: pa.Table) -> pa.Table:
        tops: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        for row, shard in _pairs(blocks, shards):
            pair, block = Pair(row, shard), row["block"]
            windows: dict[int, list[tuple[int, int, int]]] = {}
            for asked in row["asked"]:
                low, high = _window(asked["positive_score"])
                if low <= high:
                    windows.setdefault(asked["anchor"], []).append((asked["rank"], low, high))

            def floor_of(anchor: int, rank: int, low: int) -> int:
                top = tops.get((block, anchor, rank), [])
                return top[-1][0] if len(top) == count else low

            def wanted(anchor: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
                meets = np.zeros(len(low), bool)
                for rank, least, most in windows.get(anchor, ()):
                    meets |= (high >= floor_of(anchor, rank, least)) & (low <= most)
                return (
                    meets
                    & (pair.labels != pair.anchor_labels[anchor])
                    & (pair.ids != pair.anchor_ids[anchor])
                )

            for anchor, rows, scores in pair.visit(wanted):
                slack = pair.rounding(anchor)[rows]
                for rank, least, most in windows.get(anchor, ()):
                    bar = floor_of(anchor, rank, least)
                    inside = np.flatnonzero((scores + slack >= bar) & (scores - slack <= most))
                    sure = inside[(scores[inside] + slack[inside] <= most)]
                    unsure = np.setdiff1d(inside, sure, assume_unique=True)
                    some = np.concatenate([sure[_leading(scores[sure], slack[sure], count)], unsure])
                    if not len(some):
                        continue
                    exact = pair.exact(anchor, rows[some], scores[some])
                    found = zip(exact, pair.ids[rows[some]].tolist())
                    fresh = [e for e in found if least <= e[0] <= most]
                    key = block, anchor, rank
                    tops[key] = _best(tops.get(key, []) + fresh, count)
        return _table([(*key, i, s) for key, top in tops.items() for s, i in top], _MINED)

    return run


def _pairs(blocks: pa.Table, shards: pa.Table) -> Iterator[tuple[dict, dict]]:
    rows = blocks.to_pylist()
    for at in range(len(shards)):
        (shard,) = shards.slice(at, 1).to_pylist()
        for row in rows:
            yield row, shard


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _blocks(anchors: DataFrame, parts: int) -> DataFrame:
    """Numbered blocks of anchors that are close to each other."""
    signs = F.transform(
        F.slice("vector", 1, _SIGNS), lambda x: F.when(x < 0, "0").otherwise("1")
    )
    sorted_ = anchors.withColumn("signs", F.array_join(signs, "")).repartitionByRange(
        parts, "signs", "id"
    ).sortWithinPartitions("signs", "id")
    cut = sorted_.select("id", "label", "vector").mapInArrow(
        _to_blocks, f"{_VECTORS}, parents binary"
    )
    return written(
        cut.withColumn("block", F.monotonically_increasing_id()).select(
            "block", "ids", "labels", "width", "data", "parents"
        ),
        "blocks",
    )


def mine(
    vectors: DataFrame,
    anchors: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` is a condition on the rows of ``vectors``; ``label`` may replace the label column.
    """
    of_label = F.col(label_col) if label is None else label
    usable = _usable(vectors, id_col, vector_col, of_label, scale)
    asking = _usable(vectors.where(anchors), id_col, vector_col, of_label, scale)
    candidates, asked = vectors.count(), asking.count()
    down = max(1, -(-asked // (BLOCK * BLOCKS_A_CELL)))
    across = max(1, -(-candidates // (SHARD * SHARDS_A_CELL)))
    blocks = _blocks(asking, max(1, -(-asked // (4 * BLOCK))))
    shards = usable.mapInArrow(_to_shards, _VECTORS)
    found = met_in_cells(
        blocks, shards, across, down, _positive_rows(positives), _longs(_FOUND)
    )
    order = Window.partitionBy("block", "anchor").orderBy(F.desc("positive_score"), "positive_id")
    best = written(
        found.withColumn("positive_rank", F.row_number().over(order).cast("long")).where(
            F.col("positive_rank") <= positives
        ),
        "positives",
    )
    questions = best.groupBy("block").agg(
        F.collect_list(F.struct("anchor", F.col("positive_rank").alias("rank"), "positive_score")).alias("asked")
    )
    asked_blocks = blocks.join(questions, "block")
    mined = met_in_cells(
        asked_blocks, shards, across, down, _negative_rows(negatives), _longs(_MINED)
    )
    key = ["block", "anchor", "positive_rank"]
    nearest = Window.partitionBy(*key).orderBy(F.desc("negative_score"), "negative_id")
    ranked = mined.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= negatives)
    return best.join(ranked, key).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
