"""Packing token sequences of documents into training sequences of bounded length.

Method: a grouping genetic algorithm. A solution is a set of bins. Crossover injects whole
well-filled bins of one parent into another, removes the bins that hold the same pieces and
best-fits the displaced ones. Islands evolve apart and send their elite to the next island.

How it runs. Only documents longer than a sequence are cut. Pieces are dealt into shards of
about ``SHARD`` by a hash of their row; each shard has ``ISLANDS`` populations, one task
each, and an epoch ends with the migration of elites through a shuffle. A shard whose best
solution meets the lower bound, total length over capacity, evolves no further. Bins that a
shard leaves poorly filled are opened again: their pieces make up the next level, dealt anew
into fewer shards, until one shard is left or a level neither leaves clearly fewer pieces nor
saves a sequence for each shard (pieces of more than half a sequence may never fill one);
then its bins stay as they are. So the loss of dealing into shards stays below a sequence or
so for each shard of the last levels. No task holds more than a shard.

Defined results: a null text is an empty one and packs as the end id alone. Repeated rows
are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.llm import bpe, words

CAPACITY = 2048
END_ID = 0
SHARD = 6000
#: Words that a task remembers.
REMEMBERED = 600_000
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
GENERATIONS = 6
#: Bins of a shard that are filled less than this are packed again on the next level.
CLOSED = 0.985
#: A level goes on to the next one if it leaves at most this share of its pieces.
LEFT = 0.75
#: Sequence ids hold the level in seven bits.
LEVELS = 128


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if
    asked for, ``piece_ids`` (little-endian unsigned 32-bit integers)."""
    source = bpe.read_vocabulary(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast(source)
    end = END_ID.to_bytes(4, "little")
    id_type = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoder_of(shared.value, REMEMBERED)
        for batch in batches:
            for part in words.slices(batch, "text"):
                rows, numbers, starts, lengths, sums, data = [], [], [], [], [], []
                texts = [t or "" for t in part["text"].to_pylist()]
                for row, ids in enumerate(encoder.encode(texts)):
                    ids += end
                    for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        rows.append(row)
                        numbers.append(number)
                        starts.append(at // 4)
                        lengths.append(len(piece) // 4)
                        sums.append(zlib.crc32(piece))
                        data.append(piece if with_ids else None)
                arrays = [
                    part["id"].combine_chunks().take(pa.array(rows, pa.int64())),
                    pa.array(numbers, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(data, pa.binary()),
                ]
                names = ["id", "piece", "start", "length", "ids_crc32", "piece_ids"]
                yield pa.RecordBatch.from_arrays(arrays, names)
        encoder.release()

    cut_up = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        cut,
        f"id {id_type}, piece int, start long, length long, ids_crc32 long, piece_ids binary",
    )
    return cut_up.withColumnRenamed("id", id_col) if with_ids else cut_up.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32"
    )


class _Solution:
    """``bin_of`` each item; bins are numbered without gaps."""

    def __init__(self, bin_of: np.ndarray, lengths: np.ndarray, capacity: int):
        self.bin_of = np.unique(bin_of, return_inverse=True)[1].astype(np.int32)
        self.fill = np.bincount(self.bin_of, lengths).astype(np.int64)
        share = self.fill / capacity
        self.quality = (-len(self.fill), float((share * share).sum()))


def _best_fit(
    bin_of: np.ndarray, items: np.ndarray, lengths: np.ndarray, room: list[int], capacity: int
) -> np.ndarray:
    """Place ``items`` in turn into the fullest bin with room, or into a new bin."""
    holders: dict[int, list[int]] = {}
    present = 0
    for number, left in enumerate(room):
        if left > 0:
            holders.setdefault(left, []).append(number)
            present |= 1 << left
    count = len(room)
    for item, length in zip(items.tolist(), lengths[items].tolist()):
        enough = present >> length
        if enough:
            left = length + (enough & -enough).bit_length() - 1
            numbers = holders[left]
            number = numbers.pop()
            if not numbers:
                present ^= 1 << left
        else:
            left, number = capacity, count
            count += 1
        bin_of[item] = number
        left -= length
        if left:
            numbers = holders.setdefault(left, [])
            if not numbers:
                present |= 1 << left
            numbers.append(number)
    return bin_of


def _by_length(items: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return items[np.argsort(-lengths[items], kind="stable")]


def _start(lengths: np.ndarray, capacity: int, noise: float, random) -> _Solution:
    """Best fit by falling length; noise varies the order between members of a population."""
    order = np.argsort(-lengths * (1 + noise * random.random(len(lengths))), kind="stable")
    bin_of = _best_fit(np.empty(len(lengths), np.int64), order, lengths, [], capacity)
    return _Solution(bin_of, lengths, capacity)


def _rebuilt(base: _Solution, gone: np.ndarray, injected: np.ndarray, lengths, capacity):
    """``base`` without the bins ``gone``; ``injected`` has the new bins of some items, or -1."""
    keep = ~gone
    number = np.cumsum(keep) - 1
    kept_items = keep[base.bin_of]
    bin_of = np.where(kept_items, number[base.bin_of], -1)
    room = (capacity - base.fill[keep]).tolist()
    inside = injected >= 0
    if inside.any():
        new = np.unique(injected[inside], return_inverse=True)[1]
        bin_of[inside] = new + len(room)
        room += (capacity - np.bincount(new, lengths[inside]).astype(np.int64)).tolist()
    displaced = _by_length(np.flatnonzero(bin_of < 0), lengths)
    return _Solution(_best_fit(bin_of, displaced, lengths, room, capacity), lengths, capacity)


def _cross(base: _Solution, donor: _Solution, lengths, capacity, random) -> _Solution:
    """Inject a random half of the donor's better-filled bins into ``base``."""
    better = donor.fill >= np.median(donor.fill)
    chosen = better & (random.random(len(better)) < 0.5)
    injected = np.where(chosen[donor.bin_of], donor.bin_of, -1)
    gone = np.zeros(len(base.fill), bool)
    gone[base.bin_of[injected >= 0]] = True
    return _rebuilt(base, gone, injected, lengths, capacity)


def _mutated(base: _Solution, lengths, capacity, random) -> _Solution:
    """Break up the worst-filled bins and some others."""
    gone = random.random(len(base.fill)) < 0.02
    gone[np.argsort(base.fill)[: 1 + len(gone) // 50]] = True
    none = np.full(len(base.bin_of), -1)
    return _rebuilt(base, gone, none, lengths, capacity)


def _evolved(population: list[_Solution], lengths: np.ndarray, capacity: int, random):
    bound = -(-int(lengths.sum()) // capacity)
    while len(population) < POPULATION:
        population.append(_start(lengths, capacity, 0.1 * len(population), random))
        if -population[-1].quality[0] <= bound:
            break
    for _ in range(GENERATIONS):
        population.sort(key=lambda s: s.quality, reverse=True)
        if -population[0].quality[0] <= bound:
            break
        base, donor = (population[i] for i in random.choice(len(population), 2, replace=False))
        child = _cross(base, donor, lengths, capacity, random)
        changed = _mutated(population[0], lengths, capacity, random)
        population = sorted([*population, child, changed], key=lambda s: s.quality, reverse=True)
        population = population[:POPULATION]
    return population


def _items(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    uid = table["uid"].to_numpy()
    order = np.argsort(uid)
    return uid[order], table["length"].to_numpy()[order]


_STATE = "shard long, island long, bins long, quality double, bin_of binary"


def _first_epoch(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        return _epoch(table, [], capacity, 0)

    return run


def _next_epoch(capacity: int, number: int):
    def run(table: pa.Table, arrived: pa.Table) -> pa.Table:
        return _epoch(table, arrived["bin_of"].to_pylist(), capacity, number)

    return run


def _epoch(table: pa.Table, known: list[bytes], capacity: int, number: int) -> pa.Table:
    """The two best solutions of an island after one epoch that starts with ``known`` ones."""
    shard, island = table["shard"][0].as_py(), table["island"][0].as_py()
    _, lengths = _items(table)
    # The rows may come in any order; equal solutions are one.
    population = [
        _Solution(np.frombuffer(k, np.int32), lengths, capacity) for k in sorted(set(known))
    ]
    random = np.random.default_rng([shard, island, number])
    best = _evolved(population, lengths, capacity, random)[:2]
    return pa.table(
        {
            "shard": pa.array([shard] * len(best), pa.int64()),
            "island": pa.array([island] * len(best), pa.int64()),
            "bins": pa.array([len(s.fill) for s in best], pa.int64()),
            "quality": pa.array([s.quality[1] for s in best], pa.float64()),
            "bin_of": pa.array([s.bin_of.tobytes() for s in best], pa.binary()),
        }
    )


def _place(capacity: int):
    """Length, bin, offset and fill of each item in the best solution of a shard."""

    def run(table: pa.Table, known: pa.Table) -> pa.Table:
        uid, lengths = _items(table)
        rows = known.select(["bins", "quality", "bin_of"]).to_pylist()
        best = min(rows, key=lambda r: (r["bins"], -r["quality"], r["bin_of"]))
        bin_of = np.frombuffer(best["bin_of"], np.int32).astype(np.int64)
        order = np.argsort(bin_of, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        fresh = np.r_[True, np.diff(bin_of[order]) > 0]
        begin = np.maximum.accumulate(np.where(fresh, before, 0))
        offset = np.empty(len(uid), np.int64)
        offset[order] = before - begin
        fill = np.bincount(bin_of, lengths).astype(np.int64)
        shard = np.full(len(uid), table["shard"][0].as_py(), np.int64)
        columns = [shard, uid, lengths, bin_of, offset, fill[bin_of]]
        return pa.table(dict(zip(("shard", "uid", "length", "bin", "offset", "fill"), columns)))

    return run


def _solved(items: DataFrame, shards: int, capacity: int, level: int = 0) -> DataFrame:
    """Rows ``shard, uid, length, bin, offset, fill`` of a level; each deals in its own way."""
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(shards)))
    islands = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ISLANDS - 1).cast("long")))
    each = dealt.withColumn("island", islands).groupBy("shard", "island")
    known = written(each.applyInArrow(_first_epoch(capacity), _STATE), "population")
    for number in range(1, EPOCHS):
        # The elite, an island's better solution, visits the next island.
        elite = known.groupBy("shard", "island").agg(
            F.max_by(
                F.struct("bins", "quality", "bin_of"), F.struct(-F.col("bins"), "quality")
            ).alias("s")
        )
        moved = elite.select(
            "shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), "s.*"
        )
        arrived = known.unionByName(moved).groupBy("shard", "island")
        known = written(
            each.cogroup(arrived).applyInArrow(_next_epoch(capacity, number), _STATE), "population"
        )
    return (
        dealt.groupBy("shard")
        .cogroup(known.groupBy("shard"))
        .applyInArrow(
            _place(capacity),
            "shard long, uid long, length long, bin long, offset long, fill long",
        )
    )


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (rows with a ``length`` of at most ``capacity``) with ``sequence_id`` and
    ``offset``, gapless from 0 in each sequence."""
    numbered = written(
        cut.drop("sequence_id", "offset").withColumn("uid", F.monotonically_increasing_id()),
        "pieces",
    )
    items, places, open_bins = numbered.select("uid", "length"), [], None
    count = items.count()
    for level in range(LEVELS):
        shards = max(1, -(-count // SHARD))
        solved = written(_solved(items, shards, capacity, level), "solved")
        closed = F.col("fill") >= CLOSED * capacity
        first = F.col("offset") == 0
        found = solved.agg(
            F.count_if(first).alias("bins"),
            F.count_if(first & ~closed).alias("open_bins"),
            F.count_if(~closed).alias("left"),
        ).first()
        saves = open_bins is None or open_bins - found.bins >= shards
        # With one shard left there is nothing to gain from another level.
        last = shards == 1 or level == LEVELS - 1 or not (saves or found.left <= LEFT * count)
        base = F.lit(level << 56) + F.shiftleft("shard", 20) + F.col("bin")
        done = F.lit(last) | closed
        places.append(solved.where(done).select("uid", base.alias("sequence_id"), "offset"))
        if last or not found.left:
            break
        items = solved.where(~done).select("uid", "length")
        count, open_bins = found.left, found.open_bins
    placed = places[0]
    for more in places[1:]:
        placed = placed.unionByName(more)
    return numbered.join(placed, "uid").drop("uid")
