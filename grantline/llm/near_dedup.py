"""Near-duplicates by word shingles: b-bit MinHash signatures in a multi-index Hamming join.

Method: a signature has ``CHUNKS * CHUNK`` MinHash values of ``BITS`` bits; its distance is
the number of positions that differ. By pigeonhole, two signatures at a distance of at most
``CHUNKS * (ERRORS + 1) - 1`` have a chunk with at most ``ERRORS`` differing positions.
Enumerating the allowed errors of a chunk, that is, keying it once without each choice of
``ERRORS`` positions, gives every such pair a common key. The default parameters find a pair
of similarity 0.8 with a probability of 1 - 6e-6, and more similar ones nearly surely.

Candidates are confirmed on full shingle sets, so a link is never wrong. How it runs:

1. Rows with equal shingle sets are one class, led by its smallest id.
2. Each leader meets one centre: of the leaders with which it shares keys, those that share
   most keys with others stand for a group. These stars are confirmed; they connect most
   copies of a group of any size without listing its pairs.
3. Keys whose members are still in different components are compared completely, in cells of
   bounded size. Of the pairs in different components with near signatures a task returns
   a spanning forest only, so what it returns is linear in what it reads. Its trees are the
   clusters within which all links still missing must lie.
4. A cluster's texts meet in cells of bounded size, too: those outside its largest component
   with all of them. A cell confirms near pairs, nearest first, until its components are
   joined, and returns the links that join them. No pair is dropped for a group's size.
5. Components by star contraction.

Defined results: null or empty texts have no shingles, link with nothing and are kept. A
text with fewer words than a shingle is one shingle of all its words. Rows that share an id
are one node of the graph. A null id has no component and is kept. Only the id and text
columns are read, so names of others don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantline.checkpoints import written
from grantline.llm import words
from grantline.llm.components import components

SHINGLE = 5
SIMILARITY = 80  # per cent
CHUNKS, CHUNK, ERRORS, BITS = 9, 5, 1, 16
#: More values that are compared but not indexed, and the share of differing ones above
#: which a pair is not worth confirming: 5.5 standard deviations over similarity 0.8.
MORE, FAR = 75, 0.4
#: Members of a group, and shingles of them, that one task confirms or compares at a time.
GROUP, GROUP_SHINGLES = 2000, 1_000_000
_LENGTH = CHUNKS * CHUNK + MORE
_RANDOM = np.random.default_rng(20240601)
_FACTORS = _RANDOM.integers(0, 1 << 63, _LENGTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDENDS = _RANDOM.integers(0, 1 << 63, _LENGTH, dtype=np.uint64)
_CHOICES = np.array(list(combinations(range(CHUNK), CHUNK - ERRORS)))


def _shingle_sets(texts: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    scan = words.scan(texts, lower=True)
    hashes = words.word_hashes(scan)
    windows = words.window_hashes(hashes, shingle)
    for a, b in zip(scan.first[:-1], scan.first[1:]):
        if b - a >= shingle:
            yield np.unique(windows[a : b - shingle + 1])
        elif b > a:
            whole = xxhash.xxh3_64_intdigest(hashes[a:b].tobytes())
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """The MinHash values of each set, cut to ``BITS`` bits; no set may be empty."""
    every = np.concatenate(sets)
    begins = np.cumsum([0] + [len(s) for s in sets[:-1]])
    values = np.empty((len(sets), _LENGTH), np.uint16)
    for i in range(_LENGTH):
        # The upper half of a product is well mixed; its minimum picks a shingle.
        ranks = ((every * _FACTORS[i] + _ADDENDS[i]) >> np.uint64(32)).astype(np.uint32)
        least = np.minimum.reduceat(ranks, begins)
        values[:, i] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.uint16)
    return values


def _feature_maker(shingle: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, "text"):
                sets = list(_shingle_sets(part["text"], shingle))
                full = [i for i, s in enumerate(sets) if len(s)]
                signatures: list = [None] * len(sets)
                if full:
                    for i, row in zip(full, _signatures([sets[i] for i in full])):
                        signatures[i] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        part["id"].combine_chunks(),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array(signatures, pa.binary()),
                    ],
                    ["id", "n_shingles", "digest", "signature"],
                )

    return make


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of each signature: one for each chunk and choice of tolerated errors."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = b"".join(batch["signature"].to_pylist())
        values = np.frombuffer(raw, np.uint16).reshape(-1, _LENGTH).astype(np.uint64)
        keys = []
        for chunk in range(CHUNKS):
            for number, choice in enumerate(_CHOICES):
                key = np.full(len(values), chunk * len(_CHOICES) + number + 1, np.uint64)
                for position in choice:
                    key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ values[:, chunk * CHUNK + position]
                    key ^= key >> np.uint64(29)
                keys.append(key)
        table = np.stack(keys, 1).view(np.int64)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]),
            pa.array(table.ravel()),
        )
        yield pa.RecordBatch.from_arrays([batch["id"], lists], ["id", "keys"])


def _shared_keys(leaders: DataFrame) -> DataFrame:
    """Rows ``key, id, members`` of the keys that several leaders have."""
    keyed = leaders.select("id", "signature").mapInArrow(_keyed, "id long, keys array<long>")
    rows = keyed.select("id", F.explode("keys").alias("key"))
    several = rows.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    return rows.join(several, "key")


def _similar(one: np.ndarray, other: np.ndarray, similarity: int) -> bool:
    small, large = sorted((len(one), len(other)))
    if 100 * small < similarity * large:
        return False
    common = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * common >= similarity * (small + large - common)


def _near(pairs: DataFrame, docs: DataFrame, leaders: DataFrame, shingle: int, similarity: int):
    """Pairs ``a, b`` whose full shingle sets are similar enough.

    The texts of ``b`` come to the text of ``a`` in groups of ``GROUP``, streamed; only
    the set of ``a`` is held.
    """
    numbered = pairs.withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
    wanted = (
        numbered.select("a", "part", F.col("b").alias("id"))
        .unionByName(numbered.select("a", "part", F.col("a").alias("id")).distinct())
        .join(leaders.select("id", "digest"), "id")
    )
    texts = wanted.join(docs.select("id", "text"), "id")
    grouped = texts.repartition("a", "part").sortWithinPartitions(
        "a", "part", (F.col("id") != F.col("a"))
    )

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, heads = None, []
        for batch in batches:
            for piece in words.slices(batch, "text"):
                sets = _shingle_sets(piece["text"], shingle)
                columns = [piece[c].to_pylist() for c in ("a", "part", "id", "digest")]
                links = []
                for a, part, other, digest, own in zip(*columns, sets):
                    if _digest(own) != digest:
                        continue  # another row with this id, of another class
                    if group != (a, part):
                        group, heads = (a, part), []
                    if other == a:
                        heads.append(own)
                    elif any(_similar(head, own, similarity) for head in heads):
                        links.append((a, other))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["u", "v"]
                )

    return grouped.mapInArrow(confirm, "u long, v long")


def _stars(shared: DataFrame) -> DataFrame:
    """For each leader the centre with which it shares most keys. A key's centre is the
    member that meets most others over all its keys; ties to the smaller id."""
    met = shared.groupBy("id").agg(F.sum("members").alias("met"))
    rank = F.struct(F.col("met"), (-F.col("id")).alias("down"))
    centres = shared.join(met, "id").groupBy("key").agg(F.max(rank).alias("best"))
    pairs = shared.join(centres, "key").select("id", (-F.col("best.down")).alias("centre"))
    counted = pairs.where("id <> centre").groupBy("id", "centre").agg(F.count("*").alias("n"))
    often = F.struct(F.col("n"), (-F.col("centre")).alias("down"))
    best = counted.groupBy("id").agg(F.max(often).alias("best"))
    stars = best.select((-F.col("best.down")).alias("a"), F.col("id").alias("b"))
    size = stars.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    return stars.join(size, "a")


def _signature_matrix(table: pa.Table) -> np.ndarray:
    raw = b"".join(table["signature"].to_pylist())
    return np.frombuffer(raw, np.uint16).reshape(table.num_rows, _LENGTH)


def _cell_rows(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of a cell's first part with the rows of the second that it has to meet."""
    parts = table["part"].to_numpy()
    low, high = table["low"][0].as_py(), table["high"][0].as_py()
    left, right = np.flatnonzero(parts == low), np.flatnonzero(parts == high)
    for i in left:
        yield i, right[right > i] if low == high else right


def _forest(table: pa.Table) -> pa.Table:
    """A spanning forest of the pairs that differ in component and have near signatures."""
    ids, component = table["id"].to_numpy(), table["component"].to_numpy()
    values = _signature_matrix(table)
    tree = np.arange(len(ids))
    edges = []
    for i, others in _cell_rows(table):
        others = others[(component[others] != component[i]) & (tree[others] != tree[i])]
        apart = np.count_nonzero(values[others] != values[i], axis=1)
        for j in others[apart <= FAR * _LENGTH]:
            if tree[j] != tree[i]:
                edges.append((ids[i], ids[j]))
                tree[tree == tree[j]] = tree[i]
    return pa.table({n: pa.array([e[k] for e in edges], pa.int64()) for k, n in enumerate("uv")})


def _placed(frame: DataFrame, linked: DataFrame) -> DataFrame:
    """``frame`` with the ``component`` of each id, itself where it has no link yet."""
    joined = frame.join(linked, "id", "left")
    return joined.withColumn("component", F.coalesce("component", "id"))


def _clusters(shared: DataFrame, leaders: DataFrame, linked: DataFrame) -> DataFrame:
    """Edges ``u, v`` that span the near pairs in different components so far."""
    members = _placed(shared.select("key", "id"), linked)
    mixed = (
        members.groupBy("key")
        .agg(
            F.min("component").alias("x"),
            F.max("component").alias("y"),
            F.ceil(F.count("*") / GROUP).alias("parts"),
        )
        .where("x < y")
        .select("key", "parts")
    )
    dealt = (
        members.join(mixed, "key")
        .join(leaders.select("id", "signature"), "id")
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    )
    # A key with many members is a triangle of cells, each with two parts of the members.
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    cells = dealt.withColumn("other", other).select(
        "key",
        F.least("part", "other").alias("low"),
        F.greatest("part", "other").alias("high"),
        "part",
        "id",
        "component",
        "signature",
    )
    return cells.groupBy("key", "low", "high").applyInArrow(_forest, "u long, v long").distinct()


def _settler(shingle: int, similarity: int):
    def settle(table: pa.Table) -> pa.Table:
        """Links that join components of a cell; near pairs are confirmed, nearest first."""
        sets = list(_shingle_sets(table["text"], shingle))
        wanted = table["digest"].to_pylist()
        table = table.filter(pa.array([_digest(s) == w for s, w in zip(sets, wanted)]))
        sets = [s for s, w in zip(sets, wanted) if _digest(s) == w]
        ids, label = table["id"].to_numpy(), table["component"].to_numpy().copy()
        values = _signature_matrix(table)
        links = []
        for i, others in _cell_rows(table) if table.num_rows else ():
            others = others[label[others] != label[i]]
            apart = np.count_nonzero(values[others] != values[i], axis=1)
            for j in others[np.argsort(apart, kind="stable")][: (apart <= FAR * _LENGTH).sum()]:
                if label[j] != label[i] and _similar(sets[i], sets[j], similarity):
                    links.append((ids[i], ids[j]))
                    label[label == label[j]] = label[i]
        return pa.table(
            {n: pa.array([x[k] for x in links], pa.int64()) for k, n in enumerate("uv")}
        )

    return settle


def _settled(
    clusters: DataFrame,
    docs: DataFrame,
    leaders: DataFrame,
    linked: DataFrame,
    shingle: int,
    similarity: int,
) -> DataFrame:
    """Links within clusters (``id, cluster``) that join components."""
    members = written(_placed(clusters.join(leaders, "id"), linked), "members")
    sizes = members.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("cluster").agg(
        F.max(F.struct(F.col("n"), (-F.col("component")).alias("down"))).alias("top")
    )
    sided = members.join(largest, "cluster").withColumn(
        "minor", F.col("component") != -F.col("top.down")
    )

    def parts(side: Column) -> Column:
        count, shingles = F.count_if(side), F.sum(F.when(side, F.col("n_shingles")))
        wanted = F.greatest(count / GROUP, F.coalesce(shingles, F.lit(0)) / GROUP_SHINGLES)
        return F.ceil(wanted)

    # Parts are numbered through, those outside the largest component first.
    shape = sided.groupBy("cluster").agg(
        parts(F.col("minor")).alias("minors"), parts(~F.col("minor")).alias("majors")
    )
    place = F.when(F.col("minor"), F.pmod(F.xxhash64("id"), F.col("minors"))).otherwise(
        F.col("minors") + F.pmod(F.xxhash64("id"), F.col("majors"))
    )
    met = F.when(F.col("minor"), F.col("minors") + F.col("majors")).otherwise(F.col("minors"))
    cells = (
        sided.join(shape, "cluster")
        .withColumn("part", place)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), met - 1)))
        .select(
            "cluster",
            F.least("part", "other").alias("low"),
            F.greatest("part", "other").alias("high"),
            "part",
            "id",
            "component",
            "digest",
            "signature",
        )
    )
    return (
        cells.join(docs, "id")
        .groupBy("cluster", "low", "high")
        .applyInArrow(_settler(shingle, similarity), "u long, v long")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """One row per input row: the id, ``n_shingles`` (size of its set), ``component_id`` (the
    smallest id reachable by links of at least ``similarity`` per cent) and ``kept`` (the id
    is its component's)."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    features = written(
        named.mapInArrow(
            _feature_maker(shingle), "id long, n_shingles long, digest binary, signature binary"
        ),
        "signatures",
    )
    known = features.where("id IS NOT NULL")
    leaders = written(
        known.where("n_shingles > 0")
        .groupBy("digest")
        .agg(
            F.min("id").alias("id"),
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
        ),
        "leaders",
    )
    shared = written(_shared_keys(leaders), "shared_keys")
    stars = written(_stars(shared), "stars")
    links = written(_near(stars, named, leaders, shingle, similarity), "links")
    same = (
        known.where("n_shingles > 0")
        .join(leaders.select("digest", F.col("id").alias("v")), "digest")
        .where("id <> v")
        .select(F.col("id").alias("u"), "v")
        .distinct()
    )
    placed = written(components(links.unionByName(same)), "components")
    forest = written(_clusters(shared, leaders, placed), "forest")
    if not forest.isEmpty():
        clusters = components(forest).withColumnRenamed("component", "cluster")
        more = _settled(clusters, named, leaders, placed, shingle, similarity)
        so_far = placed.select(F.col("id").alias("u"), F.col("component").alias("v"))
        placed = written(components(more.unionByName(so_far)), "components")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return features.join(placed, "id", "left").select(
        F.col("id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
