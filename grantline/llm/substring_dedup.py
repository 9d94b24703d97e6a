"""Substring dedup: remove passages that an earlier document also holds.

Method: Rabin-Karp hashes of every window of ``width`` words, counted in Spark; repeated
windows merge into maximal removal intervals.

A word goes if a window that covers it has the same word sequence as a window of a
document with a smaller id. Windows are judged on the input, not on what is left.

How it runs. Documents are dealt into blocks by a hash of id and text. Each block sends
its distinct window hashes, with the smallest document of each, to hash buckets; a bucket
finds the smallest document over all blocks and answers one bit per hash; the block turns
the bits into intervals. A window that a third of all documents share is one entry per
block, so no bucket is hot. Windows meet if a 64-bit hash and the bucket, taken from an
independent hash, agree. The number of buckets follows the data, which keeps the expected
number of chance meetings in a whole corpus below one at any size.

Defined results: a null or empty text has no words and an empty kept text. A null id ranks
after all others: its document loses what any other holds and never makes another lose.
Rows with one id are one document as to "smaller id": they don't affect each other. Other
columns of the input are passed through; input columns named like the results give way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from grantline.llm import blocks, words

WIDTH = 13
#: Text of one block; a block and its hashes are held by one task.
BLOCK_BYTES = 8 << 20
RESULTS = ("n_words", "n_removed", "spans", "kept_text")
_SPAN = T.StructType(
    [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)
_NO_ID = np.iinfo(np.int64).max


class _Windows:
    """Windows of one block: distinct hashes by bucket, and where each occurs."""

    def __init__(self, ids: np.ndarray, texts: pa.Array, width: int, buckets: int):
        self.words = words.scan(texts)
        hashes = words.word_hashes(self.words)
        self.starts = words.window_starts(self.words, width)
        self.ids = ids[self.words.owners()[self.starts]]
        fingerprints = words.window_hashes(hashes, width)[self.starts]
        order = np.lexsort((self.ids, fingerprints))
        ordered = fingerprints[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = ordered[1:] != ordered[:-1]
        leaders = order[fresh]
        dealt = words.window_hashes(hashes, width, 1)[self.starts[leaders]] % np.uint64(buckets)
        by_bucket = np.argsort(dealt, kind="stable")
        self.fingerprints = fingerprints[leaders][by_bucket]
        self.smallest = self.ids[leaders][by_bucket]
        self.bounds = np.searchsorted(dealt[by_bucket], np.arange(buckets + 1, dtype=np.uint64))
        rank = np.empty(len(leaders), np.int64)
        rank[by_bucket] = np.arange(len(leaders))
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = rank[np.cumsum(fresh) - 1]


def _ids(table: pa.Table) -> np.ndarray:
    return table["id"].fill_null(_NO_ID).to_numpy().astype(np.int64)


def _sender(width: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        found = _Windows(_ids(table), table["text"], width, buckets)
        full = np.flatnonzero(np.diff(found.bounds))
        spans = [slice(found.bounds[b], found.bounds[b + 1]) for b in full]
        return pa.table(
            {
                "bucket": pa.array(full, pa.int64()),
                "block": pa.array([table["block"][0].as_py()] * len(full), pa.int64()),
                "n": pa.array([s.stop - s.start for s in spans], pa.int64()),
                "hashes": pa.array(
                    [blocks.packed(found.fingerprints[s]) for s in spans], pa.binary()
                ),
                "docs": pa.array([blocks.packed(found.smallest[s]) for s in spans], pa.binary()),
            }
        )

    return send


def _answer(table: pa.Table) -> pa.Table:
    """For each block's entries of one bucket: does a smaller document hold the window?"""
    rows = table.to_pylist()
    hashes = np.concatenate([blocks.unpacked(r["hashes"], "<u8", r["n"]) for r in rows])
    docs = np.concatenate([blocks.unpacked(r["docs"], "<i8", r["n"]) for r in rows])
    order = np.argsort(hashes)
    ordered = hashes[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    smallest = np.minimum.reduceat(docs[order], np.flatnonzero(fresh))
    later = np.empty(len(order), bool)
    later[order] = docs[order] > smallest[np.cumsum(fresh) - 1]
    bounds = np.cumsum([0] + [r["n"] for r in rows])
    told = [later[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    kept = [i for i, bits in enumerate(told) if bits.any()]
    return pa.table(
        {
            "bucket": pa.array([rows[i]["bucket"] for i in kept], pa.int64()),
            "block": pa.array([rows[i]["block"] for i in kept], pa.int64()),
            "later": pa.array([np.packbits(told[i]).tobytes() for i in kept], pa.binary()),
        }
    )


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(flags.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _remover(width: int, buckets: int, schema: pa.Schema):
    def remove(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        found = _Windows(_ids(table), table["text"], width, buckets)
        later = np.zeros(len(found.fingerprints), bool)
        for bucket, bits in zip(answers["bucket"].to_pylist(), answers["later"].to_pylist()):
            a, b = found.bounds[bucket], found.bounds[bucket + 1]
            later[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        covered = later[found.entry] | (found.ids > found.smallest[found.entry])
        scan = found.words
        total = len(scan.starts)
        steps = np.zeros(total + 1, np.int64)
        np.add.at(steps, found.starts[covered], 1)
        np.add.at(steps, found.starts[covered] + width, -1)
        gone = np.cumsum(steps)[:total] > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        spans, kept = [], []
        for a, b in zip(scan.first[:-1], scan.first[1:]):
            begins, ends = _runs(gone[a:b])
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(begins, ends)])
            stay = np.flatnonzero(~gone[a:b]) + a
            kept.append(_joined(scan, stay))
        return pa.table(
            {
                "row": table["row"].combine_chunks().cast(schema.field("row").type),
                "id": table["id"].cast(schema.field("id").type),
                "text": table["text"].cast(pa.string()),
                "n_words": pa.array(scan.counts, pa.int64()),
                "n_removed": pa.array(before[scan.first[1:]] - before[scan.first[:-1]], pa.int64()),
                "spans": pa.array(spans, schema.field("spans").type),
                "kept_text": pa.array(kept, pa.string()),
            }
        )

    return remove


def _joined(scan: words.Words, stay: np.ndarray) -> str:
    """The given words of one text, joined by one space."""
    if not len(stay):
        return ""
    low, high = scan.starts[stay[0]], scan.ends[stay[-1]] + 1
    marks = np.zeros(high - low + 1, np.int8)
    # Each word is taken with the separator after it, which becomes a space.
    np.add.at(marks, scan.starts[stay] - low, 1)
    np.add.at(marks, scan.ends[stay] + 1 - low, -1)
    data = scan.data[low:high].copy()
    data[scan.ends[stay] - low] = 0x20
    return data[np.cumsum(marks[:-1]) > 0][:-1].tobytes().decode("utf-8", "replace")


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Input rows with ``n_words``, ``n_removed``, ``spans`` (word positions, end exclusive;
    maximal intervals of removed words) and ``kept_text``."""
    buckets = blocks.block_count(docs, text_col, block_bytes)
    others = [c for c in docs.columns if c not in (id_col, text_col, *RESULTS)]
    row = F.struct(F.lit(0).alias("none_"), *[F.col(f"`{c}`") for c in others])
    id_type = docs.schema[id_col].dataType.simpleString()
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(buckets)).alias("block"),
        F.col(id_col).cast("long").alias("id"),
        F.col(text_col).alias("text"),
        row.alias("row"),
    )
    sent = dealt.groupBy("block").applyInArrow(
        _sender(width, buckets), "bucket long, block long, n long, hashes binary, docs binary"
    )
    answers = sent.groupBy("bucket").applyInArrow(_answer, "bucket long, block long, later binary")
    result = T.StructType(
        [
            *dealt.select("row", "id", "text").schema.fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("spans", T.ArrayType(_SPAN)),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    removed = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_remover(width, buckets, to_arrow_schema(result)), result)
    )
    return removed.select(
        F.col("id").cast(id_type).alias(id_col),
        F.col("text").alias(text_col),
        *[F.col(f"row.`{c}`") for c in others],
        *RESULTS,
    )
