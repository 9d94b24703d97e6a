"""Language-model scoring by cross-entropy difference over the whole vocabulary.

Method: two bigram models, the target model from the documents labelled good, the background
model from all documents, of the same order and smoothing. The score of a document is its
loss per token under the target model less that under the background model; the lower, the
more it reads like the target. Every word (A to Z lower-cased) is one of its own, however
rare: nothing is capped or put into classes.

A word's base probability is its share of all tokens. A model mixes it into its unigrams with
the weight ``PRIOR``, and the unigrams into its bigrams with the same weight. No document is
scored by what it added itself: its own counts are taken out of the background and, if it is
labelled good, out of the target. They stay in the base distribution, so that no word is
impossible.

How it runs. Documents are dealt into blocks by a hash of id and text; equal rows of a batch
go as one with their number, so that a much repeated row is a few in its block. The ids labelled good
are looked up by a join of ids and blocks alone and go to the blocks as marks, so texts are
shuffled once. A block sums its words,
contexts and bigrams and sends each distinct one once to a bucket, a range of 64-bit hashes;
the bucket adds the counts over all blocks and answers each block for its own entries, and
the block scores its texts. So a frequent word is one entry per block, no bucket is hot, no
table is broadcast or collected, and the number of buckets follows the data. Words and bigrams
meet if their 64-bit hashes agree.

Defined results: null or empty texts have no tokens, losses of 0 and a score of 0. Rows that
repeat are counted and scored each; a row's own counts are those of one copy. A null id is
never trusted. Without a target the target model is the base distribution. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from grantline.llm import blocks, words

#: Weight of the coarser distribution in the finer one.
PRIOR = 20.0
#: Text of one block; a block and its counts are held by one task.
BLOCK_BYTES = 8 << 20
#: Stands for what is before the first word of a document.
_BEGIN = np.uint64(0x8BB84B93962EACC9)
#: Counts of a word: in all and in trusted documents, as a word and as a context.
_OF_WORD, _OF_PAIR = 4, 2
_SENT = (
    "bucket long, block long, tokens long, trusted_tokens long, n_words long, words binary, "
    "word_counts binary, n_pairs long, pairs binary, pair_counts binary"
)
_ANSWERED = (
    "bucket long, block long, tokens long, trusted_tokens long, n_words long, "
    "word_counts binary, n_pairs long, pair_counts binary"
)


def _summed(entry: np.ndarray, size: int, weights: np.ndarray) -> np.ndarray:
    """Summed weights of each of ``size`` entries; exact, as no block holds 2 ** 53 tokens."""
    return np.bincount(entry, weights, size).astype(np.int64)


def _own(owners: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """For each place: how often its entry occurs in its document."""
    own = np.empty(len(entry), np.int32)
    if not len(entry):
        return own
    order = np.argsort(owners * (int(entry.max()) + 1) + entry)
    fresh = np.ones(len(order), bool)
    fresh[1:] = (np.diff(owners[order]) != 0) | (np.diff(entry[order]) != 0)
    firsts = np.flatnonzero(fresh)
    own[order] = np.repeat(np.diff(firsts, append=len(order)), np.diff(firsts, append=len(order)))
    return own


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one, with their number."""
    for batch in batches:
        rows = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([([], "count_all")])
        yield from rows.rename_columns([*batch.schema.names, "copies"]).to_batches()


class _Block:
    """Words, contexts and bigrams of one block: distinct ones by bucket, and their counts."""

    def __init__(self, table: pa.Table, buckets: int):
        marked = pc.unique(table.filter(table["mark"])["id"])
        table = table.filter(pc.invert(table["mark"]))
        self.ids = table["id"]
        scan = words.scan(table["text"], lower=True)
        self.sizes, self.owners = scan.counts, scan.owners()
        current = words.word_hashes(scan)
        n = len(current)
        previous = np.empty_like(current)
        previous[1:] = current[:-1]
        previous[scan.first[:-1][self.sizes > 0]] = _BEGIN
        self.copies = table["copies"].to_numpy().astype(np.int64)
        times = self.copies[self.owners]
        self.trusted = pc.is_in(self.ids, value_set=marked).to_numpy().astype(bool)[self.owners]
        trusted = times * self.trusted
        self.tokens, self.trusted_tokens = int(times.sum()), int(trusted.sum())
        self.words, entry = np.unique(np.concatenate([current, previous]), return_inverse=True)
        self.word, self.context = entry[:n], entry[n:]
        self.pairs, self.pair = np.unique(words.pair_hashes(previous, current), return_inverse=True)
        del current, previous
        self.word_counts, self.pair_counts = (
            np.array([_summed(e, len(keys), w) for e in entries for w in (times, trusted)])
            for keys, entries in (
                (self.words, (self.word, self.context)),
                (self.pairs, (self.pair,)),
            )
        )
        edges = [-(-(b << 64) // buckets) for b in range(buckets)]
        self.word_bounds, self.pair_bounds = (
            np.append(np.searchsorted(keys, np.array(edges, np.uint64)), len(keys))
            for keys in (self.words, self.pairs)
        )


def _sender(buckets: int):
    schema = to_arrow_schema(T._parse_datatype_string(_SENT))

    def send(table: pa.Table) -> pa.Table:
        block, found, rows = table["block"][0].as_py(), _Block(table, buckets), []
        # A block without tokens has nothing to ask; the others tell each bucket their tokens.
        for bucket in range(buckets if found.tokens else 0):
            w = slice(found.word_bounds[bucket], found.word_bounds[bucket + 1])
            p = slice(found.pair_bounds[bucket], found.pair_bounds[bucket + 1])
            rows.append(
                {
                    "bucket": bucket,
                    "block": block,
                    "tokens": found.tokens,
                    "trusted_tokens": found.trusted_tokens,
                    "n_words": w.stop - w.start,
                    "words": blocks.packed(found.words[w]),
                    "word_counts": blocks.packed(found.word_counts[:, w].ravel()),
                    "n_pairs": p.stop - p.start,
                    "pairs": blocks.packed(found.pairs[p]),
                    "pair_counts": blocks.packed(found.pair_counts[:, p].ravel()),
                }
            )
        return pa.Table.from_pylist(rows, schema)

    return send


def _unpacked_counts(data: bytes, kinds: int, count: int) -> np.ndarray:
    return blocks.unpacked(data, "<i8", kinds * count).reshape(kinds, count)


def _totals(rows: list[dict], keys: str, counts: str, number: str, kinds: int) -> list[bytes]:
    """The counts over all blocks of each block's entries."""
    every = np.concatenate([blocks.unpacked(r[keys], "<u8", r[number]) for r in rows])
    distinct, entry = np.unique(every, return_inverse=True)
    added = np.concatenate([_unpacked_counts(r[counts], kinds, r[number]) for r in rows], axis=1)
    total = np.zeros((kinds, len(distinct)), np.int64)
    for kind in range(kinds):
        np.add.at(total[kind], entry, added[kind])
    bounds = np.cumsum([0] + [r[number] for r in rows])
    return [
        blocks.packed(total[:, entry[a:b]].ravel()) for a, b in zip(bounds[:-1], bounds[1:])
    ]


def _answerer():
    schema = to_arrow_schema(T._parse_datatype_string(_ANSWERED))

    def answer(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        tokens = sum(r["tokens"] for r in rows)
        trusted = sum(r["trusted_tokens"] for r in rows)
        of_words = _totals(rows, "words", "word_counts", "n_words", _OF_WORD)
        of_pairs = _totals(rows, "pairs", "pair_counts", "n_pairs", _OF_PAIR)
        answers = [
            r | {"tokens": tokens, "trusted_tokens": trusted, "word_counts": w, "pair_counts": p}
            for r, w, p in zip(rows, of_words, of_pairs)
        ]
        return pa.Table.from_pylist(
            [{name: a[name] for name in schema.names} for a in answers], schema
        )

    return answer


def _scorer(buckets: int, schema: pa.Schema):
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        found, tokens = _Block(table, buckets), (1, 0)
        of_words = np.zeros((_OF_WORD, len(found.words)), np.int64)
        of_pairs = np.zeros((_OF_PAIR, len(found.pairs)), np.int64)
        for a in answers.to_pylist():
            tokens = a["tokens"], a["trusted_tokens"]
            at, n = found.word_bounds[a["bucket"]], a["n_words"]
            of_words[:, at : at + n] = _unpacked_counts(a["word_counts"], _OF_WORD, n)
            at, n = found.pair_bounds[a["bucket"]], a["n_pairs"]
            of_pairs[:, at : at + n] = _unpacked_counts(a["pair_counts"], _OF_PAIR, n)
        base, size = of_words[0][found.word] / tokens[0], np.maximum(found.sizes, 1)
        own_word, own_context, own_pair = (
            _own(found.owners, e) for e in (found.word, found.context, found.pair)
        )
        means = []
        for which, counted in ((1, found.trusted), (0, True)):  # the target, the background
            others = tokens[which] - found.sizes[found.owners] * counted
            likely = of_words[which][found.word] - own_word * counted + PRIOR * base
            likely *= PRIOR / (others + PRIOR)
            likely += of_pairs[which][found.pair] - own_pair * counted
            losses = np.log(of_words[2 + which][found.context] - own_context * counted + PRIOR)
            losses -= np.log(likely)
            means.append(np.bincount(found.owners, losses, len(size)) / size)
            del others, likely, losses
        return pa.table(
            [
                found.ids.combine_chunks().cast(schema.field("id").type),
                pa.array(found.sizes, pa.int64()),
                *[pa.array(m, pa.float64()) for m in (*means, means[0] - means[1])],
                pa.array(found.copies, pa.int64()),
            ],
            schema=schema,
        )

    return run


def score(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: the id, ``n_tokens``, ``target_loss``, ``background_loss`` (nats
    per token) and ``score``, their difference."""
    buckets = blocks.block_count(docs, text_col, block_bytes)
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(buckets)).alias("block"),
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
    )
    counted = T.StructType([*rows.schema.fields, T.StructField("copies", T.LongType())])
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    marks = (
        rows.select("block", "id")
        .where("id IS NOT NULL")
        .join(good, F.col("id") == F.col("doc_id"), "left_semi")
        .distinct()
        .select(
            "block",
            "id",
            F.lit(None).cast("string").alias("text"),
            F.lit(0).cast("long").alias("copies"),
            F.lit(True).alias("mark"),
        )
    )
    texts = rows.mapInArrow(_collapse, counted).withColumn("mark", F.lit(False))
    dealt = texts.unionByName(marks)
    sent = dealt.groupBy("block").applyInArrow(_sender(buckets), _SENT)
    answers = sent.groupBy("bucket").applyInArrow(_answerer(), _ANSWERED)
    result = T.StructType(
        [
            dealt.schema["id"],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("target_loss", T.DoubleType()),
            T.StructField("background_loss", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("copies", T.LongType()),
        ]
    )
    scored = (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_scorer(buckets, to_arrow_schema(result)), result)
    )
    each = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    again = scored.withColumn("copies", F.explode(each)).drop("copies")
    return again.withColumnRenamed("id", id_col)
