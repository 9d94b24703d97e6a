"""Quality rules: counted rules, then a hashed n-gram log-likelihood ratio.

Method: n-grams of word endings (the last three characters of a word; the last two of two
neighbouring words) are hashed into ``BUCKETS``. Two multinomials over the buckets are
estimated, one from trusted target documents, one from the whole raw corpus. A document's
score is the mean logarithm of target over raw probability of its n-grams; it is kept if
no base rule fails and the score is at least ``THRESHOLD``, a constant: the same text gets
the same verdict beside the same corpus.

Everything runs in DataFrame expressions. The counts of all documents meet per bucket after
a map-side sum; the table of ratios has ``BUCKETS`` entries whatever the corpus. Scoring is
local to a row: no shuffle, so neither long texts nor repeated ids matter. The trusted
documents are all those labelled good.

Defined results: null and empty texts have no words, fail the base rules and score 0. A
null id is never trusted. Input columns named like the results give way.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
#: Weight of the raw distribution, as a count, in the target's: few trusted documents give
#: ratios near 1, not chance verdicts.
PRIOR = BUCKETS
THRESHOLD = -0.55
MIN_WORDS = 10
MAX_REPEATED = 20  # per cent of the words
WINDOW = 5
#: Fixed values of the contract: white space, and what counts as a symbol.
_SPACE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _repeated_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return F.size(lines) - F.size(F.array_distinct(lines))


def _repeat_words(words: str, windows: str) -> Column:
    """Words in windows that are found more than once. Sorting brings equal windows
    together; only texts that have any are sorted."""
    return F.expr(f"""
        CASE WHEN size(array_distinct({windows})) = size({windows}) THEN 0
        ELSE aggregate(
          transform(
            array(transform({windows}, (h, i) -> struct(h, i))),
            marked -> transform(
              array(array_sort(marked)),
              s -> transform(
                array(array_sort(transform(
                  filter(s, (e, k) -> e.h <=> get(s, k - 1).h OR e.h <=> get(s, k + 1).h),
                  e -> e.i))),
                p -> aggregate(
                  transform(p, (x, k) -> least({WINDOW}, coalesce(get(p, k + 1) - x, {WINDOW}))),
                  0, (a, x) -> a + x))[0])[0]),
          0, (a, x) -> a + x)
        END""")


def _once(value: Column) -> Column:
    """A value that later filters can't be rewritten to compute again for each use."""
    return F.explode(F.array(value))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and an internal array of words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    clean = docs.drop(*RESULTS, "base_failed", "kept", "target_score")
    names = [F.col(f"`{c}`") for c in clean.columns]
    windows = F.expr(
        f"CASE WHEN size(words_) < {WINDOW} THEN cast(array() AS array<bigint>) ELSE "
        f"transform(sequence(1, size(words_) - {WINDOW - 1}), "
        f"i -> xxhash64(slice(words_, i, {WINDOW}))) END"
    )
    counted = (
        clean.select(*names, _once(_words(text)).alias("words_"))
        .select(*names, "words_", _once(windows).alias("windows_"))
        .select(
            *names,
            "words_",
            F.size("words_").cast("long").alias("n_words"),
            _without(text, _SPACE).cast("long").alias("word_chars"),
            (F.length(text) - _without(text, _SYMBOLS)).cast("long").alias("n_symbols"),
            _repeated_lines(text).cast("long").alias("n_dup_lines"),
            _repeat_words("words_", "windows_").cast("long").alias("n_repeat_words"),
        )
    )
    too_short = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    return counted.withColumn("base_failed", too_short | repeats)


def _grams(words: str) -> Column:
    """Buckets of the n-grams of an array of words."""
    return F.expr(f"""
        concat(
          transform({words}, w -> cast(pmod(xxhash64(right(w, 3)), {BUCKETS}) AS int)),
          transform(
            slice({words}, 2, greatest(size({words}) - 1, 0)),
            (w, i) -> cast(
              pmod(xxhash64(right({words}[i], 2), right(w, 2)), {BUCKETS}) AS int)))""")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids labelled good."""
    return labels.where("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()


def ratios(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
    """Logarithm of target over raw probability of each bucket, as a list of ``BUCKETS``."""
    trusted = trusted_ids(labels).select(F.col("doc_id").alias("id_"), F.lit(1).alias("good_"))
    texts = docs.select(F.col(id_col).alias("id_"), F.col(text_col).alias("text_"))
    # The good ids grow with the corpus: they are shuffled, at every size.
    flagged = texts.join(trusted.hint("merge"), "id_", "left").select(
        "good_", _words(F.coalesce("text_", F.lit(""))).alias("words_")
    )
    grams = flagged.select(F.col("good_"), F.explode(_grams("words_")).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("good_").alias("target"))
    found = {r.bucket: (r.target, r.raw) for r in counts.collect()}
    all_target = sum(t for t, _ in found.values())
    all_raw = sum(r for _, r in found.values()) + BUCKETS

    def ratio(bucket: int) -> float:
        target, raw = found.get(bucket, (0, 0))
        background = (raw + 1) / all_raw
        mixed = (target + PRIOR * background) / (all_target + PRIOR)
        return math.log(mixed) - math.log(background)

    return [ratio(bucket) for bucket in range(BUCKETS)]


def judged(
    docs: DataFrame, table: list[float], text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``target_score`` and ``kept``."""
    # The table is one literal of fixed size.
    looked_up = F.lit(np.array(table))
    base = measured(docs, text_col)
    scored = base.select("*", _once(_grams("words_")).alias("grams_"))
    total = F.aggregate(
        "grams_", F.lit(0.0), lambda a, g: a + F.get(looked_up, g)
    ) / F.greatest(F.size("grams_"), F.lit(1))
    return (
        scored.withColumn("target_score", total)
        .withColumn("kept", ~F.col("base_failed") & (F.col("target_score") >= threshold))
        .drop("words_", "grams_")
    )
