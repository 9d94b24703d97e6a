"""Periodic runs of words: stretches that repeat a block of words at least three times.

A run is a stretch of consecutive words of one text with smallest period q (words q apart are
equal) and at least ``max(LEAST, 3 * q)`` words, that no neighbouring word extends with period
q. The collapsed text keeps the first q words of each run.

Method: recursive frequency splitting. Every word of a run occurs at least three times in it,
so a word that occurs less often in its segment is in no run and splits it; segments are split
until nothing changes, those below the least length go. What is left is scanned lag by lag:
a run of period q matches itself q words on over ``max(LEAST - q, 2 * q)`` places in a row, so
some windows of ``_WINDOW`` words, a stride of nearly twice q apart, show it. The number of
looks is the segment's length times the logarithm of it. Windows that match are extended both ways by
prefix hashes, and what is long enough is compared word by word.

The work is done on slices of a few megabytes, all texts of a slice at once; longer texts are
slices of their own.

Defined results: a null or empty text has no words and no runs; its collapsed text is empty.
Equal rows give equal results. Words are told apart by a 64-bit hash, their length, first and
last byte. Other columns are passed through; input columns named like the results give way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from grantline.llm import words

#: Words of the shortest run, and how often a run holds its period at least.
LEAST = 24
TIMES = 3
#: Words of the windows that are compared. A run shows matches over 16 places at least.
_WINDOW = 8
#: Looks taken at a time.
_LOOKS = 1 << 18
RESULTS = ("n_words", "n_runs", "runs", "best", "collapsed_text")
RUN = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("start", "length", "period")]
)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _codes(found: words.Words) -> np.ndarray:
    """Numbers from 0 for the words of a slice, equal for equal words."""
    first = words.word_hashes(found)
    # The second hash takes in the word's length and ends, which no mixing step has touched.
    size = (found.ends - found.starts).astype(np.uint64)
    ends = found.data[found.starts].astype(np.uint64) << np.uint64(8)
    second = size << np.uint64(16) | ends | found.data[found.ends - 1]
    both = np.empty(len(first), [("a", "<u8"), ("b", "<u8")])
    both["a"], both["b"] = first, second
    order = np.argsort(first, kind="stable")
    # Equal first hashes with another second one are told apart by a full sort, if any occur.
    ordered = both[order]
    same = ordered["a"][1:] == ordered["a"][:-1]
    if (same & (ordered["b"][1:] != ordered["b"][:-1])).any():
        order = np.lexsort((second, first))
        ordered = both[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = ordered[1:] != ordered[:-1]
    codes = np.empty(len(order), np.int64)
    codes[order] = np.cumsum(fresh) - 1
    return codes


def segments(codes: np.ndarray, first: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Begins and ends (rows) of the segments that frequency splitting leaves of some texts.

    ``first`` has the number of the first word of each text, and the number of all words.
    """
    kinds = int(codes.max()) + 1 if len(codes) else 1
    sizes = np.diff(first)
    bounds = np.stack([first[:-1], first[1:]], axis=1)[sizes >= least]
    stable = [np.zeros((0, 2), np.int64)]
    while len(bounds):
        sizes = bounds[:, 1] - bounds[:, 0]
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(bounds)), sizes)
        place = np.arange(sizes.sum()) - np.repeat(starts - bounds[:, 0], sizes)
        key = owner * kinds + codes[place]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        edge = np.flatnonzero(np.diff(ordered, prepend=-1))
        counts = np.diff(np.append(edge, len(ordered)))
        rare = np.empty(len(order), bool)
        rare[order] = np.repeat(counts < TIMES, counts)
        split = np.zeros(len(bounds), bool)
        split[owner[rare]] = True
        stable.append(bounds[~split])
        # Stretches of frequent words within the segments that were split.
        good = ~rare & split[owner]
        fresh = good.copy()
        fresh[1:] &= ~good[:-1] | (owner[1:] != owner[:-1])
        last = good.copy()
        last[:-1] &= ~good[1:] | (owner[1:] != owner[:-1])
        bounds = np.stack([place[fresh], place[last] + 1], axis=1)
        bounds = bounds[bounds[:, 1] - bounds[:, 0] >= least]
    found = np.concatenate(stable)
    return found[np.argsort(found[:, 0])]


class _Scan:
    """Words of some segments, longest first, with hashes of windows and of prefixes."""

    def __init__(self, codes: np.ndarray, bounds: np.ndarray):
        sizes = bounds[:, 1] - bounds[:, 0]
        bounds = bounds[np.argsort(-sizes, kind="stable")]
        self.sizes = bounds[:, 1] - bounds[:, 0]
        self.ends = np.cumsum(self.sizes)
        self.segment = np.repeat(np.arange(len(bounds)), self.sizes)
        self.place = np.arange(self.sizes.sum()) + np.repeat(
            bounds[:, 0] - (self.ends - self.sizes), self.sizes
        )
        self.codes = codes[self.place]
        mixed = words._mixed(np.zeros(len(self.codes), np.uint64), self.codes.astype(np.uint64))
        self.windows = words.window_hashes(mixed, _WINDOW)
        self.powers = words._powers(int(_BASE), len(mixed) + 1)
        terms = mixed * self.powers[: len(mixed)]
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(terms)])

    def _alike(self, a: np.ndarray, lag: np.ndarray, size: np.ndarray) -> np.ndarray:
        """May the ``size`` words from ``a`` be those from ``a + lag``? True if they are."""
        b = a + lag
        left = (self.prefix[a + size] - self.prefix[a]) * self.powers[lag]
        return left == self.prefix[b + size] - self.prefix[b]

    def _most(self, limit: np.ndarray, alike) -> np.ndarray:
        """Greatest size up to ``limit`` for which ``alike`` holds, by halving."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            good = alike(middle)
            low = np.where(good, middle, low)
            high = np.where(good, high, middle - 1)
        return low

    def looks(self, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and lags whose windows are equal, lags rising, some lags at a time."""
        lag = 1
        while lag <= self.sizes[0] // TIMES:
            # Only segments that can hold a run of this period; they stand in front.
            usable = int(np.searchsorted(-self.sizes, -max(least, TIMES * lag), "right"))
            if not usable:
                return
            stride = max(least - lag, (TIMES - 1) * lag) - _WINDOW + 1
            total = int(self.ends[usable - 1])
            # Lags taken together share the stride of the least of them.
            together = max(1, min(_LOOKS * stride // total, lag // 8))
            if lag < least:
                together = 1
            lags = np.arange(lag, lag + together)
            places = np.arange(0, total, stride)
            for cut in range(0, len(places), _LOOKS):
                some = places[cut : cut + _LOOKS]
                a = np.repeat(some, together)
                q = np.tile(lags, len(some))
                inside = a + q + _WINDOW <= self.ends[self.segment[a]]
                a, q = a[inside], q[inside]
                equal = self.windows[a] == self.windows[a + q]
                if equal.any():
                    yield a[equal], q[equal]
            lag += together

    def _begin(self, a: np.ndarray, lag: np.ndarray) -> np.ndarray:
        start = (self.ends - self.sizes)[self.segment[a]]
        return a - self._most(a - start, lambda n: self._alike(a - n, lag, n))

    def _end(self, a: np.ndarray, lag: np.ndarray) -> np.ndarray:
        """End of the words that equal those ``lag`` on."""
        stop = self.ends[self.segment[a]]
        return a + self._most(stop - a - lag, lambda n: self._alike(a, lag, n))

    def runs(self, least: int = LEAST) -> np.ndarray:
        """Rows of place in the texts, length and smallest period."""
        found: dict[tuple[int, int], int] = {}
        period = np.zeros(len(self.codes), np.int64)
        until = np.zeros(len(self.codes), np.int64)
        for a, lag in self.looks(least):
            # Within a known run, lags that are multiples of its period tell nothing new.
            known = (until[a] >= a + lag + _WINDOW) & (lag % np.maximum(period[a], 1) == 0)
            a, lag = a[~known], lag[~known]
            if not len(a):
                continue
            begin, end = self._begin(a, lag), self._end(a, lag)
            long = end - begin + lag >= np.maximum(least, TIMES * lag)
            # Lags rise, so the first period of a stretch is its smallest; the others are
            # multiples of it and have the same begin and end.
            stretches = np.unique(np.stack([lag, begin, end], axis=1)[long], axis=0)
            for q, low, high in stretches.tolist():
                for b, e in self._exact(q, low, high, least):
                    stop = e + q
                    if (b, stop) not in found:
                        found[b, stop] = q
                        further = until[b:stop] < stop
                        period[b:stop][further] = q
                        until[b:stop][further] = stop
        rows = [(int(self.place[b]), stop - b, q) for (b, stop), q in found.items()]
        return np.array(sorted(rows, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)

    def _exact(self, lag: int, begin: int, end: int, least: int) -> list[tuple[int, int]]:
        """Stretches of equal words ``lag`` apart, long enough, compared word by word."""
        same = self.codes[begin:end] == self.codes[begin + lag : end + lag]
        if same.all():
            return [(begin, end)]
        edge = np.diff(same.astype(np.int8), prepend=0, append=0)
        pairs = zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist())
        return [
            (begin + a, begin + b) for a, b in pairs if b - a + lag >= max(least, TIMES * lag)
        ]


def runs_of(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows of place, length and smallest period of all runs of some texts, sorted."""
    bounds = segments(codes, first)
    if not len(bounds):
        return np.zeros((0, 3), np.int64)
    return _Scan(codes, bounds).runs()


def _best(runs: list[tuple[int, int, int]]) -> dict | None:
    """The run with the greatest length over period; then the first, then the shortest period."""
    best = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:
            best = start, length, period
    return best and dict(zip(RUN.names, best))


def _collapsed(found: words.Words, keep: np.ndarray) -> list[str]:
    """For each text its words that are kept, joined by one space."""
    starts, ends = found.starts[keep], found.ends[keep]
    marks = np.zeros(len(found.data) + 2, np.int8)
    # Each word is taken with the separator after it, which becomes a space.
    marks[starts] += 1
    marks[ends + 1] -= 1
    data = found.data.copy()
    data[ends] = 0x20
    joined = data[np.cumsum(marks[: len(data)]) > 0].tobytes()
    sizes = np.concatenate([[0], np.cumsum(np.where(keep, found.ends - found.starts + 1, 0))])
    bounds = sizes[found.first].tolist()
    return [joined[a : max(a, b - 1)].decode("utf-8", "replace") for a, b in zip(bounds, bounds[1:])]


def _results(texts: pa.ChunkedArray) -> list[list]:
    """The result columns of a slice."""
    found = words.scan(texts)
    runs = runs_of(_codes(found), found.first)
    keep = np.ones(len(found.starts), bool)
    for start, length, period in runs.tolist():
        keep[start + period : start + length] = False
    bounds = np.searchsorted(runs[:, 0], found.first).tolist()
    listed = [
        [(s - begin, n, q) for s, n, q in runs[a:b].tolist()]
        for begin, a, b in zip(found.first.tolist(), bounds, bounds[1:])
    ]
    return [
        found.counts.tolist(),
        [len(own) for own in listed],
        [[dict(zip(RUN.names, r)) for r in own] for own in listed],
        [_best(own) for own in listed],
        _collapsed(found, keep),
    ]


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_runs``, ``runs`` (by start, then period), ``best`` (the run of
    greatest length over period) and ``collapsed_text``."""
    kept = docs.drop(*[c for c in RESULTS if c != text_col])
    kinds = (T.LongType(), T.LongType(), T.ArrayType(RUN), RUN, T.StringType())
    arrow = [to_arrow_type(kind) for kind in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, text_col):
                made = _results(part[text_col])
                for name, kind, values in zip(RESULTS, arrow, made):
                    part = part.append_column(pa.field(name, kind), pa.array(values, kind))
                yield from part.combine_chunks().to_batches()

    fields = [T.StructField(name, kind) for name, kind in zip(RESULTS, kinds)]
    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))
