"""Words, word hashes and window hashes of a column of texts, vectorised.

A word is a maximal run of bytes other than space and 0x09 to 0x0D. All those are ASCII,
so scanning UTF-8 bytes gives the same words as scanning code points. A null text has no
words. Everything works on whole texts; callers bound memory by the number of texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FIRST_BYTES = np.array(
    [(1 << (8 * n)) - 1 for n in range(8)] + [0xFFFFFFFFFFFFFFFF], dtype=np.uint64
)
#: Odd multipliers of the mixing steps and bases of the two window hashes.
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_MODULUS = 1 << 64
#: Words longer than this are hashed one by one; there are few of them.
_LONG_WORD = 64
#: Texts are scanned in slices of about this many bytes.
SLICE_BYTES = 4 << 20


@dataclass
class Words:
    """Words of some texts in order; text ``t`` owns words ``first[t]:first[t + 1]``."""

    data: np.ndarray  # bytes of all texts, each followed by a line feed
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def scan(texts: pa.Array, lower: bool = False) -> Words:
    """Find the words; ``lower`` maps A to Z first."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    filled = pc.fill_null(pc.cast(texts, pa.large_string()), "")
    nothing, line_feed = (pa.scalar(x, pa.large_string()) for x in ("", "\n"))
    joined = pc.binary_join_element_wise(filled, nothing, line_feed)
    offsets = np.frombuffer(joined.buffers()[1], np.int64, len(joined) + 1, joined.offset * 8)
    if not len(joined):
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), empty, empty, np.zeros(1, np.int64))
    size = int(offsets[-1] - offsets[0])
    data = np.frombuffer(joined.buffers()[2], np.uint8, size, int(offsets[0]))
    if lower:
        data = _LOWER[data]
    separator = _SEPARATOR[data]
    before = np.empty_like(separator)
    before[0] = True
    before[1:] = separator[:-1]
    starts = np.flatnonzero(before & ~separator)
    ends = np.flatnonzero(~before & separator)
    first = np.searchsorted(starts, offsets - offsets[0])
    return Words(data, starts, ends, first)


def slices(batch: pa.RecordBatch | pa.Table, column: str) -> Iterator[pa.Table]:
    """Cut a batch into runs of rows with about ``SLICE_BYTES`` of text, one row at least."""
    table = pa.Table.from_batches([batch]) if isinstance(batch, pa.RecordBatch) else batch
    lengths = pc.fill_null(pc.binary_length(table[column]), 0).to_numpy().astype(np.int64)
    filled = np.cumsum(lengths)
    begin = 0
    while begin < table.num_rows:
        done = filled[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(filled, done + SLICE_BYTES, side="right")))
        yield table.slice(begin, end - begin)
        begin = end


def _mixed(state: np.ndarray, value: np.ndarray) -> np.ndarray:
    state = (state ^ value) * _MIX_A
    state ^= state >> np.uint64(32)
    state *= _MIX_B
    state ^= state >> np.uint64(29)
    return state


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time over all words at once."""
    lengths = words.ends - words.starts
    state = _mixed(np.zeros(len(lengths), np.uint64), lengths.astype(np.uint64))
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(words.data) + 1,), "<u8", padded.data, strides=(1,))
    step, active = 0, np.flatnonzero((lengths > 0) & (lengths <= _LONG_WORD))
    while active.size:
        left = lengths[active] - step
        value = eights[words.starts[active] + step] & _FIRST_BYTES[np.minimum(left, 8)]
        state[active] = _mixed(state[active], value)
        active, step = active[left > 8], step + 8
    for i in np.flatnonzero(lengths > _LONG_WORD):
        state[i] = xxhash.xxh3_64_intdigest(words.data[words.starts[i] : words.ends[i]].tobytes())
    return state


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each ordered pair of word hashes."""
    return _mixed(_mixed(np.full(len(first), _BASES[0], np.uint64), first), second)


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    if n:
        powers[0] = 1
    return np.multiply.accumulate(powers)


def window_hashes(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Rabin-Karp hash modulo 2**64 of each run of ``width`` word hashes, mixed at the end.

    Prefix sums of hash times power give every window by one subtraction; the power is
    then taken out with the inverse of the base, so equal windows agree wherever they are.
    """
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = _BASES[which]
    terms = hashes * _powers(base, len(hashes))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(terms)])
    raw = (prefix[width:] - prefix[:n]) * _powers(pow(base, -1, _MODULUS), n)
    return _mixed(raw, np.full(n, which + 1, np.uint64))


def window_starts(words: Words, width: int) -> np.ndarray:
    """Numbers of the words at which a window of ``width`` words of one text starts."""
    total = len(words.starts)
    end_of_text = np.repeat(words.first[1:], words.counts)
    return np.flatnonzero(np.arange(total) + width <= end_of_text)
