"""BPE encoding and decoding with a vocabulary in a tokenizers JSON file.

Method: a segment tree over the ranks of adjacent pairs. Each leaf holds the rank of the
pair that starts at a symbol, joined with its position, so the root is the leftmost
lowest-rank merge. A merge updates three leaves and their paths, until the root says that
no pair can merge. Short words of like length share arrays of trees, a step of all words of an
array at a time; long words have a tree of their own, so a run of a million letters costs n log n.

The text model is the file's: special tokens are cut out of the raw text, the rest is
normalised (NFC, white space, lower case), split by the file's pattern and mapped to byte
symbols, the last with an end-of-word suffix. No token crosses white space; so encoding
works on runs between white space and remembers a bounded number of them per worker.

Defined results: a null text encodes as an empty one; ids of an empty text are empty. Null
ids decode to null, empty ones to an empty text. Other columns are passed through; input
columns named like the results give way.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from grantline.llm import words

#: Words that a worker remembers before it starts afresh, and half as many runs; about 250
#: bytes each.
REMEMBERED = 500_000
#: Words of more symbols get a tree of their own.
SHORT = 64
#: Words whose trees make up one array, so that it stays in a core's cache.
TOGETHER = 4096
#: Children of a node in the trees of short words.
FAN = 8
_NONE = np.int64(np.iinfo(np.int64).max)
#: Odd multiplier that spreads pairs over their table.
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Runs with other characters go to the library's own splitter. U+0130 is among them: its
#: lower case is a letter and a mark.
_UNUSUAL = re.compile(r"[^\t-\r !-~\u00a1-\u012f\u0131-\u024f]")
#: What str.split() takes for white space and the pattern doesn't.
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself if it is printable Latin-1, or the next
    free code point from 256."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    symbols, spare = [], 256
    for byte in range(256):
        symbols.append(chr(byte if byte in printable else spare))
        spare += byte not in printable
    return symbols


class Vocabulary:
    """Tables of a byte-level BPE model with an end-of-word suffix."""

    def __init__(self, source: str):
        spec = json.loads(source)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.library = Tokenizer.from_str(source)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, number in [*vocab.items(), *self.special.items()]:
            self.tokens[number] = token
        symbols = _byte_symbols()
        self.stand_in = {s: b for b, s in enumerate(symbols)}
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + suffix] for s in symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self._lay_out(keys)
        split = next(
            p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.pattern_or_line = regex.compile(split["pattern"]["Regex"] + r"|\n")
        self.specials = re.compile("|".join(f"({re.escape(s)})" for s in self.special) or "(?!)")

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).view(np.int64)

    def _lay_out(self, keys: np.ndarray) -> None:
        """Put the pairs, given by rank, into a table of four slots or more for each; a pair whose
        slot is taken goes to the next free one."""
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, _NONE)
        keys, ranks = np.unique(keys, return_index=True)
        slots = self._slots(keys)
        while keys.size:
            free = self.keys[slots] < 0
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.ranks[slots[placed]] = ranks[placed]
            keys, ranks = keys[~placed], ranks[~placed]
            slots = (slots[~placed] + 1) & (len(self.keys) - 1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols; ``_NONE`` where the pair has no merge."""
        wanted = (left << 32) | right
        slots = self._slots(wanted)
        seen = self.keys[slots]
        ranks = np.where(seen == wanted, self.ranks[slots], _NONE)
        rest = np.flatnonzero((seen != wanted) & (seen >= 0))
        while rest.size:
            slots[rest] = (slots[rest] + 1) & (len(self.keys) - 1)
            seen = self.keys[slots[rest]]
            same = seen == wanted[rest]
            ranks[rest[same]] = self.ranks[slots[rest[same]]]
            rest = rest[~same & (seen >= 0)]
        return ranks

    def pieces(self, run: str) -> list[bytes | str]:
        """Words of a run without white space as UTF-8, special tokens as they are."""
        if run.isalpha() and not _UNUSUAL.search(run):
            return [run.lower().encode()]
        found: list[bytes | str] = []
        for part in filter(None, self.specials.split(run)):
            if part in self.special:
                found.append(part)
            elif _UNUSUAL.search(part):
                plain = self.library.normalizer.normalize_str(part)
                for word, _ in self.library.pre_tokenizer.pre_tokenize_str(plain):
                    found.append(bytes(self.stand_in[c] for c in word))
            else:
                found += [w.encode() for w in self.pattern.findall(part.lower())]
        return found


def _merge_short(vocabulary: Vocabulary, texts: list[bytes], size: int) -> list[bytes]:
    """Ids of words of at most ``size + 1`` bytes; one tree of ``size`` leaves for each, its nodes
    the least of up to ``FAN`` children."""
    count, width = len(texts), size + 2
    lengths = np.array([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    first = np.arange(count) * width
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.repeat(first, lengths) + column
    ids = np.zeros(count * width, np.int64)
    ids[place] = vocabulary.inner[flat]
    final = np.cumsum(lengths) - 1
    ids[first + lengths - 1] = vocabulary.last[flat[final]]
    alive = np.zeros(count * width, bool)
    alive[place] = True
    # Column ``size + 1`` stands for "no neighbour".
    after = np.tile(np.minimum(np.arange(1, size + 3), size + 1), count)
    after[first + lengths - 1] = size + 1
    before = np.tile(np.arange(-1, size + 1), count)
    before[first] = size + 1
    leaves = np.full(count * size, _NONE)
    paired = np.delete(place, final)
    where = np.delete(column, final)
    ranks = vocabulary.rank(ids[paired], ids[paired + 1])
    # A row has two columns more than leaves.
    leaves[paired - paired // width * 2] = np.where(ranks == _NONE, _NONE, ranks * size + where)
    span = min(size, FAN)
    children = leaves.reshape(-1, span)
    nodes = children.min(axis=1).reshape(count, -1)
    root = nodes.min(axis=1)
    rows = np.flatnonzero(root != _NONE)
    while rows.size:
        best, at = np.divmod(root[rows], size)
        base, tree = rows * width, rows * size
        gone = after[base + at]
        beyond = after[base + gone]
        ahead = before[base + at]
        ids[base + at] = vocabulary.merged[best]
        alive[base + gone] = False
        after[base + at] = beyond
        before[base + beyond] = at
        changed = [tree + at, (tree + gone)[gone < size]]
        for leaf in changed:
            leaves[leaf] = _NONE
        for left, right in ((at, beyond), (ahead, at)):
            there = np.flatnonzero((left < size) & (right <= size))
            start, leaf = left[there], tree[there] + left[there]
            ranks = vocabulary.rank(ids[base[there] + start], ids[base[there] + right[there]])
            leaves[leaf] = np.where(ranks == _NONE, _NONE, ranks * size + start)
            changed.append(leaf)
        if size == span:
            root[rows] = children[rows].min(axis=1)
        else:
            node = np.concatenate(changed) // span
            nodes.reshape(-1)[node] = children[node].min(axis=1)
            root[rows] = nodes[rows].min(axis=1)
        rows = rows[root[rows] != _NONE]
    flat_ids = ids[alive].astype("<u4").tobytes()
    bounds = [0, *(4 * np.cumsum(alive.reshape(count, width).sum(axis=1))).tolist()]
    return [flat_ids[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _merge_long(vocabulary: Vocabulary, text: bytes) -> bytes:
    """Ids of one long word; the same tree as plain lists."""
    raw = np.frombuffer(text, np.uint8)
    start = vocabulary.inner[raw]
    start[-1] = vocabulary.last[raw[-1]]
    count = len(start)
    size = 1 << (count - 1).bit_length()
    none = int(_NONE)
    ranks = vocabulary.rank(start[:-1], start[1:])
    level = np.full(size, _NONE)
    level[: count - 1] = np.where(ranks == _NONE, _NONE, ranks * size + np.arange(count - 1))
    levels = [level]
    while len(level) > 1:
        level = np.minimum(level[::2], level[1::2])
        levels.append(level)
    tree = np.concatenate([[_NONE], *levels[::-1]]).tolist()
    merges = {}
    ids, merged = start.tolist(), vocabulary.merged
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))

    def rank(left: int, right: int) -> int:
        pair = (left, right)
        if pair not in merges:
            merges[pair] = int(vocabulary.rank(np.array([left]), np.array([right]))[0])
        return merges[pair]

    def put(leaf: int, value: int) -> None:
        node = leaf + size
        tree[node] = value
        while node > 1:
            node >>= 1
            least = min(tree[2 * node], tree[2 * node + 1])
            if tree[node] == least:
                break
            tree[node] = least

    while tree[1] != none:
        best, at = divmod(tree[1], size)
        gone = after[at]
        beyond = after[gone]
        ids[at], ids[gone] = int(merged[best]), -1
        after[at] = beyond
        put(gone, none)
        value = none
        if beyond < count:
            before[beyond] = at
            value = rank(ids[at], ids[beyond])
        put(at, value * size + at if value != none else none)
        ahead = before[at]
        if ahead >= 0:
            value = rank(ids[ahead], ids[at])
            put(ahead, value * size + ahead if value != none else none)
    return np.array([i for i in ids if i >= 0], "<u4").tobytes()


def merge_words(vocabulary: Vocabulary, texts: list[bytes]) -> list[bytes]:
    """Ids of each word, as little-endian unsigned 32-bit integers."""
    result: list[bytes] = [b""] * len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(lengths, kind="stable")
    short = int(np.searchsorted(lengths[order], SHORT, side="right"))
    by_length = order.tolist()
    for first in range(0, short, TOGETHER):
        alike = by_length[first : min(short, first + TOGETHER)]
        leaves = max(2, len(texts[alike[-1]]) - 1)
        size = leaves if leaves <= FAN else -(-leaves // FAN) * FAN
        found = _merge_short(vocabulary, [texts[i] for i in alike], size)
        for i, ids in zip(alike, found):
            result[i] = ids
    for i in by_length[short:]:
        result[i] = _merge_long(vocabulary, texts[i])
    return result


class Encoder:
    """Encodes texts; remembers about ``remembered`` words and half as many runs."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED):
        self.vocabulary = vocabulary
        self.remembered = remembered
        self.runs: dict[str, bytes] = {}
        self.words: dict[bytes | str, bytes] = {}
        self._forget_words()

    def release(self) -> None:
        """Give the memory back: workers live on, and other stages run in them."""
        self.runs.clear()
        self._forget_words()

    def _forget_words(self) -> None:
        self.words.clear()
        special = self.vocabulary.special.items()
        self.words.update((token, number.to_bytes(4, "little")) for token, number in special)

    def _pieces(self, runs: list[str]) -> list[list[bytes | str]]:
        """The words of each run; plain runs are split all at once."""
        together = "\n".join(runs)
        if _UNUSUAL.search(together) or any(s in together for s in self.vocabulary.special):
            return [self.vocabulary.pieces(run) for run in runs]
        # Runs with this separator are unusual.
        found = "\x1f".join(self.vocabulary.pattern_or_line.findall(together.lower())).encode()
        return [run.split(b"\x1f") for run in found.split(b"\x1f\n\x1f")] if runs else []

    def _learn(self, runs: set[str]) -> None:
        letters = [run for run in runs if run.isalpha()]
        if _UNUSUAL.search("".join(letters)):
            letters = [run for run in letters if not _UNUSUAL.search(run)]
        others = list(runs.difference(letters))
        single = "\n".join(letters).lower().encode().split(b"\n") if letters else []
        pieces = self._pieces(others)
        fresh = set(chain(single, chain.from_iterable(pieces))).difference(self.words)
        order = list(fresh)
        self.words.update(zip(order, merge_words(self.vocabulary, order)))
        look = self.words.__getitem__
        self.runs.update(zip(letters, map(look, single)))
        self.runs.update((run, b"".join(map(look, p))) for run, p in zip(others, pieces))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.words) > self.remembered:
            self._forget_words()
        if len(self.runs) > self.remembered // 2:
            self.runs.clear()
        split = [_SPACE.split(t) if _ODD_SPACE.search(t) else t.split() for t in texts]
        runs = list(chain.from_iterable(split))
        ids = list(map(self.runs.get, runs))
        unknown = [i for i, known in enumerate(ids) if known is None]
        if unknown:
            self._learn({runs[i] for i in unknown})
            for i in unknown:
                ids[i] = self.runs[runs[i]]
        ends = list(accumulate(map(len, split), initial=0))
        return [b"".join(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]


@lru_cache(maxsize=2)
def encoder_of(source: str, remembered: int = REMEMBERED) -> Encoder:
    """The encoder that this process keeps for a vocabulary, given as the file's text."""
    return Encoder(Vocabulary(source), remembered)


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def _with_column(docs: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField(name, kind)])


def _mapped(
    docs: DataFrame, source: str, used: str, name: str, kind: pa.DataType, work: Callable
) -> DataFrame:
    """``docs`` with a column that ``work(vocabulary text, used column)`` makes."""
    kept = docs.drop(name)
    place = kept.columns.index(used)
    shared = docs.sparkSession.sparkContext.broadcast(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words.slices(batch, used):
                values = pa.array(work(shared.value, part.column(place)), kind)
                yield from part.append_column(name, values).combine_chunks().to_batches()
        encoder_of(shared.value).release()

    spark_kind = T.BinaryType() if kind == pa.binary() else T.StringType()
    return kept.mapInArrow(run, _with_column(kept, name, spark_kind))


def _encode(source: str, texts: pa.ChunkedArray) -> list[bytes]:
    return encoder_of(source).encode([t or "" for t in texts.to_pylist()])


def _decode(source: str, ids: pa.ChunkedArray) -> list[str | None]:
    look = encoder_of(source).vocabulary.tokens.__getitem__
    return [
        None if data is None else " ".join(map(look, np.frombuffer(data, "<u4").tolist()))
        for data in ids.to_pylist()
    ]


def encode(
    docs: DataFrame, tokenizer_path: str, text_col: str = "text", ids_col: str = "token_ids"
) -> DataFrame:
    """``docs`` with the ids of each whole text as little-endian unsigned 32-bit integers."""
    source = read_vocabulary(tokenizer_path)
    return _mapped(docs, source, text_col, ids_col, pa.binary(), _encode)


def decode(
    docs: DataFrame, tokenizer_path: str, ids_col: str = "token_ids", text_col: str = "decoded"
) -> DataFrame:
    """``docs`` with the text of each row's ids: the tokens joined by spaces, as the file,
    which names no decoder, has it. Special tokens are kept."""
    source = read_vocabulary(tokenizer_path)
    return _mapped(docs, source, ids_col, text_col, pa.string(), _decode)
