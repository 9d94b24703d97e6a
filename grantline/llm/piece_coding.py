"""SentencePiece encoding and decoding that keeps the source of every piece.

Method: longest-prefix normalisation. At each place of the text the longest entry of the
model's compiled character map is replaced, or one character is kept; every byte that comes
out remembers the source byte at which its entry began. The normalised text is merged by the
model's scores, best pair first, leftmost among equals. Piece ends are looked up in the
alignment, which gives each piece its byte span in the source. Where the map is empty and
only spaces are escaped, each space mark stands for one byte, and the sizes of the pieces give
the alignment of many texts at once.

A text is cut into units where no piece reaches across, and units are merged on their own; a
worker remembers a bounded number of units. If a piece has a space mark behind another
character, texts are merged whole.

Models: BPE with byte fallback, without user-defined or unused pieces; others are refused.

Defined results: a null text encodes as an empty one, which has no ids. Null ids decode to
null, empty ones to an empty text, ids outside the vocabulary and null entries as the unknown
piece. Of the byte pieces of one character the last one spans it, the others are empty spans
at its begin. Other columns are passed through; input columns named like the results give way.
"""

from __future__ import annotations

import heapq
import re
import struct
from array import array
from collections.abc import Callable, Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Units that a worker remembers before it starts afresh; about 300 bytes each.
REMEMBERED = 250_000
#: Units of more symbols are merged with a heap.
SHORT = 48
RESULTS = ("token_ids", "starts", "ends")

# The space mark, and the field numbers and kinds of a model file.
MARK = "▁"
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_KIND = 1, 2, 3
MODEL_KIND, SUFFIX_MARK, BYTE_FALLBACK, UNKNOWN_SURFACE = 3, 24, 35, 44
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2

#: Units merged together, and bytes of text or ids worked on together, about.
_TOGETHER = 16_384
_SLICE = 1 << 20
_NO_RANK = 1 << 60
_INTS = pa.list_(pa.int32())


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of the fields of one message."""
    at, size = 0, len(data)

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < size:
        key = number()
        kind = key & 7
        if kind == 0:
            value: int | bytes = number()
        else:
            length = number() if kind == 2 else {1: 8, 5: 4}[kind]
            value = data[at : at + length]
            at += length
        yield key >> 3, value


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 and the texts that replace."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << (8 if unit & 512 else 0)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest entry that starts at a byte."""
        if not self.units:
            return None
        node = self._offset(self.units[0])
        found = None
        for place in range(at, len(data)):
            node ^= data[place]
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != data[place]:
                break
            node ^= self._offset(unit)
            if unit & 256:
                found = place + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        length, start = found
        return length, self.texts[start : self.texts.index(b"\0", start)]


def _unit_pattern(pieces: list[str]) -> str:
    """A pattern that cuts texts only where no piece reaches across.

    Two characters that are never next to each other in a piece can't be merged. Characters
    are grouped by their neighbours in pieces; a unit holds space marks and then characters of
    one group, and a character that no piece joins to another is a unit of its own.
    """
    if any(MARK in p.lstrip(MARK) for p in pieces):
        return r"[\s\S]+"
    group: dict[str, str] = {}

    def root(char: str) -> str:
        while group.setdefault(char, char) != char:
            group[char] = char = group[group[char]]
        return char

    for piece in pieces:
        chars = piece.lstrip(MARK)
        for a, b in zip(chars, chars[:1] + chars):
            group[root(a)] = root(b)
    members: dict[str, list[str]] = {}
    for char in sorted(group):
        members.setdefault(root(char), []).append(char)
    large = sorted((m for m in members.values() if len(m) > 1), key=len, reverse=True)
    doubled = {p[i] for p in pieces for i in range(len(p) - 1) if p[i] == p[i + 1]}
    single = [m[0] for m in members.values() if len(m) == 1]
    repeated = [c for c in single if c in doubled]
    alone = [c for c in single if c not in doubled]
    parts = [f"[{re.escape(''.join(m))}]+" for m in large]
    parts += [f"{re.escape(c)}+" for c in repeated]
    parts += [f"[{re.escape(''.join(alone))}]"] if alone else []
    return (f"{MARK}*(?:{'|'.join(parts)})|" if parts else "") + rf"{MARK}+|[\s\S]"


class Model:
    """Pieces and settings of a model file, and the units remembered so far."""

    def __init__(self, source: bytes, remembered: int = REMEMBERED):
        top = list(_fields(source))
        trainer, normalizer = (
            dict(_fields(next((v for k, v in top if k == part), b""))) for part in (TRAINER, NORMALIZER)
        )
        pieces = [dict(_fields(v)) for k, v in top if k == PIECES]
        self.texts = [p.get(PIECE_TEXT, b"").decode() for p in pieces]
        self.kinds = [p.get(PIECE_KIND, NORMAL) for p in pieces]
        if (
            trainer.get(MODEL_KIND, 1) != BPE
            or not trainer.get(BYTE_FALLBACK)
            or trainer.get(SUFFIX_MARK)
            or set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}
        ):
            raise ValueError("only BPE models with byte fallback and plain pieces are supported")
        scores = [struct.unpack("<f", p[PIECE_SCORE])[0] if PIECE_SCORE in p else 0.0 for p in pieces]
        normal = [i for i, kind in enumerate(self.kinds) if kind == NORMAL]
        self.numbers = {self.texts[i]: i for i in normal}
        ranks = {s: r for r, s in enumerate(sorted({scores[i] for i in normal}, reverse=True))}
        self.ranks = {self.texts[i]: ranks[scores[i]] for i in normal}
        self.marks = np.array([t.count(MARK) for t in self.texts])
        self.lengths = np.array([len(t.encode()) for t in self.texts])
        self.bytes = {int(self.texts[i][1:-1], 16): i for i, k in enumerate(self.kinds) if k == BYTE}
        self.unknown = self.kinds.index(UNKNOWN)
        self.map = CharacterMap(normalizer.get(CHARACTER_MAP, b""))
        self.dummy = bool(normalizer.get(DUMMY_PREFIX, 1))
        self.remove = bool(normalizer.get(REMOVE_SPACES, 1))
        self.space = MARK if normalizer.get(ESCAPE_SPACES, 1) else " "
        self.unit = re.compile(_unit_pattern(list(self.numbers)))
        surface = trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode())
        self.surfaces = [
            bytes([int(t[1:-1], 16)]) if k == BYTE
            else surface if k == UNKNOWN
            else b"" if k == CONTROL
            else t.replace(MARK, " ").encode()
            for t, k in zip(self.texts, self.kinds)
        ]
        self.has_text = np.isin(self.kinds, (NORMAL, BYTE))
        self.remembered = remembered
        self.units: dict[str, bytes] = {}

    @cached_property
    def of_point(self) -> np.ndarray:
        """The symbol of each character: its piece, or a number past the pieces."""
        symbols = np.arange(0x110000, dtype=np.int32) + len(self.texts)
        for text, number in self.numbers.items():
            if len(text) == 1:
                symbols[ord(text)] = number
        return symbols

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every pair of symbols that makes a piece, sorted, with its rank and what it makes."""
        count = len(self.texts)

        def number(symbol: str) -> int | None:
            plain = count + ord(symbol) if len(symbol) == 1 else None
            return self.numbers.get(symbol, plain)

        table = array("q")
        for text, made in self.numbers.items():
            for cut in range(1, len(text)):
                left, right = number(text[:cut]), number(text[cut:])
                if left is not None and right is not None:
                    table.extend(((left << 32) | right, self.ranks[text], made))
        table.extend((np.iinfo(np.int64).max, _NO_RANK, 0))
        rows = np.frombuffer(table, np.int64).reshape(-1, 3)
        keys, ranks, makes = rows[np.argsort(rows[:, 0])].T.copy()
        return keys, ranks, makes

    @property
    def plain(self) -> bool:
        """Normalising only escapes spaces and puts one in front."""
        return not self.map.units and not self.remove

    def normalised(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the source byte."""
        data = text.encode()
        space = self.space.encode()
        out, source = bytearray(), []
        parts = []
        at = 0
        while at < len(data):
            found = self.map.longest(data, at)
            if found is None:
                length = 1
                while at + length < len(data) and data[at + length] & 0xC0 == 0x80:
                    length += 1
                found = length, data[at : at + length]
            parts.append((at, found[1]))
            at += found[0]
        if self.remove:
            while parts and parts[0][1] == b" ":
                parts.pop(0)
        if not parts:
            return "", np.zeros(1, np.int64)
        if self.dummy:
            out += space
            source += [parts[0][0]] * len(space)
        after_space = self.remove
        for place, part in parts:
            if self.remove and after_space:
                part = part.lstrip(b" ")
            if part:
                escaped = part.replace(b" ", space)
                out += escaped
                source += [place] * len(escaped)
                after_space = part.endswith(b" ")
        end = len(data)
        if self.remove:
            while out.endswith(space):
                del out[-len(space) :]
                end = source[len(out)]
                del source[len(out) :]
        return out.decode(), np.array([*source, end], np.int64)

    def _symbols(self, text: str) -> np.ndarray:
        return self.of_point[np.frombuffer(text.encode("utf-32-le"), "<u4")]

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs in the table; the last place stands for pairs that don't merge."""
        keys = self.pairs[0]
        wanted = (left << 32) | right
        place = np.searchsorted(keys, wanted)
        return np.where(keys[place] == wanted, place, len(keys) - 1)

    def _merged_together(
        self, units: list[str], width: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Numbers of units for which nothing more merges, how many symbols each has, and all
        those symbols; at most ``width`` characters each.

        One merge of every unit at a time: the best pair of each row, the leftmost of equals.
        """
        sizes = np.array([len(u) for u in units])
        symbols = np.full((len(units), width + 1), -1, np.int64)
        symbols[np.arange(width + 1) < sizes[:, None]] = self._symbols("".join(units))
        pairs = self._pairs(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(units))
        while len(rows):
            ranks = self.pairs[1][pairs]
            at = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            open_ = ranks[every, at] < _NO_RANK
            left = symbols[~open_]
            yield rows[~open_], sizes[~open_], left[left >= 0]
            rows, symbols, pairs, at, sizes = (
                x[open_] for x in (rows, symbols, pairs, at, sizes)
            )
            every = np.arange(len(rows))
            made = self.pairs[2][pairs[every, at]]
            columns = np.arange(width)
            symbols[:, :-1] = np.take_along_axis(
                symbols, columns + (columns > at[:, None]), axis=1
            )
            symbols[every, at] = made
            symbols[:, -1] = -1
            pairs[:, :-1] = np.take_along_axis(
                pairs, columns[:-1] + (columns[:-1] >= at[:, None]), axis=1
            )
            pairs[:, -1] = len(self.pairs[0]) - 1
            pairs[every, at] = self._pairs(made, symbols[every, at + 1])
            inner = np.flatnonzero(at)
            ahead = at[inner] - 1
            pairs[inner, ahead] = self._pairs(symbols[inner, ahead], made[inner])
            sizes = sizes - 1

    def _merged_long(self, symbols: list[str]) -> list[str]:
        """Symbols once nothing merges, by a heap of pairs; a pair is stale once its text has changed."""
        count = len(symbols)
        after, before = list(range(1, count + 1)), list(range(-1, count - 1))
        rank = self.ranks.get
        heap = []

        def offer(left: int) -> None:
            right = after[left]
            if right < count:
                value = rank(symbols[left] + symbols[right])
                if value is not None:
                    heapq.heappush(heap, (value, left, len(symbols[left]), len(symbols[right])))

        for left in range(count - 1):
            offer(left)
        while heap:
            _, left, first, second = heapq.heappop(heap)
            right = after[left]
            if len(symbols[left]) != first or right >= count or len(symbols[right]) != second:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[left] < count:
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [s for s in symbols if s]

    def release(self) -> None:
        """Give the memory back: workers live on, and other stages run in them."""
        self.units.clear()

    def _packed(self, symbols: list[int]) -> bytes:
        """Pairs of id and normalised byte length of symbols, as 32-bit integers."""
        found: list[int] = []
        for symbol in symbols:
            if symbol < len(self.texts):
                found += (symbol, self.lengths[symbol].item())
            else:
                data = chr(symbol - len(self.texts)).encode()
                for byte in data[:-1]:
                    found += (self.bytes[byte], 0)
                found += (self.bytes[data[-1]], len(data))
        return struct.pack(f"<{len(found)}i", *found)

    def _learn(self, units: list[str]) -> None:
        classes: dict[int, list[str]] = {}
        for unit in units:
            if len(unit) > SHORT:
                merged = self._merged_long(list(unit))
                numbers = [
                    self.numbers[s] if s in self.numbers else len(self.texts) + ord(s)
                    for s in merged
                ]
                self.units[unit] = self._packed(numbers)
            else:
                classes.setdefault(-(-len(unit) // 6) * 6, []).append(unit)
        for width, members in classes.items():
            for rows, sizes, symbols in self._merged_together(members, width):
                bounds = np.concatenate([[0], np.cumsum(sizes)])
                odd = symbols >= len(self.texts)
                lengths = self.lengths[np.where(odd, 0, symbols)]
                coded = np.stack([symbols, lengths], axis=1).astype("<i4").tobytes()
                cuts = (8 * bounds).tolist()
                parts = [coded[a:b] for a, b in zip(cuts, cuts[1:])]
                for i in np.unique(np.searchsorted(bounds, np.flatnonzero(odd), "right") - 1):
                    parts[i] = self._packed(symbols[bounds[i] : bounds[i + 1]].tolist())
                self.units.update(zip([members[i] for i in rows.tolist()], parts))

    def coded(self, normal: list[str]) -> list[bytes]:
        """Pairs of id and byte length of the pieces of each normalised text."""
        split = [self.unit.findall(n) for n in normal]
        fresh = list(set(chain.from_iterable(split)).difference(self.units))
        for at in range(0, len(fresh), _TOGETHER):
            self._learn(fresh[at : at + _TOGETHER])
        look = self.units.__getitem__
        return [b"".join(map(look, units)) for units in split]

    def tidy(self) -> None:
        if len(self.units) > self.remembered:
            self.units.clear()

    def decode(self, ids: list[int | None]) -> str:
        count = len(self.texts)
        known = [i if i is not None and 0 <= i < count else self.unknown for i in ids]
        parts = [self.surfaces[i] for i in known]
        if self.dummy or self.remove:
            for at, number in enumerate(known):
                if self.kinds[number] == CONTROL:
                    continue
                if self.kinds[number] == NORMAL and parts[at].startswith(b" "):
                    parts[at] = parts[at][1:]
                    if self.remove and not parts[at]:
                        continue
                break
        return self._repaired(known, parts)

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """Texts of runs of ids; plain ones all at once."""
        inside = (ids >= 0) & (ids < len(self.texts))
        plain = inside & self.has_text[np.where(inside, ids, 0)]
        odd = np.concatenate([[0], np.cumsum(~plain)])
        odd = (odd[bounds[1:]] > odd[bounds[:-1]]).tolist()
        look = self.surfaces.__getitem__
        cuts = bounds.tolist()
        strip = self.dummy and not self.remove
        found = []
        for strange, a, b in zip(odd, cuts, cuts[1:]):
            numbers = ids[a:b].tolist()
            if strange or self.remove:
                found.append(self.decode(numbers))
                continue
            data = b"".join(map(look, numbers))
            if strip and numbers and self.texts[numbers[0]].startswith(MARK):
                data = data[1:]
            try:
                found.append(data.decode())
            except UnicodeDecodeError:
                found.append(self.decode(numbers))
        return found

    def _repaired(self, known: list[int], parts: list[bytes]) -> str:
        """Bytes between other pieces that are no character become a replacement character each."""
        out, run = [], b""
        for number, part in [*zip(known, parts), (None, b"")]:
            if number is not None and self.kinds[number] == BYTE:
                run += part
                continue
            while run:
                width = next((n for n in (1, 2, 3, 4) if _is_character(run[:n])), 0)
                out.append(run[:width].decode() if width else "�")
                run = run[max(1, width) :]
            out.append(part.decode())
        return "".join(out)


def _is_character(data: bytes) -> bool:
    try:
        return len(data.decode()) == 1
    except UnicodeDecodeError:
        return False


@lru_cache(maxsize=2)
def model_of(source: bytes) -> Model:
    """The model that this process keeps for a file's bytes."""
    return Model(source)


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _spans(model: Model, text: str, ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Starts and ends in the source from those in the normalised text."""
    aligned = model.normalised(text)[1]
    begin = aligned[starts]
    return np.stack([begin, np.maximum(aligned[ends], begin)])


def encoded(model: Model, texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each text its number of pieces; then ids, starts and ends of all pieces."""
    model.tidy()
    front = model.space if model.dummy else ""
    # Where only spaces change, and each space mark stands for one, sizes alone give the source.
    simple = [model.plain and MARK not in t for t in texts]
    normal = [
        (t and front + t.replace(" ", model.space)) if easy else model.normalised(t)[0]
        for t, easy in zip(texts, simple)
    ]
    coded = model.coded(normal)
    counts = np.array([len(c) // 8 for c in coded], np.int64)
    both = np.frombuffer(b"".join(coded), "<i4").reshape(-1, 2)
    ids, sizes = both[:, 0], both[:, 1].astype(np.int64)
    source = sizes - (len(model.space.encode()) - 1) * model.marks[ids]
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = np.concatenate([[0], np.cumsum(source)])
    ends = total[1:] - np.repeat(total[bounds[:-1]], counts) - len(front)
    starts = np.maximum(ends - source, 0)
    for i in np.flatnonzero(~np.array(simple, bool)):
        own = slice(bounds[i], bounds[i + 1])
        last = np.cumsum(sizes[own])
        starts[own], ends[own] = _spans(model, texts[i], last, last - sizes[own])
    return counts, [x.astype(np.int32) for x in (ids, starts, ends)]


def _slices(table: pa.Table, column: str) -> Iterator[pa.Table]:
    """Runs of rows with about ``_SLICE`` bytes of text or ids, one row at least."""
    values = table[column]
    length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
    sizes = pc.fill_null(length(values), 0).to_numpy().astype(np.int64)
    filled, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        done = filled[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(filled, done + _SLICE, side="right")))
        yield table.slice(begin, end - begin)
        begin = end


def _mapped(
    docs: DataFrame,
    used: str,
    results: dict[str, tuple[T.DataType, pa.DataType]],
    work: Callable[[pa.ChunkedArray], list[pa.Array]],
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """``docs`` with the columns that ``work`` makes of one column, slice by slice."""
    kept = docs.drop(*results)
    place = kept.columns.index(used)
    fields = [T.StructField(name, kind) for name, (kind, _) in results.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(pa.Table.from_batches([batch]), used):
                made = work(part.column(place))
                for (name, (_, kind)), values in zip(results.items(), made):
                    part = part.append_column(pa.field(name, kind), values)
                yield from part.combine_chunks().to_batches()
        if done:
            done()

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def encode(docs: DataFrame, model_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``token_ids`` and, in bytes of the source text, ``starts`` and ``ends``."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def work(texts: pa.ChunkedArray) -> list[pa.Array]:
        plain = [t or "" for t in texts.to_pylist()]
        counts, parts = encoded(model_of(shared.value), plain)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        return [pa.ListArray.from_arrays(offsets, pa.array(p, pa.int32())) for p in parts]

    kinds = {name: (T.ArrayType(T.IntegerType()), _INTS) for name in RESULTS}
    return _mapped(docs, text_col, kinds, work, lambda: model_of(shared.value).release())


def decode(
    docs: DataFrame, model_path: str, ids_col: str = "token_ids", text_col: str = "decoded"
) -> DataFrame:
    """``docs`` with the text of each row's ids."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model_path))

    def work(ids: pa.ChunkedArray) -> list[pa.Array]:
        model = model_of(shared.value)
        lists = ids.combine_chunks()
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
        flat = pc.fill_null(lists.flatten(), -1).to_numpy()
        found = model.decoded(flat, np.concatenate([[0], np.cumsum(sizes)]))
        known = lists.is_valid().to_pylist()
        found = [text if valid else None for text, valid in zip(found, known)]
        return [pa.array(found, pa.string())]

    kinds = {text_col: (T.StringType(), pa.string())}
    return _mapped(docs, ids_col, kinds, work)
