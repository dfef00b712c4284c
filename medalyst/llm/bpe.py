"""Byte-level BPE by length-bucketed numpy matrices.

A text is cut into units at spaces where the split pattern always cuts; distinct units are split by the pattern and their pieces
encoded together: pieces of like length form one padded matrix, and in each round every row merges its leftmost pair of
minimum rank. Pairs are looked up in an open-addressing hash table held in arrays; rows that have no pair left leave the matrix.

Defined cases: NULL text is empty and gives no ids; repeated rows give repeated results; an empty table gives an empty result; input columns
other than id and text are ignored, whatever their names. A piece beyond ``MATRIX_WIDTH`` bytes merges by the same rule through a heap,
so a long run of letters costs no quadratic matrix.
"""

from __future__ import annotations

import base64
import gc
import heapq
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import with_outputs

MATRIX_WIDTH = 256
CACHED_BYTES = 64 << 20
NO_PAIR = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_CUT = re.compile(r"(?<=\S)(?= )|(?= \S)")
_RUN = re.compile(r"\s (?:\s|\Z)")
_SPACES = np.array([chr(i).isspace() for i in range(0x3002)])       # none beyond
LETTER, NUMBER, OTHER, SPACE, BEYOND = range(5)     # classes of characters
BLANK = ord(" ")


def units(text: str) -> list[str]:
    """Pieces of ``text`` that the split pattern never joins. All but the first start with a space.

    The pattern starts a match before a space that follows a visible character or precedes one, so a cut there changes nothing.
    """
    if _RUN.search(text):
        return _CUT.split(text)
    head, *rest = text.split(" ")
    return [head, *[" " + part for part in rest]]


class PairTable:
    """(left id, right id) -> rank of the merged token; linear probing over a table at most a quarter full."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        size = 1 << max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - (size.bit_length() - 1)), size - 1
        self.keys = np.full(size, _EMPTY)
        self.ranks = np.full(size, NO_PAIR)
        keys = np.array([(a << 32) | b for a, b in pairs], dtype=np.uint64)
        ranks = np.array(list(pairs.values()), dtype=np.int32)
        at = self._home(keys)
        while len(keys):
            free = self.keys[at] == _EMPTY
            _, first = np.unique(at, return_index=True)
            take = np.zeros(len(keys), dtype=bool)
            take[first] = free[first]
            self.keys[at[take]], self.ranks[at[take]] = keys[take], ranks[take]
            keys, ranks, at = keys[~take], ranks[~take], (at[~take] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MIX) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; ``NO_PAIR`` where there is none or an id is negative."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.size, NO_PAIR)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[todo].astype(np.uint64) << np.uint64(32)) | right[todo].astype(np.uint64)
        at = self._home(keys)
        while len(todo):
            there = self.keys[at]
            hit = there == keys
            out[todo[hit]] = self.ranks[at[hit]]
            on = ~hit & (there != _EMPTY)
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & self.mask
        return out.reshape(shape)


class ByteBpe:
    """A rank vocabulary: bytes -> id, where a merge's rank is the id of what it makes."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.pairs = PairTable({(ranks[t[:i]], ranks[t[i:]]): rank for t, rank in ranks.items()
                                for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks})
        self.known = {token: np.array([rank], "<u4").tobytes() for token, rank in ranks.items()}
        self.cache = UnitCache()

    @classmethod
    def load(cls, path: str, pattern: str) -> ByteBpe:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}, pattern)

    def _heap(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: lowest rank first, leftmost on ties."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        after = list(range(1, len(ids))) + [-1]
        before = list(range(-1, len(ids) - 1))
        first = self.pairs(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(rank, i, ids[i], ids[i + 1]) for i, rank in enumerate(first) if rank != NO_PAIR]
        heapq.heapify(heap)

        def push(i: int) -> None:
            if i >= 0 and after[i] >= 0:
                rank = self.ranks.get(self.tokens[ids[i]] + self.tokens[ids[after[i]]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[after[i]]))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            push(i)
            push(before[i])
        return [i for i in ids if i >= 0]

    def _matrix(self, pieces: list[bytes], width: int) -> Iterator[tuple[list[int], list[bytes]]]:
        """(rows, their ids) of pieces of at most ``width`` bytes, as rows get done. Each round every row is one id shorter."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ids = np.full((len(pieces), width), -1, dtype=np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        ranks = np.full((len(pieces), width), NO_PAIR)
        ranks[:, :-1] = self.pairs(ids[:, :-1], ids[:, 1:])
        rows = np.arange(len(pieces))
        while len(rows):
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), at]
            done = low == NO_PAIR
            if done.any():
                yield rows[done].tolist(), _cut_rows(ids[done])
                keep = ~done
                rows, ids, ranks, at, low = rows[keep], ids[keep], ranks[keep], at[keep], low[keep]
            here = np.arange(len(rows))
            ids[here, at] = low
            later = np.arange(ids.shape[1] - 1) > at[:, None]
            ids = np.where(later, ids[:, 1:], ids[:, :-1])
            ranks = np.where(later, ranks[:, 1:], ranks[:, :-1])
            inner = np.flatnonzero(at + 1 < ids.shape[1])
            ranks[here, np.minimum(at, ids.shape[1] - 1)] = NO_PAIR
            ranks[inner, at[inner]] = self.pairs(low[inner], ids[inner, at[inner] + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self.pairs(ids[left, at[left] - 1], low[left])

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece; a piece that is a token is that token."""
        get, out = self.known.get, []
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            known = get(piece)
            out.append(known)
            if known is None:
                n = len(piece)
                buckets.setdefault((n + 1) & -2 if n <= 24 else 1 << (n - 1).bit_length(), []).append(i)
        for width, members in buckets.items():
            if width > MATRIX_WIDTH:
                for i in members:
                    out[i] = np.array(self._heap(pieces[i]), "<u4").tobytes()
                continue
            step = max(1, 2**19 // width)
            for start in range(0, len(members), step):
                block = members[start:start + step]
                for rows, made in self._matrix([pieces[i] for i in block], width):
                    for row, ids in zip(rows, made, strict=True):
                        out[block[row]] = ids
        return out

    def encode_units(self, wanted: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each unit."""
        findall = self.pattern.findall
        # a space and letters are one match of the pattern
        split = [(unit,) if unit[1:].isalpha() and unit[0] == " " else findall(unit) for unit in wanted]
        distinct = list({piece: None for pieces in split for piece in pieces})
        ids = dict(zip(distinct, self.encode_pieces([piece.encode() for piece in distinct]), strict=True))
        return [ids[pieces[0]] if len(pieces) == 1 else b"".join([ids[piece] for piece in pieces]) for pieces in split]

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return encode_cached(texts, self.cache, self.encode_units)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _cut_rows(ids: np.ndarray) -> list[bytes]:
    """The ids of each row, without its padding, as little-endian 32-bit integers."""
    real = ids >= 0
    flat = ids[real].astype("<u4").tobytes()
    ends = (4 * np.cumsum(real.sum(axis=1))).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class UnitCache:
    """Ids of units, in two generations of at most about ``limit`` bytes each: a full one takes the place of the older, whose units are gone unless they were asked for again."""

    def __init__(self, limit: int = CACHED_BYTES):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0

    def of(self, wanted: Iterable[str], encode_units: Callable[[list[str]], list[bytes]]) -> dict[str, bytes]:
        """A table that holds all ``wanted`` units; those in neither generation are encoded together."""
        if self.size > self.limit:
            self.young, self.old, self.size = {}, self.young, 0
        young, old = self.young, self.old
        fresh = [unit for unit in wanted if unit not in young]
        again = [unit for unit in fresh if unit in old]
        young.update(zip(again, map(old.__getitem__, again), strict=True))
        if again:
            fresh = [unit for unit in fresh if unit not in old]
        made = encode_units(fresh)
        young.update(zip(fresh, made, strict=True))
        # a string, a bytes object and their places in the table take about 250 bytes besides what they hold
        self.size += 250 * (len(again) + len(fresh)) + sum(map(len, fresh)) + sum(map(len, made))
        return young


def encode_cached(texts: Iterable[str], cache: UnitCache, encode_units: Callable[[list[str]], list[bytes]]) -> list[bytes]:
    """Encode texts unit by unit; units that ``cache`` does not hold are encoded together."""
    collecting = gc.isenabled()
    gc.disable()            # nothing here makes cycles, and collections would walk the cache again and again
    try:
        split = [units(text) for text in texts]
        known = cache.of(set().union(*split), encode_units).__getitem__
        return [b"".join(map(known, parts)) for parts in split]
    finally:
        if collecting:
            gc.enable()


class ColumnCache:
    """Ids of strings as two Arrow columns. When they pass about ``limit`` bytes, only the strings asked for last stay."""

    def __init__(self, limit: int = CACHED_BYTES):
        self.limit = limit
        self.strings, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def of(self, wanted: pa.Array, encode: Callable[[pa.Array], pa.Array]) -> pa.Array:
        """The ids of each of the distinct strings ``wanted``; those not held are encoded together."""
        at = pc.index_in(wanted, value_set=self.strings)
        new = at.is_null()
        fresh, held = wanted.filter(new), len(self.strings)
        at = at.fill_null(0).to_numpy().astype(np.int64)
        at[new.to_numpy(zero_copy_only=False)] = held + np.arange(len(fresh))
        self.strings, self.ids = pa.concat_arrays([self.strings, fresh]), pa.concat_arrays([self.ids, encode(fresh)])
        found = self.ids.take(pa.array(at))
        if self.strings.nbytes + self.ids.nbytes > self.limit:
            self.strings, self.ids = wanted, found
        return found


def laid_out(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow column of strings without NULLs, one value after another; where each begins, and the last one ends."""
    _, bounds, data = values.buffers()
    bounds = np.frombuffer(bounds, np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64) if len(values) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The characters of an Arrow column of strings without NULLs, one text after another; where each text begins, and the last one ends."""
    points = np.frombuffer(laid_out(texts)[0].tobytes().decode().encode("utf-32-le"), "<u4")
    return points, np.concatenate([[0], np.cumsum(pc.utf8_length(texts).to_numpy(), dtype=np.int64)])


def is_space(points: np.ndarray) -> np.ndarray:
    return _SPACES[np.minimum(points, len(_SPACES) - 1)]


def of_bytes(kind: pa.DataType, bounds: np.ndarray, data: np.ndarray | pa.Buffer) -> pa.Array:
    """The Arrow column of the parts of ``data`` between ``bounds``."""
    return pa.Array.from_buffers(kind, len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)])


def regrouped(ids: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The Arrow column whose values are those of ``ids`` between ``bounds``, joined."""
    data, edges = laid_out(ids)
    return of_bytes(pa.binary(), edges[bounds], data)


def piece_starts(points: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which characters begin a piece of the split pattern, in texts that lie between ``bounds``; ``kinds`` are the characters' classes.

    The pattern is ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?O+|S+(?!V)|S+`` for letters, numbers, others, white space and anything visible. A text that
    has a character ``BEYOND`` those told apart is left whole.
    """
    first = np.zeros(len(points) + 1, bool)
    first[bounds] = True
    space = kinds == SPACE
    after_space, before_visible = np.roll(space, 1), ~np.roll(space, -1) & ~first[1:]
    # the last of several white spaces stands alone, or goes with what follows if it is a blank
    start = first.copy()
    start[:-1] |= np.where(space, ~after_space | before_visible, np.where(after_space, np.roll(points, 1) != BLANK, np.roll(kinds, 1) != kinds))
    marks = np.flatnonzero(start[:-1] & (points == ord("'")))
    for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
        at = marks[marks + len(ending) < len(points)]
        for i, letter in enumerate(ending, 1):
            at = at[(points[at + i] == ord(letter)) & ~first[at + i]]
        start[at + 1] = False
        start[at + 1 + len(ending)] = True
    beyond = kinds == BEYOND
    if beyond.any():
        seen = np.concatenate([[0], np.cumsum(beyond)])[bounds]
        start[:-1] &= first[:-1] | ~np.repeat(np.diff(seen) > 0, np.diff(bounds))
    return start[:-1]


def encode_column(texts: pa.Array, cache: ColumnCache, encode_units: Callable[[pa.Array, ColumnCache], pa.Array], end: bytes = b"") -> pa.Array:
    """Ids of each text of an Arrow column without NULLs, ``end`` after each. Units are cut, told apart and put together by Arrow.

    A cut at every space is right but where spaces meet other white space; texts that have such a place go through ``units``.
    """
    if not len(texts):
        return pa.array([], pa.binary())
    cut = pc.split_pattern(texts.cast(pa.string()), " ")
    first = cut.offsets.to_numpy().astype(np.int64)
    first, parts = first[:-1] - first[0], cut.flatten()
    coded = parts.dictionary_encode()
    at, rest = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    points, bounds = code_points(rest)
    empty = np.diff(bounds) == 0
    odd = empty.copy()
    odd[~empty] = is_space(points[bounds[1:][~empty] - 1])
    odd = odd[at]
    odd[first] &= ~empty[at[first]]             # a text may begin with a space
    odd = np.logical_or.reduceat(odd, first)
    # a head has no space before it
    heads, which = np.unique(at[first], return_inverse=True)
    wanted = pa.concat_arrays([pc.binary_join_element_wise("", rest, " "), rest.take(pa.array(heads))])
    at[first] = len(rest) + which
    ids = [encode_units(wanted, cache), pa.array([b"", end], pa.binary())]
    if odd.any():
        split = [units(text) for text in texts.filter(pa.array(odd)).to_pylist()]
        edges = np.concatenate([[0], np.cumsum(list(map(len, split)))])
        at[np.repeat(odd, np.diff([*first.tolist(), len(at)]))] = len(wanted)
        at[first[odd]] = len(wanted) + 2 + np.arange(len(split))
        each = pa.array([unit for parts in split for unit in parts], pa.string()).dictionary_encode()
        ids.append(regrouped(encode_units(each.dictionary, cache).take(each.indices), edges))
    after = np.append(first[1:], len(at))
    joined = pa.concat_arrays(ids).take(pa.array(np.insert(at, after, len(wanted) + 1)))
    return regrouped(joined, np.append(0, after + np.arange(1, len(after) + 1)))


@lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> ByteBpe:
    return ByteBpe.load(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids``: the ids of each whole text as little-endian unsigned 32-bit integers."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return with_outputs(source, "text", "ids binary", lambda texts: [vocabulary(path, pattern).encode(texts)], drop=["text"],
                        size=1 << 21, done=lambda: vocabulary(path, pattern).cache.clear())


def decode(tokens: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids stand for."""
    source = tokens.select(F.col(doc_id).alias("doc_id"), F.col(ids).alias("ids"))

    def run(values: list[bytes]) -> list[list[bytes]]:
        return [list(map(vocabulary(path, pattern).decode, values))]

    return with_outputs(source, "ids", "decoded binary", run)
