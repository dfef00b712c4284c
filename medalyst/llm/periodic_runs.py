"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q (words q apart are equal) and at least ``max(24, 3 q)`` words that no neighbouring word extends. For a period in
[B, 2B), B a power of two, every such run holds a whole block of B words from the grid of multiples of B together with that block's copy q words later; a block
of 8 words serves all periods below 16. The occurrences of a block are an interval of the suffix order, and a wavelet tree over that order answers which of them comes next
after a place (range successor). Those in a window of B places next to the block number two at most or form an arithmetic progression whose
difference is the block's own period; then the ends of the two stretches with that period, around the block and around the progression, give the only
possible periods. A candidate is extended to both sides by equal prefixes and suffixes, and kept if it is long enough. The result is exact.

Every run lies inside a stretch of words whose 8-word windows all occur again in the same text, so only those stretches are indexed.

Defined cases: NULL text counts as empty and has no words; a NULL id has no number, so its words stay as they are; equal ids and repeated rows are
rows like any others; an empty table gives an empty result; other columns are ignored, whatever their names. Texts are read whole: memory follows the longest
one, for its indexed stretches about 20 bytes a word and doubling round.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import map_batches, slices
from medalyst.llm.shingles import mixed
from medalyst.llm.suffixes import Suffixes, word_numbers

LEAST, TIMES = 24, 3           # words of the shortest run, and how often its period must fit
BASE = 8                       # words of the smallest blocks
SLICE = 2 << 20
_ODD = 0x9E3779B97F4A7C15
RESULT = ("doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
          "collapsed_sha256 string")


class WaveletTree:
    """Smallest value from a bound on, in any range of an array of distinct numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros, self.split = [], []
        for bit in range(self.bits - 1, -1, -1):
            high = (values >> bit) & 1
            self.zeros.append(np.concatenate([[0], np.cumsum(1 - high, dtype=np.int32)]).astype(np.int32))
            self.split.append(int(self.zeros[-1][-1]))
            values = np.concatenate([values[high == 0], values[high == 1]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of each range [low, high) are smaller than its bound."""
        count = np.where(bound >> self.bits > 0, high - low, 0)        # all of them; what is added below changes nothing
        for level, (zeros, split) in enumerate(zip(self.zeros, self.split, strict=True)):
            one = (bound >> (self.bits - 1 - level)) & 1
            a, b = zeros[low], zeros[high]
            count = count + one * (b - a)
            low, high = np.where(one, split + low - a, a), np.where(one, split + high - b, b)
        return count

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value (from 0) of each range."""
        value = np.zeros(len(low), np.int64)
        for zeros, split in zip(self.zeros, self.split, strict=True):
            a, b = zeros[low], zeros[high]
            one = k >= b - a
            k = np.where(one, k - (b - a), k)
            value = 2 * value + one
            low, high = np.where(one, split + low - a, a), np.where(one, split + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest value of each range that is at least its bound, or a number beyond all values."""
        k = self.below(low, high, bound)
        out = np.full(len(low), 1 << (self.bits + 1), np.int64)
        some = np.flatnonzero(k < high - low)
        out[some] = self.smallest(low[some], high[some], k[some])
        return out


def candidates(suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): among them is every period that a long enough run can have, at a place inside that run."""
    tree = WaveletTree(suffixes.order)
    places, periods = [], []

    def add(place: np.ndarray, period: np.ndarray) -> None:
        places.append(place)
        periods.append(period)

    for level in range(BASE.bit_length() - 1, len(suffixes.ranks)):
        size = 1 << level
        rank = suffixes.ranks[level]
        many = np.bincount(rank[:-1], minlength=suffixes.n)
        at = np.arange(0, suffixes.n, size)
        at = at[many[rank[at]] > 1]
        low = rank[at].astype(np.int64)
        high = low + many[low]

        def following(some: np.ndarray, bound: np.ndarray, end: np.ndarray, low=low, high=high) -> tuple[np.ndarray, np.ndarray]:
            """The blocks among ``some`` that occur from ``bound`` to before ``end``, and where first."""
            found = tree.successor(low[some], high[some], bound)
            inside = found < end
            return some[inside], found[inside]

        every = np.arange(len(at))
        if size == BASE:
            some, first = following(every, at + 1, at + BASE + 1)
            add(at[some], first - at[some])
        one, first = following(every, at + size, at + 2 * size)
        add(at[one], first - at[one])
        seen = np.zeros(len(at), np.int64)
        seen[one] = first
        two, second = following(one, first + 1, at[one] + 2 * size)
        add(at[two], second - at[two])
        third, _ = following(two, second + 1, at[two] + 2 * size)
        if len(third):
            step = np.zeros(len(at), np.int64)
            step[two] = second - seen[two]
            here, there, step = at[third], seen[third], step[third]
            ends = [place + step + suffixes.shared_ahead(place, place + step) for place in (here, there)]
            starts = [place - suffixes.shared_behind(place, place + step) for place in (here, there)]
            add(here, ends[1] - ends[0])
            add(here, starts[1] - starts[0])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    place, period = np.concatenate(places), np.concatenate(periods)
    fits = (period > 0) & (place + period < suffixes.n)
    return place[fits], period[fits]


def indexed_runs(ids: np.ndarray, owner: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (start, length, period) of all runs in the stretches of words ``ids``, by start and period."""
    suffixes = Suffixes(ids, owner)
    place, period = candidates(suffixes)
    start = place - suffixes.shared_behind(place, place + period)
    end = place + period + suffixes.shared_ahead(place, place + period)
    runs = np.stack([start, end - start, period], axis=1)[end - start >= np.maximum(least, times * period)]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # one stretch with several periods has the smallest of them as its own; the others are its multiples
    fresh = np.ones(len(runs), bool)
    fresh[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[fresh]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def stretches(ids: np.ndarray, owner: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of the longest stretches, of ``least`` words or more, in which each window of ``BASE`` words occurs again in its text."""
    n = len(ids) - BASE + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    word = mixed(ids.astype(np.uint64) + np.uint64(1))
    window = mixed(owner[:n].astype(np.uint64))
    for i in range(BASE):
        window += word[i:i + n] * np.uint64(pow(_ODD, i + 1, 1 << 64))
    ordered = np.sort(window)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    slot = np.minimum(np.searchsorted(twice, window), len(twice) - 1)
    again = (twice[slot] == window) & (owner[:n] == owner[BASE - 1:])        # hashes can only add stretches, never lose one
    edges = np.diff(np.concatenate([[0], again.astype(np.int8), [0]]))
    first, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)     # windows that cross two texts part the stretches
    long = end - first + BASE - 1 >= least
    return first[long], end[long] + BASE - 1


def runs_of(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text (a list of words): rows (start, length, period) by start and period."""
    ids, counts = word_numbers(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    first, end = stretches(ids, owner)
    if not len(first):
        return [np.empty((0, 3), np.int64)] * len(texts)
    sizes = end - first
    offset = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    where = np.repeat(first - offset, sizes) + np.arange(sizes.sum())
    part = np.repeat(np.arange(len(first)), sizes)
    runs = indexed_runs(ids[where], part)
    begins = np.concatenate([[0], np.cumsum(counts)])
    text = owner[where[runs[:, 0]]]
    runs[:, 0] = where[runs[:, 0]] - begins[text]
    edges = np.searchsorted(text, np.arange(len(texts) + 1))
    return [runs[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document, for a tenth of the ids with a tail that repeats (the report's stated input)."""
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def strongest(runs: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the greatest length by period; ties: smallest start, then period."""
    best = None
    for start, length, period in runs.tolist():                      # already by start and period
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without what any run holds after its first period."""
    if not len(runs):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)]


def report(docs: DataFrame, change: Callable[[int | None, list[bytes]], list[bytes]] | None = None, doc_id: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row for each document: its runs counted and hashed, the strongest of them, and the hash of the text without repetition.

    ``change`` alters the words of a document before they are searched.
    """
    def rows(part: pa.RecordBatch) -> Iterator[tuple]:
        ids = part.column("doc_id").to_pylist()
        words = [(body or "").encode().split() for body in part.column("text").to_pylist()]
        if change:
            words = [change(i, w) for i, w in zip(ids, words, strict=True)]
        for i, w, runs in zip(ids, words, runs_of(words), strict=True):
            best = strongest(runs)
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
            yield (i, len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2], hashlib.sha256(listed.encode()).hexdigest(),
                   hashlib.sha256(b" ".join(collapsed(w, runs))).hexdigest())

    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    names = [field.split()[0] for field in RESULT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                columns = zip(*rows(part), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    return map_batches(docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")), run, RESULT)
