"""Benchmark decontamination: rare n-gram seeds, then local alignment.

At each place of a test item the seed is the shortest run of ``SHORTEST`` to ``LONGEST`` words that the corpus would hold at most ``expected`` times if
its words fell independently; word frequencies are counted over the whole corpus. A seed found in a document points at the stretch where the item
would lie, and Smith-Waterman alignment of words scores that stretch, so edited and reordered copies keep most of their score. The similarity
is the best score over that of the item itself. A document holds an item from a similarity of ``least``, or from a score worth ``PASSAGE`` matching
words found by a rare seed, as that much of a long item is no chance however short a part of it it is.

The item words that one pass holds in memory are bounded by ``WORDS_AT_ONCE``; a larger benchmark is taken in parts, with one pass over the corpus for each.

Defined cases: NULL and empty texts match nothing; items of fewer than ``SHORTEST`` words match nothing, as they cannot be told from chance; equal
items each match; repeated rows give repeated matches; an empty table on either side gives an empty result; other columns are ignored,
whatever their names. Words are runs of letters and digits of any script, and single characters of scripts that put no spaces between words
(Chinese, Japanese, Thai, ...); an item's length is counted in these. A-Z count as a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import map_batches, slices, with_outputs
from medalyst.llm.shingles import PUNCTUATION, spaced, windows, word_hashes

SHORTEST, LONGEST = 3, 8
WORDS_AT_ONCE = 1_000_000
MATCH, MISMATCH, GAP = 2, -1, -1
PASSAGE = 13                     # matching words of an item that count as a leak, whatever share of it they are; twice as many characters
SLACK = 8                        # words that an alignment may shift to either side, besides a fifth of the item
_BITS = 22


class Lookup:
    """Positions of keys in a sorted array; a bit table answers most misses."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.zeros(1 << _BITS, bool)
        self.bits[self._at(keys)] = True

    @staticmethod
    def _at(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - _BITS)).astype(np.int64)

    def __call__(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``wanted``, place in ``keys``) of each one found."""
        maybe = np.flatnonzero(self.bits[self._at(wanted)]) if len(self.keys) else np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.keys, wanted[maybe]), max(0, len(self.keys) - 1))
        hit = self.keys[at] == wanted[maybe] if len(maybe) else np.empty(0, bool)
        return maybe[hit], at[hit]


@dataclass
class Items:
    """Test items as word hashes, and their seeds by length: sorted hashes with the range of (item, place) that each has.

    ``passages`` has the score from which a part of an item counts; an item without a rare seed has none.
    """

    ids: list
    words: list[np.ndarray]
    passages: list[float]
    seeds: dict[int, tuple[Lookup, np.ndarray, np.ndarray]]

    @classmethod
    def seeded(cls, ids: list, words: list[np.ndarray], passage: list[float], frequency: dict[int, float], total: float, expected: float) -> Items:
        found: dict[int, list[tuple[int, int, int]]] = {}
        passages = [float("inf")] * len(words)
        for number, line in enumerate(words):
            n = len(line)
            if n < SHORTEST:
                continue
            logs = np.log([frequency.get(int(w), 1.0) / max(1.0, total) for w in line]) if total else np.zeros(n)
            rare = [(place, size) for place in range(n - SHORTEST + 1)
                    for size in [next((s for s in range(SHORTEST, LONGEST + 1) if place + s <= n and
                                       np.log(max(1.0, total)) + logs[place:place + s].sum() <= np.log(expected)), None)] if size]
            if rare:
                passages[number] = MATCH * passage[number]
            # an item of common words only: its longest runs
            size = min(LONGEST, n)
            for place, length in rare or [(place, size) for place in range(n - size + 1)]:
                found.setdefault(length, []).append((number, place, 0))
        seeds = {}
        for length, places in found.items():
            hashes = np.array([windows(words[i][p:p + length], np.zeros(length, np.int64), length)[0][0] for i, p, _ in places], np.uint64)
            order = np.argsort(hashes, kind="stable")
            keys, first = np.unique(hashes[order], return_index=True)
            where = np.array([(i, p) for i, p, _ in places], np.int64)[order]
            seeds[length] = (Lookup(keys), np.append(first, len(order)), where)
        return cls(ids, words, passages, seeds)

    def stretches(self, line: np.ndarray, owner: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item, first word, word after): where seeds say that an item may lie, overlapping stretches as one."""
        hits = []
        for length, (lookup, first, where) in self.seeds.items():
            hashes, starts = windows(line, owner, length)
            at, key = lookup(hashes)
            for place, k in zip(starts[at].tolist(), key.tolist(), strict=True):
                for item, offset in where[first[k]:first[k + 1]].tolist():
                    hits.append((int(owner[place]), item, place - offset))
        hits.sort()
        ends = np.cumsum(np.bincount(owner)) if len(owner) else np.empty(0, np.int64)
        out: list[list[int]] = []
        for text, item, diagonal in hits:
            n = len(self.words[item])
            slack = SLACK + n // 5
            low, high = max(diagonal - slack, int(ends[text - 1]) if text else 0), min(diagonal + n + slack, int(ends[text]))
            # one stretch stays below a few items' length, so no alignment grows with the document
            if out and out[-1][:2] == [text, item] and low <= out[-1][3] and high - out[-1][2] <= 4 * (n + 2 * slack):
                out[-1][3] = max(out[-1][3], high)
            else:
                out.append([text, item, low, high])
        return [tuple(x) for x in out]

    def matches(self, texts: list[str | None], least: float) -> list[dict[int, tuple[float, int, int]]]:
        """For each text, its items that it holds, with their best similarity and where it lies, in words."""
        out: list[dict[int, tuple[float, int, int]]] = [{} for _ in texts]
        line, owner = word_hashes([spaced(text or "")[0] for text in texts], PUNCTUATION)
        if not len(line) or not self.seeds:
            return out
        begins = np.searchsorted(owner, np.arange(len(texts)))
        found = self.stretches(line, owner)
        found.sort(key=lambda x: (len(self.words[x[1]]), x[3] - x[2]))
        for at in range(0, len(found), 256):
            part = found[at:at + 256]
            scores, stops = align([self.words[i] for _, i, _, _ in part], [line[a:b] for _, _, a, b in part])
            for (text, item, low, _), score, stop in zip(part, scores.tolist(), stops.tolist(), strict=True):
                n = len(self.words[item])
                similarity = score / (MATCH * n)
                if (similarity >= least or score >= self.passages[item]) and similarity > out[text].get(item, (0.0,))[0]:
                    end = low + stop - int(begins[text])
                    out[text][item] = (similarity, max(0, end - n), end)
        return out


def align(items: list[np.ndarray], stretches: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair and the word of the stretch after its end.

    All pairs advance one item word at a time; gaps along the stretch are a running maximum.
    """
    rows, width = max(map(len, items)), max(map(len, stretches))
    left = np.zeros((len(items), rows), np.uint64)
    right = np.zeros((len(items), width), np.uint64)
    real = np.zeros((len(items), width), bool)
    for i, (a, b) in enumerate(zip(items, stretches, strict=True)):
        left[i, :len(a)], right[i, :len(b)], real[i, :len(b)] = a, b, True
    lengths = np.array([len(a) for a in items])
    slope = (np.arange(width) * GAP).astype(np.int32)
    above = np.zeros((len(items), width), np.int32)
    best, stop = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for row in range(rows):
        step = np.where((right == left[:, row:row + 1]) & real, MATCH, MISMATCH).astype(np.int32)
        here = step
        here[:, 1:] += above[:, :-1]
        here = np.maximum(np.maximum(here, above + GAP), 0)
        above = np.maximum.accumulate(here - slope, axis=1) + slope
        live = row < lengths
        top = above.argmax(axis=1)
        value = above[np.arange(len(items)), top]
        better = live & (value > best)
        best[better], stop[better] = value[better], top[better] + 1
    return best, stop


def item_words(tests: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item_id, words, passage`` of the items that have enough words to match."""
    source = tests.select(F.col(item_id).alias("item_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))

    def compute(texts: list[str]) -> list[list]:
        cut = [spaced(t) for t in texts]
        line, owner = word_hashes([t for t, _ in cut], PUNCTUATION)
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
        return [[line[a:b].view(np.int64) for a, b in zip(cuts, cuts[1:], strict=False)],
                [PASSAGE * (1 + single / max(1, n)) for (_, single), n in zip(cut, np.diff(cuts).tolist(), strict=True)]]

    return with_outputs(source, "body", "words array<bigint>, passage double", compute, drop=["body"]).where(F.size("words") >= SHORTEST)


def word_counts(docs: DataFrame, text: str, wanted: np.ndarray) -> tuple[dict[int, float], float]:
    """How often the corpus holds each word of ``wanted`` (sorted hashes), and how many words it has in all."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)
    source = docs.select(F.coalesce(F.col(text), F.lit("")).alias("body"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, counts, total = Lookup(shared.value), np.zeros(len(shared.value), np.int64), 0
        for batch in batches:
            for part in slices(batch, "body"):
                line, _ = word_hashes([spaced(t)[0] for t in part.column("body").to_pylist()], PUNCTUATION)
                counts += np.bincount(lookup(line)[1], minlength=len(counts))
                total += len(line)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], total))], names=["place", "n"])

    # one row for each word of `wanted`, and the total
    rows = map_batches(source, run, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect()
    counts = {row["place"]: float(row["n"]) for row in rows}
    return {int(wanted[place]): n for place, n in counts.items() if place >= 0}, counts.get(-1, 0.0)


def parts_of(tests: DataFrame, docs: DataFrame, item_id: str, item_text: str, text: str, expected: float) -> Iterator[Items]:
    """The benchmark with its seeds, in parts that fit in memory."""
    held = item_words(tests, item_id, item_text)
    size = held.agg(F.sum(F.size("words"))).first()[0] or 0
    parts = -(-size // WORDS_AT_ONCE)
    for number in range(parts):
        rows = held.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(parts)) == number).orderBy("item_id", "words").collect()
        words = [np.array(row["words"], np.int64).view(np.uint64) for row in rows]
        if words:
            frequency, total = word_counts(docs, text, np.unique(np.concatenate(words)))
            yield Items.seeded([row["item_id"] for row in rows], words, [row["passage"] for row in rows], frequency, total, expected)


def leaks(docs: DataFrame, tests: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
          least: float = 0.5, expected: float = 1.0) -> DataFrame:
    """``doc_id, item_id, similarity, first_word, last_word`` of each document that holds a test item."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    kind = tests.schema[item_id].dataType.simpleString()
    match = f"array<struct<item_id:{kind},similarity:double,first_word:bigint,last_word:bigint>>"
    out = docs.sparkSession.createDataFrame([], f"doc_id {source.schema['doc_id'].dataType.simpleString()}, match {match[6:-1]}")
    for items in parts_of(tests, docs, item_id, item_text, text, expected):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def compute(texts: list[str], shared=shared) -> list[list]:
            held = shared.value
            return [[[{"item_id": held.ids[item], "similarity": s, "first_word": a, "last_word": b} for item, (s, a, b) in sorted(found.items())]
                     for found in held.matches(texts, least)]]

        found = with_outputs(source, "body", f"matches {match}", compute, drop=["body"])
        out = out.union(found.select("doc_id", F.explode("matches").alias("match")))
    return out.select("doc_id", "match.*")


def clean(docs: DataFrame, tests: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
          least: float = 0.5, expected: float = 1.0) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with their own columns."""
    kept = docs
    for items in parts_of(tests, docs, item_id, item_text, text, expected):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def compute(texts: list[str | None], shared=shared) -> list[list]:
            return [[len(found) > 0 for found in shared.value.matches(texts, least)]]

        kept = with_outputs(kept, text, "`_leaks` boolean", compute).where("NOT `_leaks`").select(*docs.columns)
    return kept
