"""Suffix order of the words of many texts at once, in numpy.

Words are what stands between spaces and the characters 9 to 13. The order comes from prefix doubling: round k tells which suffixes share their first ``2**k`` words,
and only suffixes that still share them go on to the next round.
"""

from __future__ import annotations

import numpy as np


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def word_numbers(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word in order (equal words, equal numbers), and the number of words in each text."""
    numbers = _Numbers()
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.fromiter((n for words in texts for n in map(numbers.__getitem__, words)), np.int64, int(counts.sum())), counts


class Suffixes:
    """Suffixes of the texts whose words are ``ids``; those of one text (``owner``, rising) stand together, and nothing is shared between texts.

    ``order`` lists the suffixes' places, ``ranks[k][i]`` is the first place in ``order`` of the suffixes that share ``2**k`` words with suffix i. Such words
    never reach beyond the end of a text.
    """

    def __init__(self, ids: np.ndarray, owner: np.ndarray):
        n = len(ids)
        self.n = n
        self.order = np.empty(n, np.int64)
        self.ranks: list[np.ndarray] = []
        if not n:
            return
        last = np.searchsorted(owner, owner, side="right")              # where each word's text ends
        key = owner.astype(np.int64) * (int(ids.max()) + 1) + ids
        slots, todo = np.arange(n), np.arange(n)
        rank = np.full(n + 1, -1, np.int32)
        step = 0
        while len(todo):
            order = np.argsort(key, kind="stable")
            todo, key = todo[order], key[order]
            self.order[slots] = todo
            fresh = np.concatenate([[True], key[1:] != key[:-1]])
            rank = rank.copy()
            rank[todo] = slots[np.maximum.accumulate(np.where(fresh, np.arange(len(todo)), 0))]
            self.ranks.append(rank)
            shared = ~(fresh & np.concatenate([fresh[1:], [True]]))
            slots, todo = slots[shared], todo[shared]
            step = 2 * step or 1
            ahead = np.minimum(todo + step, n)
            key = rank[todo].astype(np.int64) * (n + 2) + np.where(ahead < last[todo], rank[ahead] + 1, 0)

    def shared_ahead(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from places ``a`` and ``b`` on are equal (a place never meets itself)."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[k]
            length += np.where(rank[a + length] == rank[b + length], 1 << k, 0)
        return length

    def shared_behind(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words right before places ``a`` and ``b`` are equal."""
        length = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            rank, x, y = self.ranks[k], a - length - (1 << k), b - length - (1 << k)
            inside = (x >= 0) & (y >= 0)
            length += np.where(inside & (rank[np.where(inside, x, 0)] == rank[np.where(inside, y, 1)]), 1 << k, 0)
        return length

    def neighbours(self) -> np.ndarray:
        """Longest common prefix, in words, of each suffix and the next in order."""
        out = np.zeros(max(0, self.n - 1), np.int64)
        if self.n > 1:
            first = self.ranks[0][self.order]
            some = np.flatnonzero(first[1:] == first[:-1])
            out[some] = self.shared_ahead(self.order[some], self.order[some + 1])
        return out

    def longest_repeats(self) -> np.ndarray:
        """For each place the number of words from there that occur again in its text: the depth of the innermost prefix interval around its suffix."""
        beside = self.neighbours()
        out = np.zeros(self.n, np.int64)
        out[self.order] = np.maximum(np.concatenate([[0], beside]), np.concatenate([beside, [0]]))[:self.n]
        return out
