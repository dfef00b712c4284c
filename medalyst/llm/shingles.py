"""Word and shingle hashes of many texts at once, in numpy.

Words are what stands between spaces and the characters 9 to 13; A-Z count as a-z. All hashes are 64 bits wide.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np

WORDS = 5
_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]                       # A-Z count as a-z
_SEPARATOR = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: Everything in ASCII but letters and digits parts words.
PUNCTUATION = (np.arange(256) < 128) & ~np.isin(np.arange(256), [*range(48, 58), *range(65, 91), *range(97, 123)])
# scripts without spaces between words: Thai, Lao, Myanmar, Khmer, Tai, Chinese, Japanese, Yi
_UNSPACED = ("\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u1950-\u19df\u1a20-\u1aaf\u2e80-\u2fdf\u3005-\u3007\u3021-\u3029\u3031-\u3035\u3038-\u303c"
             "\u3041-\u312f\u31a0-\u31bf\u31f0-\u31ff\u3400-\u4dbf\u4e00-\ua4cf\ua9e0-\ua9ff\uaa60-\uaadf\uf900-\ufaff\uff66-\uff9f"
             "\U0001aff0-\U0001b16f\U00020000-\U0003ffff")
_PLACE = _RNG.integers(0, 2**64, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which each output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo 2**64."""
    line = np.full(n, np.uint64(base % 2**64))
    line[0] = 1
    return np.cumprod(line, dtype=np.uint64)


_STEP = 1 << 12
_POWERS = _powers(_BASE, _STEP)                    # of the places in a word; places beyond go in steps of that many
_STRETCH = 1 << 20                                 # bytes whose places are laid out at once, or one longer word


@lru_cache(maxsize=1)
def _unicode_cuts() -> tuple[re.Pattern[str], re.Pattern[str], re.Pattern[str]]:
    """Characters beyond ASCII that part words (punctuation, symbols, spaces, controls), up to U+FFFF and above, and those that are words by themselves.

    Python looks the lower ones up in a table and tries the upper ones one by one, so they are kept apart.
    """
    parting = [c for c in map(chr, range(128, 0x20000)) if unicodedata.category(c)[0] in "PSZ" or unicodedata.category(c) == "Cc"]
    low, high = ("".join(re.escape(c) for c in parting if (c > "\uffff") == upper) for upper in (False, True))
    return re.compile(f"[{low}\u200b]+"), re.compile(f"[{high}]+"), re.compile(f"[{_UNSPACED}]")


_UPPER = re.compile("[\U00010000-\U0010ffff]+")


def spaced(text: str) -> tuple[bytes, int]:
    """``text`` with spaces wherever words part in any script, and how many of its words are single characters of scripts without spaces."""
    if text.isascii():
        return text.encode(), 0
    low, high, unspaced = _unicode_cuts()
    parted = _UPPER.sub(lambda found: high.sub(" ", found[0]), low.sub(" ", text))
    cut, single = unspaced.subn(r" \g<0> ", parted)
    return cut.encode(), single


def word_hashes(texts: list[bytes], separators: np.ndarray = _SEPARATOR) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of the text that each belongs to. ``separators`` must hold the space."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    edges = np.diff(np.concatenate([[True], separators[joined]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    hashes = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.searchsorted(starts, np.arange(0, len(joined), _STRETCH)))
    for a, b in zip(cuts, [*cuts[1:], len(starts)], strict=True):
        if a < b:
            first, last = starts[a], ends[b - 1]
            place = np.arange(first, last) - np.repeat(starts[a:b], np.diff(np.append(starts[a:b], last)))
            value = _BYTE[joined[first:last]] * _POWERS[place % _STEP]
            if (longest := int(place.max())) >= _STEP:
                value *= _powers(pow(_BASE, _STEP, 2**64), longest // _STEP + 1)[place // _STEP]
            total = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
            hashes[a:b] = mixed(total[ends[a:b] - first] - total[starts[a:b] - first])
    bounds = np.cumsum([len(text) + 1 for text in texts])
    return hashes, np.searchsorted(bounds, starts, side="right")


def windows(words: np.ndarray, owner: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words inside one text, and the place of its first word."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(owner[:n] == owner[size - 1:])
    total = np.zeros(len(at), np.uint64)
    for i in range(size):
        total += words[at + i] * _PLACE[i]
    return mixed(total), at


def shingle_sets(texts: list[str | None], size: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text: runs of ``size`` words, or all words as one where there are fewer."""
    words, owner = word_hashes([(text or "").encode() for text in texts])
    runs, at = windows(words, owner, size)
    counts = np.bincount(owner, minlength=len(texts))
    ends = np.cumsum(counts)
    edges = np.searchsorted(owner[at], np.arange(len(texts) + 1))
    out = []
    for i, n in enumerate(counts.tolist()):
        if n >= size:
            out.append(np.unique(runs[edges[i]:edges[i + 1]]))
        else:
            few = words[ends[i] - n:ends[i]]
            out.append(mixed((few * _PLACE[8 + size + n:8 + size + 2 * n]).sum(keepdims=True, dtype=np.uint64)) if n else few)
    return out
