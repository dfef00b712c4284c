"""Quality rules from the repeated substrings of each text, found by its suffix array.

The suffixes of a text's words are sorted, and the intervals of the order whose suffixes share a longest common prefix are its repeated substrings. One
is maximal if no copy can be extended on either side with all its copies; each maximal repeat of at least ``LEAST`` words marks the span of every copy, the
first included. The union of the spans, as a share of the words, and the longest repeat have limits; fixed counts of words and lines stand beside them.

Defined cases: NULL text counts as empty, and an empty text has too few words; NULL ids, equal ids and repeated rows are rows like any
others; an empty table gives an empty result; other columns are ignored, whatever their names. A text is judged whole, however long it is: memory follows the longest one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import with_outputs
from medalyst.llm.suffixes import Suffixes, word_numbers

WINDOW = 3                     # words of the windows that n_repeat_words counts
LEAST = 10                     # words of the shortest repeat that counts
MOST_COVERED = 0.2             # share of the words that repeats may cover
MOST_LONGEST = 40              # words of the longest repeat
SYMBOLS = "#*$%&|<>"
SLICE = 2 << 20
OUTPUTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_covered bigint, longest_repeat bigint, n_maximal bigint"


def covered(starts: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a span."""
    edges = np.bincount(starts, minlength=n + 1) - np.bincount(starts + sizes, minlength=n + 1)
    return np.cumsum(edges[:n]) > 0


def repeats(ids: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """For each text: words in repeated windows of ``WINDOW`` words, words covered by maximal repeats, the longest repeat, spans of maximal repeats."""
    texts, n = len(counts), len(ids)
    owner = np.repeat(np.arange(texts), counts)
    depth = Suffixes(ids, owner).longest_repeats()
    narrow = np.flatnonzero(depth >= WINDOW)
    windows = covered(narrow, np.full(len(narrow), WINDOW), n)
    # one word earlier the repeat is one longer where all copies of its innermost interval have the same word before them
    before = np.concatenate([[0], depth[:-1]])
    starts = np.flatnonzero((depth >= least) & (before != depth + 1))
    spans = covered(starts, depth[starts], n)
    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, owner[starts], depth[starts])
    return (np.bincount(owner[windows], minlength=texts), np.bincount(owner[spans], minlength=texts), longest, np.bincount(owner[starts], minlength=texts))


def duplicate_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def counted(texts: list[str | None], least: int = LEAST) -> list:
    """The columns of ``OUTPUTS`` for a list of texts."""
    texts = [text or "" for text in texts]
    words = [text.encode().split() for text in texts]                    # bytes are cut at ASCII white space alone
    ids, counts = word_numbers(words)
    windows, spans, longest, maximal = repeats(ids, counts, least)
    return [counts, [len(b"".join(w).decode()) for w in words], [sum(map(text.count, SYMBOLS)) for text in texts],
            [duplicate_lines(text) for text in texts], windows, spans, longest, maximal]


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, most_covered: float = MOST_COVERED,
           most_longest: int = MOST_LONGEST, min_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """Per row the counts, ``base_failed`` (too few words, or too many of them in repeated windows) and ``kept``."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = with_outputs(rows, "text", OUTPUTS, lambda texts: counted(texts, least), drop=["text"], size=SLICE)
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    repetitive = (F.col("n_covered") > most_covered * F.col("n_words")) | (F.col("longest_repeat") > most_longest)
    return found.withColumn("base_failed", base).withColumn("kept", ~base & ~repetitive)
