"""Hard-negative mining by the BOND vertical scan: exact integer inner products of a query set (the anchors) against all rows.

Rows are packed into blocks that hold their vectors column by column. For one anchor and one block the columns are read in the order of the anchor's
largest components. After every few columns the least and the greatest contribution that the remaining columns can still add (from each column's
minimum and maximum in the block) bound every row's score, and rows that can no longer count leave the candidate bitmap. What is left at the end has its exact score.

Blocks of rows meet blocks of anchors in lanes: every row block lies in one lane, every anchor block in all of them, and one join on the lane deals
them out. A task holds one block of either kind at a time. The first pass keeps an anchor's nearest rows of its own label (the positives), the second the nearest rows
of other labels inside each positive's window of scores. Both passes return a few rows for an anchor and block, of which Spark keeps the first ones.

Defined cases: rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part; rows that share an id are rows
like any others, but never another row to each other; repeated anchors give repeated results. A missing component counts as 0, and so does an empty vector's every component. Scaled components beyond
``PEAK`` (inputs beyond 65,536) count as ``PEAK``, so that scores of up to 32,767 components fit in a long. A positive with a negative score has an empty window.
Ties go to the smaller id. An empty table gives an empty result, and other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalyst.llm.arrow import map_batches
from medalyst.session import durable, shuffle_width

PEAK = 1 << 24
STEP = 8                       # columns between two looks at the bounds
NARROW = 4                     # the candidates' columns to come are copied together once they are fewer than this part of the rows
ROW_BYTES, ANCHORS = 2 << 20, 256      # size of a block of rows, anchors in a block of anchors
_SHIFT = 8                     # an anchor's number is its block's number and its place among 256
BLOCK = "block bigint, ids binary, labels binary, width int, columns binary"


class Keep(NamedTuple):
    """What rules rows out, of which the columns not read yet add at least ``least`` and at most ``most`` to each score so far.

    ``none``: whether it surely rules out none, by the greatest of the rows' least scores and the least of their greatest scores.
    ``rows``: the bitmap of candidates that stay, by the scores so far, the bitmap of candidates, ``least`` and ``most``.
    """
    none: Callable[[float, float], bool]
    rows: Callable[[np.ndarray, np.ndarray, float, float], np.ndarray]


def bounds(values: np.ndarray) -> np.ndarray:
    """Least and greatest value of each column, 0 among them."""
    return np.stack([values.min(axis=1, initial=0), values.max(axis=1, initial=0)])


def scan(values: np.ndarray, query: np.ndarray, alive: np.ndarray, keep: Keep, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows (of the columns ``values``, among ``alive``) that ``keep`` does not rule out.

    ``ends`` are the ``bounds`` of ``values``, where the caller has them.
    """
    order = np.argsort(-np.abs(query), kind="stable")[:np.count_nonzero(query)]
    ends = (bounds(values) if ends is None else ends)[:, order] * query[order]
    rest = [np.concatenate([np.cumsum(end[::-1])[::-1], [0]]).tolist() for end in (ends.min(axis=0), ends.max(axis=0))]
    at, columns = np.arange(values.shape[1]), order                      # where in ``values`` the columns lie
    scores = np.zeros(len(at), values.dtype)
    for first in range(0, len(order), STEP):
        seen = min(first + STEP, len(order))
        scores = scores + query[order[first:seen]] @ values[columns[first:seen]]
        least, most = (r[seen] for r in rest)
        if len(at) and not keep.none(scores.max().item() + least, scores.min().item() + most):
            alive = keep.rows(scores, alive, least, most)
            if NARROW * np.count_nonzero(alive) < len(alive):
                values, at, scores = values[columns[seen:, None], np.flatnonzero(alive)], at[alive], scores[alive]
                alive, columns = np.ones(len(at), bool), np.arange(len(order)) - seen
    alive = keep.rows(scores, alive, 0, 0)
    return at[alive], scores[alive]


def _greatest(values: np.ndarray, k: int) -> float:
    """The k-th greatest value."""
    return np.partition(values, len(values) - k)[len(values) - k]


def nearest(k: int) -> Keep:
    """Rules out rows that k others are sure to beat."""
    def rows(scores: np.ndarray, alive: np.ndarray, least: float, most: float) -> np.ndarray:
        left = scores[alive]
        return alive if len(left) <= k else alive & (scores + most >= _greatest(left, k) + least)
    return Keep(lambda low, high: low <= high, rows)


def in_windows(windows: list[tuple[int, int]], k: int) -> Keep:
    """Rules out rows that lie in no window (both ends included), or below k rows that are sure to lie in it."""
    def none(low: float, high: float) -> bool:
        return any(start <= high and low <= end < high for start, end in windows)          # each row may lie in that window, none surely

    def rows(scores: np.ndarray, alive: np.ndarray, least: float, most: float) -> np.ndarray:
        spans = [(start, end) for start, end in windows if start <= end]
        if any(most - least <= end - start for start, end in spans):                       # else no row surely lies in a window
            left = np.sort(scores[alive])
            below = np.searchsorted(left + most, [end for _, end in spans], "right").tolist()
            spans = [(max(start, left[n - k].item() + least) if n >= k else start, end) for n, (start, end) in zip(below, spans, strict=True)]
        low, high, wanted, merged = scores + least, scores + most, np.zeros(len(scores), bool), []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        for start, end in merged:
            wanted |= (high >= start) & (low <= end)
        return alive & wanted
    return Keep(none, rows)


def scaled(rows: DataFrame, vec_id: str, vector: str, label: str, scale: int) -> DataFrame:
    """``id, label, vector``: whole rows only, components floored after scaling."""
    whole = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    held = lambda x: F.least(F.greatest(x.cast("double") * scale, F.lit(-float(PEAK))), F.lit(float(PEAK)))
    return (rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.forall("vector", whole))
            .withColumn("vector", F.transform("vector", lambda x: F.floor(held(x)).cast("int"))))


def packed(rows: DataFrame, most: int | None = None) -> DataFrame:
    """Blocks of ``id, label, vector`` rows, at most ``most`` rows or about ``ROW_BYTES`` each, in order of labels, columns side by side."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rest = TaskContext.get().partitionId() << 32, []
        for batch in chain(batches, [None]):
            held = pa.concat_batches(rest + [batch] * (batch is not None)) if rest or batch is not None else []
            width = int(held.column("vector").value_lengths().to_numpy().max(initial=0)) if len(held) else 0
            n = most or max(1, ROW_BYTES // (4 * max(1, width)))
            for at in range(0, len(held) if batch is None else len(held) // n * n, n):
                part = held.slice(at, n).sort_by("label")
                lists = part.column("vector")
                sizes, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy()
                matrix = np.zeros((len(part), int(sizes.max())), np.int32)
                matrix[np.arange(matrix.shape[1]) < sizes[:, None]] = flat
                ids, labels = (part.column(name).to_numpy().tobytes() for name in ("id", "label"))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([ids]), pa.array([labels]), pa.array([matrix.shape[1]], pa.int32()),
                                                  pa.array([np.ascontiguousarray(matrix.T).tobytes()])], ["block", "ids", "labels", "width", "columns"])
                block += 1
            rest = [held.slice(len(held) // n * n)] if batch is not None else []

    return map_batches(rows, run, BLOCK)


class Block:
    def __init__(self, row: dict):
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.columns = np.frombuffer(row["columns"], np.int32).reshape(row["width"], len(self.ids))


def paired(blocks: DataFrame, anchors: DataFrame) -> DataFrame:
    """Every block of rows beside every block of anchors, dealt out by lanes.

    Both sides are shuffled whatever their size: a copy for each lane is many times what the anchors' files suggest, and a broadcast would gather it on the driver.
    """
    lanes = max(1, min(shuffle_width(blocks.sparkSession), blocks.count()))
    laid = blocks.withColumn("lane", F.pmod(F.xxhash64("block"), F.lit(lanes)).cast("int")).repartition(lanes, "lane")
    spread = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"), F.struct(*anchors.columns).alias("anchors"))
    return laid.join(spread.hint("merge"), "lane").select(F.struct(*[c for c in blocks.columns]).alias("rows"), "anchors")


def each_anchor(batches: Iterator[pa.RecordBatch], found: Callable, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """``found(row, rows, values, ends, anchors, i, query)`` for each anchor of each pair of blocks; it returns columns of equal length."""
    for batch in batches:
        for row in batch.to_pylist():
            rows, anchors = Block(row["rows"]), Block(row["anchors"])
            width = min(len(rows.columns), len(anchors.columns))
            whole, queries = rows.columns[:width], anchors.columns[:width].T
            peak = int(np.abs(whole).max(initial=0)) * int(np.abs(queries).max(initial=0)) * width
            kind = np.float32 if peak < 1 << 24 else np.float64 if peak < 1 << 53 else np.int64               # each is exact
            whole, queries = whole.astype(kind), queries.astype(kind)
            ends = bounds(whole)
            parts = [p for i in range(len(anchors.ids)) for p in found(row, rows, whole, ends, anchors, i, queries[i])]
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def ranked(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k: highest score, then smallest id."""
    return np.lexsort((ids, -scores))[:k]


def _first(rows: DataFrame, by: list[str], score: str, tie: str, k: int, out: str) -> DataFrame:
    here = Window.partitionBy(*by).orderBy(F.desc(score), tie)
    return rows.withColumn(out, F.row_number().over(here)).where(F.col(out) <= k)


def _schema(names: str) -> tuple[str, pa.Schema]:
    return ", ".join(f"{n} bigint" for n in names.split()), pa.schema([(n, pa.int64()) for n in names.split()])


def positives(blocks: DataFrame, anchors: DataFrame, k: int) -> DataFrame:
    """``anchor, anchor_id, positive_id, positive_score, place``: an anchor's first ``k`` other rows of its label."""
    ddl, schema = _schema("anchor anchor_id positive_id positive_score")
    keep = nearest(k)

    def found(row, rows, values, ends, anchors, i, query):
        own = slice(*(np.searchsorted(rows.labels, anchors.labels[i], side) for side in ("left", "right")))
        ids = rows.ids[own]
        alive = ids != anchors.ids[i]
        if not alive.any():
            return
        at, scores = scan(values[:, own], query, alive, keep)
        best = ranked(ids[at], scores, k)
        n = len(best)
        yield np.full(n, (row["anchors"]["block"] << _SHIFT) + i), np.full(n, anchors.ids[i]), ids[at[best]], scores[best].astype(np.int64)

    made = map_batches(paired(blocks, anchors), lambda batches: each_anchor(batches, found, schema), ddl)
    return _first(made, ["anchor"], "positive_score", "positive_id", k, "place")


def negatives(blocks: DataFrame, anchors: DataFrame, near: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """For each positive the first ``k`` rows of other labels with ``low * positive <= 100 * score <= high * positive``."""
    ddl, schema = _schema("anchor place anchor_id positive_id positive_score negative_id negative_score")
    windows = (near.groupBy(F.shiftright("anchor", _SHIFT).alias("block"))            # at most 256 anchors with a few positives each
               .agg(F.collect_list(F.struct("anchor", "place", "positive_id", "positive_score")).alias("near")))

    def found(row, rows, values, ends, anchors, i, query):
        number = (row["anchors"]["block"] << _SHIFT) + i
        if "near" not in row:
            row["near"] = defaultdict(list)
            for p in row["anchors"]["near"]:
                row["near"][p["anchor"]].append(p)
        mine = row["near"].get(number, [])
        windows_of = [(-(-low * p["positive_score"] // 100), high * p["positive_score"] // 100) for p in mine]
        alive = rows.labels != anchors.labels[i]
        if not mine or not alive.any():
            return
        at, scores = scan(values, query, alive, in_windows(windows_of, k), ends)
        scores = scores.astype(np.int64)
        for p, (least, most) in zip(mine, windows_of, strict=True):
            inside = np.flatnonzero((scores >= least) & (scores <= most))
            best = inside[ranked(rows.ids[at[inside]], scores[inside], k)]
            if len(best):
                same = [np.full(len(best), v, np.int64) for v in (number, p["place"], anchors.ids[i], p["positive_id"], p["positive_score"])]
                yield *same, rows.ids[at[best]], scores[best]

    made = map_batches(paired(blocks, anchors.join(windows.hint("merge"), "block")), lambda batches: each_anchor(batches, found, schema), ddl)
    return _first(made, ["anchor", "place"], "negative_score", "negative_id", k, "rank")


def mine(vectors: DataFrame, anchor: Column, relabelled: Column | None = None, vec_id: str = "vec_id", vector: str = "embedding",
         label: str = "label", scale: int = 256, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` (over ``id``) tells which rows are anchors, ``relabelled`` (over ``id`` and ``label``) replaces the label.
    """
    rows = scaled(vectors, vec_id, vector, label, scale)
    if relabelled is not None:
        rows = rows.withColumn("label", relabelled)
    queries = durable(rows.where(anchor))
    blocks = durable(packed(rows))
    n_blocks = -(-queries.count() // ANCHORS)
    anchors = durable(packed(queries.repartition(max(1, n_blocks)), ANCHORS))
    near = durable(positives(blocks, anchors, n_positives))
    return negatives(blocks, anchors, near, n_negatives, low, high).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
