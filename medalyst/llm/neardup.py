"""MinHash near-duplicates by tensored banding, with every link confirmed on the full shingle sets.

Two small collections of half-keys are made per document, each half-key from ``HALF`` minhashes. A table key is a pair of one half-key of either
collection, so ``HALVES ** 2`` keys come from ``2 * HALVES * HALF`` minhashes instead of ``2 * HALF * HALVES ** 2``. Two sets of similarity 3/4
miss each other in all keys with a chance of ``2 * (1 - 0.75 ** HALF) ** HALVES`` at most (2e-5).

Steps: equal sets become one node; half-keys and keys that one node has alone are left out; the nodes of a key are compared with its smallest
node, and confirmed links give components; nodes of keys that still hold several components are chained into families by their sketches, in blocks
of bounded size; inside a family, blocks of full sets are compared across components and only links that join two of them are given out, so
no pair list of a group is ever made or shuffled. A sketch drops a pair of similarity 3/4 with a chance of about 3e-6; nothing else is dropped.

Defined cases: NULL text, empty text and text without words have an empty set (``n_shingles`` 0) and are linked with nothing; a text of fewer
words than a shingle is one shingle; a NULL id is linked with nothing (``component_id`` NULL, ``kept`` true); rows that share an id are one document
for linking; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import map_batches, with_outputs
from medalyst.llm.shingles import WORDS, mixed, shingle_sets
from medalyst.session import durable

HALF, HALVES = 2, 14
SKETCH = 128                  # minhashes of the sketch, a byte each; the first 2 * HALVES * HALF make the half-keys
LEAST_EQUAL = 74              # of SKETCH: 4.5 standard deviations below similarity 3/4
BLOCK = 512                   # nodes compared with each other in one step
FAMILY_SHINGLES = 1 << 20     # in one block of a family
SLICE = 1 << 20               # bytes of text hashed at once
BROADCAST_IDS = 1_000_000     # ids of 8 bytes; beyond it, a shuffled join
_SALT = mixed(np.arange(1, SKETCH + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = mixed(_SALT) | np.uint64(1)
_PART = mixed(np.arange(101, 101 + 2 * HALVES, dtype=np.uint64))


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """``SKETCH`` minhashes for each non-empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros((len(sets), SKETCH), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        starts = np.cumsum(sizes[full]) - sizes[full]
        for k in range(SKETCH):
            out[full, k] = np.minimum.reduceat((flat ^ _SALT[k]) * _ODD[k], starts)
    return out


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def marks(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """``doc_id, n_shingles, set_key, halves, sketch`` per row; the last three NULL for an empty set."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))

    def compute(texts: list[str]) -> list[list]:
        sets = shingle_sets(texts, words)
        low = minhashes(sets)
        halves = low[:, :2 * HALVES * HALF].reshape(len(sets), 2 * HALVES, HALF)
        keys = mixed(halves[:, :, 0] ^ _PART)
        for i in range(1, HALF):
            keys = mixed(keys + halves[:, :, i])
        sketch = (mixed(low) >> np.uint64(56)).astype(np.uint8)
        some = [len(s) > 0 for s in sets]
        return [[len(s) for s in sets],
                [set_key(s) if ok else None for s, ok in zip(sets, some, strict=True)],
                [x if ok else None for x, ok in zip(keys.view(np.int64), some, strict=True)],
                [x.tobytes() if ok else None for x, ok in zip(sketch, some, strict=True)]]

    return with_outputs(source, "body", "n_shingles bigint, set_key binary, halves array<bigint>, sketch binary", compute, drop=["body"], size=SLICE)


def table_keys(nodes: DataFrame) -> DataFrame:
    """``key, node``: pairs of half-keys, without half-keys and keys that occur once."""
    halves = nodes.select("node", F.posexplode("halves").alias("place", "half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    left = [F.collect_list(F.when(cond, F.col("half"))).alias(name)
            for name, cond in (("first", F.col("place") < HALVES), ("second", F.col("place") >= HALVES))]
    pairs = (halves.join(shared, "half").groupBy("node").agg(*left)
             .select("node", F.explode("first").alias("a"), "second").select("node", "a", F.explode("second").alias("b")))
    return durable(pairs.select(F.xxhash64("a", "b").alias("key"), "node"))


def sketched_pairs(pairs: DataFrame, nodes: DataFrame, least_equal: int = LEAST_EQUAL) -> DataFrame:
    """The (a, b) pairs that the sketches do not rule out."""
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in ("sketch_a", "sketch_b"))
            yield batch.select(["a", "b"]).filter(pa.array((one == two).sum(axis=1) >= least_equal))

    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b"), run, "a bigint, b bigint")


@dataclass
class Texts:
    """Where full sets are read again: ``docs``, and the nodes with the smallest id that has each one's set."""

    docs: DataFrame
    doc_id: str
    text: str
    words: int
    nodes: DataFrame
    repeated: bool               # whether rows share an id, so that an id does not tell a set

    def full_sets(self, wanted: DataFrame) -> DataFrame:
        """``node, shingles`` of the nodes in ``wanted`` (node)."""
        columns = ["node", "id", "set_key"] if self.repeated else ["node", "id"]
        named = durable(self.nodes.join(wanted, "node", "left_semi").select(*columns))
        ids = named.select("id").distinct() if self.repeated else named
        few = named.count() <= BROADCAST_IDS
        texts = self.docs.select(F.col(self.doc_id).cast("bigint").alias("id"), F.coalesce(F.col(self.text), F.lit("")).alias("body"))
        held = texts.join(F.broadcast(ids) if few else ids, "id", "left_semi" if self.repeated else "inner")

        def compute(rows: list[str], words: int = self.words) -> list[list]:
            sets = shingle_sets(rows, words)
            return [[s.tobytes() for s in sets], [set_key(s) for s in sets]]

        sets = with_outputs(held.drop("id"), "body", "shingles binary, set_key binary", compute, drop=["body"], size=SLICE)
        if self.repeated:        # one row of each set, whichever ids and rows it came from
            return durable(sets.join(named.select("node", "set_key"), "set_key").dropDuplicates(["node"]).select("node", "shingles"))
        return durable(sets.select("node", "shingles"))


def confirmed(pairs: DataFrame, texts: Texts, numerator: int, denominator: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough: ``denominator * |A and B| >= numerator * |A or B|``."""
    sets = texts.full_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [similar(*(np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in ("left", "right")), numerator, denominator)
                    for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right"), run, "a bigint, b bigint")


def similar(a: np.ndarray, b: np.ndarray, numerator: int, denominator: int) -> bool:
    """Whether two sorted sets are similar enough; sizes too far apart need no look."""
    if denominator * min(len(a), len(b)) < numerator * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return denominator * both >= numerator * (len(a) + len(b) - both)


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable over ``links`` (a, b), for every node that has one.

    Each round takes the smallest label among a node and its neighbours, then that label's own label, so distances shrink by half.
    """
    links = durable(links)      # read in both directions, so made once
    both = durable(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = durable(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component"))
                     .select(F.col("a").alias("node"), "component"))
    while True:
        of = labels.select(F.col("node").alias("b"), F.col("component").alias("near"))
        lower = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        step = labels.join(lower, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = durable(step.join(jump, "next", "left").select("node", F.least("next", "far").alias("component"), "was"))
        labels = moved.select("node", "component")
        if moved.where("component <> was").isEmpty():
            return labels


def blocked(members: DataFrame, sizes: DataFrame, group: str) -> DataFrame:
    """Each member once for each pair of blocks of its group that its own block is in: columns ``low``, ``high``, ``block``.

    ``sizes`` has a group's number of ``blocks``; groups without one are left out. Rows of a pair of blocks lie together.
    """
    cut = members.join(sizes, group).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    paired = spread.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).drop("other")
    return paired.repartition(group, "low", "high").sortWithinPartitions(group, "low", "high")


def _sides(low: int, high: int, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    every = np.arange(len(block))
    return (every, every) if low == high else (np.flatnonzero(block == low), np.flatnonzero(block == high))


def _near(sketch: np.ndarray, left: np.ndarray, right: np.ndarray, component: np.ndarray,
          least_equal: int = LEAST_EQUAL) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of different components, one from each side, that their sketches do not rule out; each pair once."""
    found_i, found_j = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for at in range(0, len(left), 64):
        part = left[at:at + 64]
        i, j = np.nonzero(component[part][:, None] != component[right])
        i, j = part[i], right[j]
        if left is right:
            i, j = i[i < j], j[i < j]
        ok = (sketch[i] == sketch[j]).sum(axis=1) >= least_equal
        found_i.append(i[ok])
        found_j.append(j[ok])
    return np.concatenate(found_i), np.concatenate(found_j)


def over_open_keys(keyed: DataFrame, nodes: DataFrame, labels: DataFrame,
                   found: Callable[[list[np.ndarray]], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """The (a, b) that ``found`` makes of each pair of blocks (low, high, block, node, component, sketch) of the keys that still hold several components."""
    named = keyed.join(labels, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    open_keys = (named.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("n"))
                 .where("least <> most").select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    laid = (blocked(named.join(nodes.select("node", "sketch"), "node"), open_keys, "key")
            .select("key", "low", "high", "block", "node", "component", "sketch"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None

        def links(parts: list[list[np.ndarray]]) -> pa.RecordBatch:
            made = [found(part) for part in parts]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([x[i] for x in made])) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "low", "high", "block", "node", "component")]
            now.append(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH))
            if rest is not None:
                now = [np.concatenate(x) for x in zip(rest, now, strict=True)]
            cut = np.flatnonzero((np.diff(now[0]) != 0) | (np.diff(now[1]) != 0) | (np.diff(now[2]) != 0)) + 1
            edges = [0, *cut.tolist()]
            if len(edges) > 1:
                yield links([[x[s:e] for x in now[1:]] for s, e in zip(edges, edges[1:], strict=False)])
            rest = [x[edges[-1]:] for x in now]
        if rest is not None and len(rest[0]):
            yield links([rest[1:]])

    return map_batches(laid, run, "a bigint, b bigint").distinct()


def families(keyed: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``component, family``: components that keys and sketches chain together, by the smallest of them.

    Only keys that still hold several components are looked at. A pair of blocks yields a star for each chain of components in it, not its pairs.
    """
    def stars(run: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        low, high, block, node, component, sketch = run
        i, j = _near(sketch, *_sides(low[0], high[0], block), component)
        names, place = np.unique(component, return_inverse=True)
        a, b = np.unique(np.stack([place[i], place[j]]), axis=1)
        label = np.arange(len(names))
        while len(a):
            before = label.copy()
            np.minimum.at(label, a, label[b])
            np.minimum.at(label, b, label[a])
            if (before == label).all():
                break
        moved = np.flatnonzero(label != np.arange(len(names)))
        return names[label[moved]], names[moved]

    return (components(over_open_keys(keyed, nodes, labels, stars))
            .select(F.col("node").alias("component"), F.col("component").alias("family")))


def joining(node: np.ndarray, component: np.ndarray, i: np.ndarray, j: np.ndarray,
            confirmed: Callable[[int, int], bool] = lambda x, y: True) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (i, j) that are confirmed and join two components; once two are joined, more pairs between them are not looked at."""
    above = {c: c for c in component.tolist()}

    def top(c: int) -> int:
        while above[c] != c:
            above[c] = c = above[above[c]]
        return c

    made = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        one, two = top(int(component[x])), top(int(component[y]))
        if one != two and confirmed(x, y):
            above[max(one, two)] = min(one, two)
            made.append((int(node[x]), int(node[y])))
    pairs = np.array(made, np.int64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def crossing_links(family: DataFrame, nodes: DataFrame, labels: DataFrame, texts: Texts, numerator: int, denominator: int) -> DataFrame:
    """Confirmed (a, b) links between components inside a family; once two components are joined in a block, more links are not looked for."""
    named = (nodes.select("node", "sketch", "n_shingles").join(labels, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    sized = durable(named.join(family, "component").select("family", "node", "component", "sketch", "n_shingles"))
    sets = texts.full_sets(sized.select("node"))
    sizes = (sized.groupBy("family").agg(F.greatest(F.sum("n_shingles") / FAMILY_SHINGLES, F.count(F.lit(1)) / BLOCK).alias("n"))
             .select("family", F.ceil("n").cast("int").alias("blocks")))
    laid = (blocked(sized.drop("n_shingles").join(sets, "node"), sizes, "family")
            .select("family", "low", "high", "block", "node", "component", "sketch", "shingles"))

    def links(rows: list[dict]) -> pa.RecordBatch:
        node, component, block = (np.array([row[c] for row in rows], np.int64) for c in ("node", "component", "block"))
        sketch = np.frombuffer(b"".join([row["sketch"] for row in rows]), np.uint8).reshape(-1, SKETCH)
        held = [np.frombuffer(row["shingles"], np.uint64) for row in rows]
        i, j = _near(sketch, *_sides(rows[0]["low"], rows[0]["high"], block), component)
        a, b = joining(node, component, i, j, lambda x, y: similar(held[x], held[y], numerator, denominator))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if rows and any(rows[0][c] != row[c] for c in ("family", "low", "high")):
                    yield links(rows)
                    rows = []
                rows.append(row)
        if rows:
            yield links(rows)

    return map_batches(laid, run, "a bigint, b bigint")


def one_document(marked: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b) links between the nodes of rows that share an id."""
    rows = (marked.where("set_key IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "set_key").distinct()
            .join(nodes.select("set_key", "node"), "set_key").select("doc_id", "node").distinct())
    least = rows.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a <> last").select("doc_id", "a")
    return rows.join(least, "doc_id").where("node <> a").select("a", F.col("node").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, numerator: int = 75,
                    denominator: int = 100) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``. The sketch is set for similarities of 3/4 and more."""
    if numerator * 4 < denominator * 3:
        raise ValueError("keys and sketches are set for a similarity of 3/4 or more")
    marked = durable(marks(docs.withColumn(doc_id, F.col(doc_id).cast("bigint")), doc_id, text, words))
    named = marked.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    # numbered by the smallest id that has each set, so the smallest node of a component has its smallest id
    nodes = durable(named.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("halves").alias("halves"), F.first("sketch").alias("sketch"),
                                                 F.first("n_shingles").alias("n_shingles"))
                    .orderBy("id", "set_key").withColumn("node", F.monotonically_increasing_id()))
    repeated = not marked.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    texts = Texts(docs, doc_id, text, words, nodes.select("node", "id", "set_key"), repeated)
    keys = table_keys(nodes)
    centres = keys.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre <> last").select("key", "centre")
    keyed = durable(keys.join(centres, "key"))
    stars = durable(sketched_pairs(keyed.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct(), nodes))
    first = durable(durable(confirmed(stars, texts, numerator, denominator)).union(one_document(marked, nodes)))
    labels = components(first)
    family = families(keyed.select("key", "node"), nodes, labels)
    later = durable(crossing_links(family, nodes, labels, texts, numerator, denominator))
    return assigned(marked, nodes, components(first.union(later)))


def assigned(marked: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """Each row's component, by way of the node of its set: the smallest id of any of its rows."""
    smallest = nodes.select(F.col("node").alias("component"), F.col("id").alias("root"))
    rooted = labels.where("node <> component").join(smallest, "component").select("node", "root")
    of_set = nodes.select("set_key", "node", "id").join(rooted, "node", "left").select("set_key", F.coalesce("root", "id").alias("component"))
    joined = marked.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest id. Rows without an id stay."""
    found = near_duplicates(docs, doc_id, text)
    stay = found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_kept_id")).distinct()
    known = docs.join(stay, docs[doc_id] == stay["_kept_id"], "left_semi")
    # rows may share an id: the smallest of them stays
    rest = [c for c in docs.columns if c != doc_id]
    single = known.groupBy(doc_id).agg(F.min(F.struct(*rest)).alias("_row")).select(doc_id, *[F.col("_row")[c].alias(c) for c in rest])
    return single.select(*docs.columns).unionByName(docs.where(F.col(doc_id).isNull()))
