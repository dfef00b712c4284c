"""Document fingerprints by a randomised edit embedding.

A shared random walk runs over each text: at every step it writes the character it stands on and then, by a random bit of the step and the
character, stays or moves on. Two walks over texts that differ by an edit soon stand on the same character again, so a small edit distance
becomes a small Hamming distance between what the walks wrote. ``WALKS`` walks run, each from the start of every ``SEGMENT`` characters of
the whole text; segment ``i`` has the steps from ``i * STEPS``.

The fingerprint samples the written symbols: at level ``j`` one step of each 2**j, the smallest level with at most ``SLOTS`` samples. A block of a
level has the sample of one of its two halves, so a finer fingerprint holds the coarser ones. A sample is a byte of what the walk wrote at the
step and the ``TRAIL - 1`` before it. ``likeness`` is the share of equal samples (one less the Hamming distance a sample) of the walk that
agrees best, after chance. ``near_links`` finds candidates by equal groups of samples, at a text's level and the next, and verifies them by the
Hamming distance of all samples; ``near_groups`` gives each document its component over these links.

Defined cases: NULL text counts as empty; an empty text has the empty fingerprint, like only to another one; equal texts have equal fingerprints;
an empty table gives an empty result; documents of equal id follow each other by text; NULL ids come last; other columns are ignored, whatever
their names. A walk that has not left a segment after ``STEPS`` steps (12 standard deviations late) ends there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from medalyst.llm import neardup
from medalyst.llm.arrow import map_batches, slices, with_outputs
from medalyst.llm.shingles import mixed
from medalyst.session import durable, shuffle_width

WALKS, SLOTS, TRAIL = 3, 42, 3
SEGMENT, STEPS = 3584, 8192            # a walk takes two steps a character on average
WALKED_BYTES = 24 << 20                # written by walks that run side by side
SLICE = 2 << 20                        # bytes of text at once
_RNG = np.random.Generator(np.random.PCG64(77))
_MOVES = _RNG.integers(0, 1 << WALKS, (STEPS, 256), dtype=np.uint8)     # the shared walks: step, character class; a bit for each walk
_MOVES[:, 0] = 0                                                        # class 0 stands for the end
_WEIGHTS = _RNG.integers(0, 2**32, TRAIL, dtype=np.uint32) | np.uint32(1)
_SIDES = _RNG.integers(0, 2**64, WALKS, dtype=np.uint64)
_REACH = SLOTS << np.arange(48, dtype=np.int64)                         # steps that the samples of each level span


def _half(level: int, blocks: np.ndarray) -> np.ndarray:
    """Which half of each block (walks, blocks) of a level gives its sample."""
    return (mixed(_SIDES[:, None] ^ (blocks.astype(np.uint64) * np.uint64(64) + np.uint64(level))) & np.uint64(1)).astype(np.int64)


@lru_cache(maxsize=64)
def places(level: int) -> np.ndarray:
    """The step that each walk's samples of a level are taken at: (``WALKS``, ``SLOTS``)."""
    at = np.tile(np.arange(SLOTS, dtype=np.int64), (WALKS, 1))
    for above in range(level, 0, -1):
        at = 2 * at + _half(above, at)
    return at


def _walk(padded: np.ndarray, starts: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """What the walks from ``starts`` write, (steps, walks, starts), after ``TRAIL - 1`` rows of zeros, and how many steps each takes.

    ``padded`` has a 0 after each segment; segments come by falling length, so those that have ended lie at the end.
    """
    lead, steps = TRAIL - 1, min(STEPS, 3 * longest + 64)
    out = np.zeros((steps + lead, WALKS, len(starts)), np.uint8)
    at = np.tile(starts, (WALKS, 1))
    shift = np.arange(WALKS, dtype=np.uint8)[:, None]
    for step in range(steps):
        seen = np.take(padded, at, mode="clip")
        out[step + lead, :, :at.shape[1]] = seen
        move = np.take(_MOVES[step], seen, mode="clip")
        move >>= shift
        move &= 1
        at += move
        if step & 63 == 63:
            going = np.flatnonzero(seen.any(axis=0))
            if not len(going):
                break
            at = np.ascontiguousarray(at[:, :going[-1] + 1])
    # a walk writes no 0 before its end, so halving finds it
    low, high = np.zeros((WALKS, len(starts)), np.int64), np.full((WALKS, len(starts)), steps)
    walk, place = np.arange(WALKS)[:, None], np.arange(len(starts))
    while (low < high).any():
        middle = (low + high) // 2
        going = (out[np.minimum(middle, steps - 1) + lead, walk, place] > 0) & (low < high)
        low, high = np.where(going, middle + 1, low), np.where(going, high, np.minimum(high, middle))
    return out, low


def _batches(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Segments by falling length, as many as may be walked side by side."""
    order = np.argsort(-lengths, kind="stable")
    at = 0
    while at < len(order):
        end = at + max(1, WALKED_BYTES // (WALKS * min(STEPS, 3 * int(lengths[order[at]]) + 64)))
        yield order[at:end]
        at = end


def fingerprints(texts: list[str]) -> np.ndarray:
    """A row of bytes for each text: the level, the samples of each walk (0 after its end), and a 0; zeros for an empty text."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), neardup.SKETCH), np.uint8)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    classes = ((points * np.uint32(2654435761)) >> np.uint32(24)).astype(np.uint8)
    classes[classes == 0] = 1
    pieces = -(-sizes[full] // SEGMENT)
    owner = np.repeat(full, pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    lengths = np.minimum(sizes[owner] - number * SEGMENT, SEGMENT)
    ends = np.cumsum(lengths)
    padded = np.zeros(len(points) + len(owner), np.uint8)
    inside = np.ones(len(padded), bool)
    inside[ends + np.arange(len(owner))] = False
    padded[inside] = classes
    starts = ends - lengths + np.arange(len(owner))
    samples = np.zeros((len(texts), WALKS, SLOTS), np.uint8)
    levels = np.zeros(len(texts), np.int64)
    final = number == np.repeat(pieces, pieces) - 1
    # a text's last segment tells how many steps its walks take, and so its level
    for members in (np.flatnonzero(final), np.flatnonzero(~final)):
        for rows in _batches(lengths[members]):
            rows = members[rows]
            written, taken = _walk(padded, starts[rows], int(lengths[rows[0]]))
            steps = len(written) - TRAIL + 1
            if final[rows[0]]:
                levels[owner[rows]] = np.searchsorted(_REACH, number[rows] * STEPS + taken.max(axis=0))
            known, which = np.unique(levels[owner[rows]], return_inverse=True)
            step = np.stack([places(int(level)) for level in known])[which] - (number[rows] * STEPS)[:, None, None]
            row, walk, slot = np.nonzero((step >= 0) & (step < steps))
            at = step[row, walk, slot]
            total = np.zeros(len(at), np.uint32)
            for i in range(TRAIL):
                total += written[at + i, walk, row] * _WEIGHTS[i]
            total = (total ^ (total >> np.uint32(15))) * np.uint32(2246822519)
            symbol = 1 + (total >> np.uint32(16)) % np.uint32(255)
            samples[owner[rows[row]], walk, slot] = np.where(written[at + TRAIL - 1, walk, row] > 0, symbol, 0)
    out[:, 0] = levels
    out[:, 1:1 + WALKS * SLOTS] = samples.reshape(len(texts), -1)
    return out


def coarser(prints: np.ndarray) -> np.ndarray:
    """The same texts' fingerprints one level up."""
    out = np.zeros_like(prints)
    out[:, 0] = prints[:, 0] + 1
    samples = prints[:, 1:1 + WALKS * SLOTS].reshape(-1, WALKS, SLOTS)
    blocks = np.tile(np.arange(SLOTS // 2, dtype=np.int64), (WALKS, 1))
    for level in np.unique(out[:, 0]).tolist():
        rows = np.flatnonzero(out[:, 0] == level)
        taken = np.zeros((len(rows), WALKS, SLOTS), np.uint8)
        taken[:, :, :SLOTS // 2] = samples[rows][:, np.arange(WALKS)[:, None], 2 * blocks + _half(level, blocks)]
        out[rows, 1:1 + WALKS * SLOTS] = taken.reshape(len(rows), -1)
    return out


def agreement(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Likeness of the rows' non-empty texts; fingerprints of different levels are compared at the higher."""
    apart = left[:, 0].astype(int) - right[:, 0]
    while apart.any():
        left, right = left.copy(), right.copy()
        left[apart < 0], right[apart > 0] = coarser(left[apart < 0]), coarser(right[apart > 0])
        apart -= np.sign(apart)
    one, two = (side[:, 1:1 + WALKS * SLOTS].reshape(-1, WALKS, SLOTS) for side in (left, right))
    some = (one != 0) | (two != 0)
    share = ((one == two) & some).sum(axis=2) / np.maximum(1, some.sum(axis=2))
    return np.maximum(0, (share.max(axis=1, initial=0) - 1 / 255) / (1 - 1 / 255))


def likeness(left: np.ndarray, right: np.ndarray, left_empty: np.ndarray, right_empty: np.ndarray) -> np.ndarray:
    """0 to 1 for each row: the part of their walks' steps at which two texts agree, as their fingerprints tell it."""
    return np.where(left_empty | right_empty, (left_empty & right_empty).astype(float), agreement(left, right))


def band_keys(prints: np.ndarray, band: int = 4) -> list[list[int]]:
    """Distinct hashes of ``band`` samples that stand together, of each walk, at a text's own level and the next."""
    found = []
    for side in (prints, coarser(prints)):
        groups = side[:, 1:1 + WALKS * SLOTS].reshape(-1, WALKS, SLOTS)[:, :, :SLOTS // band * band].reshape(len(side), -1, band)
        place = np.arange(groups.shape[1], dtype=np.uint64) * np.uint64(64) + side[:, :1].astype(np.uint64)
        key = mixed(place)
        for i in range(band):
            key = mixed(key ^ groups[:, :, i])
        # a walk's first group stands for texts that are too short to fill one
        used = (groups != 0).sum(axis=2) >= band - 1
        used[:, ::SLOTS // band] |= groups[:, ::SLOTS // band, 0] != 0
        found.append((key.view(np.int64), used))
    keys, used = (np.concatenate(x, axis=1) for x in zip(*found, strict=True))
    return [np.unique(row[ok]).tolist() for row, ok in zip(keys, used, strict=True)]


def named(rows: np.ndarray, texts: list[str]) -> list[str]:
    """Fingerprints as hexadecimal strings, the empty text's as an empty string."""
    return [row.tobytes().hex() if text else "" for row, text in zip(rows, texts, strict=True)]


def fingerprinted(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with each whole text's fingerprint."""

    def compute(values: list[str | None]) -> list[list[str]]:
        texts = [value or "" for value in values]
        return [named(fingerprints(texts), texts)]

    return with_outputs(docs, text, f"`{out}` string", compute, size=SLICE)


def near_links(prints: DataFrame, doc_id: str, fingerprint: str, least: float, band: int) -> tuple[DataFrame, DataFrame]:
    """The distinct fingerprints of named documents (``node, id, sketch``; ``id`` the smallest that has it), and verified links (a, b) of nodes.

    Nodes are numbered by their smallest ids. Those whose fingerprints agree in a group of ``band`` samples are candidates. Each group has its
    smallest node as centre, each node meets the centre that it shares most groups with, and verified links give components; groups that still hold several components are compared in blocks across
    them. So every pair of candidates is either verified or already in one component, and no list of pairs of a group is made.
    """
    rows = prints.select(F.col(doc_id).alias("id"), F.col(fingerprint).alias("print")).where("id IS NOT NULL AND print <> ''")
    nodes = durable(rows.groupBy("print").agg(F.min("id").alias("id")).orderBy("id", "print")
                    .select(F.monotonically_increasing_id().alias("node"), "id", F.unhex("print").alias("sketch")))

    def keys(sketches: list[bytes]) -> list[list[list[int]]]:
        return [band_keys(np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1), band)]

    banded = durable(with_outputs(nodes.select("node", "sketch"), "sketch", "keys array<bigint>", keys, drop=["sketch"])
                     .select("node", F.explode("keys").alias("key")))
    centres = banded.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last")).where("centre <> last").select("key", "centre")
    keyed = durable(banded.join(centres, "key"))
    # one centre a node, the one it shares most groups with; what it shares with others is settled below, inside the groups that stay open
    met = keyed.where("centre <> node").repartition("node").groupBy("node", "centre").agg(F.count(F.lit(1)).alias("n"))
    stars = (met.groupBy(F.col("node").alias("b")).agg(F.max(F.struct("n", (-F.col("centre")).alias("near"))).alias("most"))
             .select((-F.col("most.near")).alias("a"), "b"))
    first = durable(alike(stars, nodes).where(F.col("likeness") >= least).select("a", "b"))

    def crossing(run: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(run[3], kind="stable")       # groups of the same nodes then give the same links
        low, high, block, node, component, sketch = (part[order] for part in run)
        left, right = neardup._sides(low[0], high[0], block)
        found = []
        for at in range(0, len(left), 64):
            part = left[at:at + 64]
            i, j = np.nonzero(component[part][:, None] != component[right])
            i, j = part[i], right[j]
            if left is right:
                i, j = i[i < j], j[i < j]
            ok = agreement(sketch[i], sketch[j]) >= least
            found.append((i[ok], j[ok]))
        a, b = neardup.joining(node, component, *(np.concatenate(x) for x in zip(*found, strict=True)))
        return np.minimum(a, b), np.maximum(a, b)

    later = neardup.over_open_keys(keyed.select("key", "node"), nodes, neardup.components(first), crossing)
    return nodes, durable(first.union(later))


def alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``a, b, likeness`` of pairs (a, b) of nodes, over all samples of both."""
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, neardup.SKETCH) for c in ("sketch_a", "sketch_b"))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(agreement(one, two))], names=["a", "b", "likeness"])

    return map_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "sketch_a", "sketch_b"), run, "a bigint, b bigint, likeness double")


def near_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = 0.75, band: int = 4) -> DataFrame:
    """``a, b, likeness``: links that hold the groups of documents together; equal fingerprints are linked to the smallest id that has them.

    Documents without an id or with an empty text are in no pair.
    """
    prints = durable(fingerprinted(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("body")), "body", "print").select("id", "print").distinct())
    nodes, links = near_links(prints, "id", "print", least, band)
    names = nodes.select("node", "id")
    between = (alike(links, nodes).join(names.toDF("a", "one"), "a").join(names.toDF("b", "two"), "b").where("one <> two")
               .select(F.least("one", "two").alias("a"), F.greatest("one", "two").alias("b"), "likeness"))
    within = (prints.where("id IS NOT NULL AND print <> ''").join(nodes.select(F.col("id").alias("a"), F.lower(F.hex("sketch")).alias("print")), "print")
              .where("id <> a").select("a", F.col("id").alias("b"), F.lit(1.0).alias("likeness")))
    return between.union(within)


def near_groups(prints: DataFrame, doc_id: str = "doc_id", fingerprint: str = "fingerprint", least: float = 0.75, band: int = 4) -> DataFrame:
    """``prints`` with ``component_id``, the smallest id that verified links lead to, and ``n_links``, the links found at the row's fingerprint.

    Rows of equal fingerprints are in one component without a link. ``component_id`` is NULL where the id is, and the row's own id for an empty text.
    """
    nodes, links = near_links(prints, doc_id, fingerprint, least, band)
    labels = neardup.components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("_links"))
    roots = nodes.select(F.col("node").alias("component"), F.col("id").alias("_root"))
    member = durable(nodes.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
                     .join(degree, "node", "left").join(roots, "component")
                     .select(F.lower(F.hex("sketch")).alias("_print"), "_root", "_links"))
    joined = prints.join(member, F.col(fingerprint) == F.col("_print"), "left")
    component = F.when(F.col(doc_id).isNotNull(), F.coalesce("_root", doc_id))
    return joined.select(*prints.columns, component.alias("component_id"), F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"))


def in_order(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``slice, seam, order_id, doc_id, body``: slices of falling ids, each followed by a copy (``seam`` 1) of the next slice's first row.

    The last slice is followed by the first row of all. One shuffle of the texts; the driver sees one id for each slice.
    """
    least = -(2**63)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("bigint"), F.lit(least)).alias("order_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("body"))
    width = shuffle_width(docs.sparkSession)
    cuts = rows.select("order_id").approxQuantile("order_id", [i / width for i in range(1, width)], 0.2 / width) if width > 1 else []
    splits = [-float("inf"), *sorted({0.0} if not cuts else set(cuts)), float("inf")]
    ranked = (Bucketizer(splits=splits, inputCol="_place", outputCol="_bucket")
              .transform(rows.withColumn("_place", F.col("order_id").cast("double")))
              .withColumn("slice", (F.lit(len(splits)) - F.col("_bucket")).cast("int")).drop("_place", "_bucket"))
    heads = sorted((row["slice"], row["head"]) for row in ranked.groupBy("slice").agg(F.max("order_id").alias("head")).collect())
    following = [(heads[(i + 1) % len(heads)][1], number) for i, (number, _) in enumerate(heads)]
    if not following:
        return ranked.withColumn("seam", F.lit(0))
    seams = docs.sparkSession.createDataFrame(following, "order_id bigint, to int")
    copies = rows.join(F.broadcast(seams), "order_id").withColumnRenamed("to", "slice").withColumn("seam", F.lit(1))
    return (ranked.withColumn("seam", F.lit(0)).unionByName(copies).repartition(width, "slice")
            .sortWithinPartitions("slice", "seam", F.desc("order_id"), "body"))


def edited_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text against a copy whose last third is taken from the start of the next document by falling id.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next`` per row.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                "near_edited double, near_next double")
    arrow = to_arrow_schema(schema)

    def made(ids: pa.Array, texts: list[str], following: list[str], edited: list[str], prints: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
        empty = [np.array([not t for t in x]) for x in (texts, edited, following)]
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array(named(prints[:-1], texts), pa.string()), pa.array(named(other, edited), pa.string()),
            pa.array(likeness(prints[:-1], other, empty[0], empty[1])), pa.array(likeness(prints[:-1], prints[1:], empty[0], empty[2]))], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, pa.Array, str, np.ndarray] | None = None      # the last row of the slice so far, waiting for the next
        done: set[int] = set()
        for batch in batches:
            for part in slices(batch, "body", SLICE):
                numbers, seam = (part.column(c).to_numpy(zero_copy_only=False) for c in ("slice", "seam"))
                bodies, ids = part.column("body").to_pylist(), part.column("doc_id")
                for number in np.unique(numbers).tolist():
                    here = np.flatnonzero(numbers == number)
                    copies = here[seam[here] == 1]
                    # rows that share the first id of the next slice come along; the first of them is the next row
                    here = here[seam[here] == 0]
                    if len(copies) and number not in done:
                        done.add(number)
                        here = np.append(here, copies[0])
                    if not len(here):
                        continue
                    texts, names = [bodies[i] for i in here], ids.take(pa.array(here))
                    before = held if held is not None and held[0] == number else None
                    if before:
                        texts, names = [before[2], *texts], pa.concat_arrays([before[1], names])
                    edited = [a[:len(a) - len(a) // 3] + b[:len(a) // 3] for a, b in zip(texts, texts[1:], strict=False)]
                    fresh = texts[1:] if before else texts
                    prints = fingerprints([*fresh, *edited])        # walked together
                    prints, other = prints[:len(fresh)], prints[len(fresh):]
                    if before:
                        prints = np.vstack([before[3], prints])
                    if edited:
                        yield made(names.slice(0, len(edited)), texts[:-1], texts[1:], edited, prints, other)
                    held = (number, names.slice(len(texts) - 1), texts[-1], prints[-1:])

    return map_batches(in_order(docs, doc_id, text).select("slice", "seam", "doc_id", "body"), run, schema)
