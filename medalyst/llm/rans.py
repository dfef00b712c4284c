"""Token ids in files: static range asymmetric numeral system (rANS) over independent, interleaved blocks.

One frequency table, counted over every id of the corpus, is shared by all blocks. A block holds whole documents; its ids are dealt over
lanes, and all lanes take one numpy step at a time. A block stores its lanes' states at a few checkpoints, so any part between two of
them decodes by itself, and a CRC-32 of its ids that is checked on reading. Files are Parquet with one block in a row: Spark commits,
splits and prunes them.

Defined cases: NULL text is empty and holds only the end id; documents are ordered by id, NULL first, equal ids by text; repeated rows are
documents like any others; an empty table gives empty files; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from medalyst.llm.arrow import map_batches, slices
from medalyst.llm.bpe import (
    BEYOND,
    BLANK,
    LETTER,
    NUMBER,
    OTHER,
    SPACE,
    ColumnCache,
    code_points,
    encode_column,
    is_space,
    laid_out,
    of_bytes,
    piece_starts,
    regrouped,
)
from medalyst.session import durable, shuffle_width, workspace

SCALE = 20                     # bits of the frequency table's total
LOW = np.uint64(1 << 31)       # a lane's state stays in [LOW, LOW << 32)
WORD = np.uint64(32)
MAX_LANES = 4096
CHECKPOINTS = 2
BLOCK_IDS = 1 << 20
CACHED_BYTES = 32 << 20       # of the pieces of texts whose ids a worker keeps
TOGETHER = 1 << 16            # bytes given to the library at once
KNOWN_CHARACTERS = 0x3000     # the characters below it are told apart here, as the library does
_HEAD = struct.Struct("<4sIIII")


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to ``2 ** SCALE``; what occurs gets 1 at least."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(len(counts), np.int64)
    freq = np.where(counts > 0, np.maximum(1, counts * (1 << SCALE) // total), 0)
    by_size = np.argsort(-freq, kind="stable")
    rest = (1 << SCALE) - int(freq.sum())
    if rest > 0:
        freq[by_size[0]] += rest
    for i in by_size:
        if rest >= 0:
            break
        give = min(-rest, int(freq[i]) - 1)
        freq[i] -= give
        rest += give
    return freq


class Coder:
    """Encodes and decodes blocks of ids by one frequency table."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq)

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = max(1, min(MAX_LANES, n // 64))
        steps = -(-n // lanes)
        every = max(1, -(-steps // CHECKPOINTS))
        state = np.full(lanes, LOW)
        words, marks, written = [], [], 0
        for step in range(steps - 1, -1, -1):
            part = ids[step * lanes:(step + 1) * lanes]
            freq, x = self.freq[part], state[:len(part)]
            full = x >= freq << np.uint64(63 - SCALE)
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            written += len(words[-1])
            x = np.where(full, x >> WORD, x)
            quotient = x // freq
            state[:len(part)] = (quotient << np.uint64(SCALE)) + (x - quotient * freq) + self.start[part]
            if step % every == 0:
                marks.append((written, state.copy()))
        marks.reverse()
        head = _HEAD.pack(b"RANS", n, lanes, every, len(marks))
        table = np.array([written - behind for behind, _ in marks], "<u4").tobytes()
        return b"".join([head, table, *[x.astype("<u8").tobytes() for _, x in marks], *[w.tobytes() for w in reversed(words)]])

    def decode(self, block: bytes, part: int | None = None) -> np.ndarray:
        """All ids of ``block``, or those between checkpoint ``part`` and the next one."""
        magic, n, lanes, every, marks = _HEAD.unpack_from(block)
        if magic != b"RANS":
            raise ValueError("not a block of this format")
        at = _HEAD.size
        offsets = np.frombuffer(block, "<u4", marks, at)
        states = np.frombuffer(block, "<u8", marks * lanes, at + 4 * marks).reshape(marks, lanes)
        words = np.frombuffer(block, "<u4", offset=at + 4 * marks + 8 * marks * lanes).astype(np.uint64)
        out = np.empty(n, np.uint32)
        mask = np.uint64((1 << SCALE) - 1)
        for mark in range(marks) if part is None else (part,):
            state, read = states[mark].astype(np.uint64), int(offsets[mark])
            for step in range(mark * every, min((mark + 1) * every, -(-n // lanes))):
                x = state[:min(lanes, n - step * lanes)]
                slot = x & mask
                found = self.symbol[slot]
                out[step * lanes:step * lanes + len(x)] = found
                x = self.freq[found] * (x >> np.uint64(SCALE)) + slot - self.start[found]
                low = np.flatnonzero(x < LOW)
                x[low] = (x[low] << WORD) | words[read:read + len(low)]
                read += len(low)
                state[:len(x)] = x
        return out if part is None else out[part * every * lanes:(part + 1) * every * lanes]


def character_kinds(tokenizer) -> np.ndarray:
    """The classes in which the library has the characters below ``KNOWN_CHARACTERS``, and ``BEYOND`` for all others."""
    split, likes = tokenizer.pre_tokenizer.pre_tokenize_str, {"a": LETTER, "1": NUMBER, "!": OTHER}
    kinds = [next((kind for like, kind in likes.items() if len(split(like + c)) == 1), SPACE) for c in map(chr, range(KNOWN_CHARACTERS))]
    return np.array([*kinds, BEYOND], np.uint8)


def byte_letters() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary; a space for 255, which UTF-8 never has."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = np.zeros(256, "<u2")
    out[visible] = visible
    hidden = np.setdiff1d(np.arange(256), visible)
    out[hidden] = 256 + np.arange(len(hidden))
    out[255] = ord(" ")
    return out


@lru_cache(maxsize=1)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs one task a core
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True              # their strings in a text are ordinary text
    kinds, letters = character_kinds(tokenizer), byte_letters()
    by_piece = Tokenizer(tokenizer.model)               # the same vocabulary and merges for pieces that are cut already
    by_piece.pre_tokenizer = CharDelimiterSplit(" ")

    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)         # a token's name has a character for each of its bytes
    for name, number in tokenizer.get_vocab().items():
        sizes[number] = len(name)

    def kinds_of(points: np.ndarray) -> np.ndarray:
        return kinds[np.minimum(points, KNOWN_CHARACTERS)]

    def dealt(library, strings: pa.Array, joined: Callable[[np.ndarray, np.ndarray], str]) -> pa.Array:
        """Ids of strings: many go to ``library`` as one text, whose ids are dealt out by the bytes they stand for."""
        found = [np.array(library.encode_batch_fast([joined(*laid_out(part.column("text")))], add_special_tokens=False)[0].ids, "<u4")
                 for part in slices(pa.record_batch([strings], ["text"]), "text", TOGETHER)]
        ids = np.concatenate([np.zeros(0, "<u4"), *found])
        return of_bytes(pa.binary(), 4 * np.searchsorted(np.cumsum(sizes[ids]), laid_out(strings)[1], "right"), ids)

    def encode_pieces(pieces: pa.Array) -> pa.Array:
        return dealt(by_piece, pieces, lambda data, bounds: letters[np.insert(data, bounds[1:-1], 255)].tobytes().decode("utf-16-le"))

    def encode_in_rows(whole: pa.Array) -> pa.Array:
        """Ids of units of a space and visible ends: a text made of them is cut between them."""
        return dealt(tokenizer, whole, lambda data, _: data.tobytes().decode())

    def encode_alone(whole: pa.Array) -> pa.Array:
        parts = slices(pa.record_batch([whole], ["text"]), "text", TOGETHER)
        return pa.array([np.array(x.ids, "<u4").tobytes() for part in parts
                         for x in tokenizer.encode_batch_fast(part.column("text").to_pylist(), add_special_tokens=False)], pa.binary())

    def encode_strings(strings: pa.Array) -> pa.Array:
        """Ids of pieces, and of whole units that have characters beyond those told apart here."""
        points, bounds = code_points(strings)
        way = (np.diff(np.concatenate([[0], np.cumsum(points >= KNOWN_CHARACTERS)])[bounds]) > 0).astype(np.int8)
        if not way.any():
            return encode_pieces(strings)
        space, first, last = is_space(points), bounds[:-1], bounds[1:] - 1
        way[(way > 0) & ((first == last) | (points[first] != BLANK) | space[np.minimum(first + 1, last)] | space[last])] = 2
        made = [encode(strings.filter(pa.array(way == i))) for i, encode in enumerate((encode_pieces, encode_in_rows, encode_alone))]
        place = np.empty(len(way), np.int64)
        place[np.argsort(way, kind="stable")] = np.arange(len(way))
        return pa.concat_arrays(made).take(pa.array(place))

    def encode_units(units: pa.Array, cache: ColumnCache) -> pa.Array:
        """Ids of each unit. They are cut into the library's pieces here, of which only those not seen lately go to the library."""
        points, bounds = code_points(units)
        starts = np.flatnonzero(piece_starts(points, kinds_of(points), bounds))
        data, _ = laid_out(units)
        places = np.flatnonzero((data & 0xC0) != 0x80)             # of the characters' first bytes
        pieces = of_bytes(pa.string(), np.append(places[starts], len(data)), data).dictionary_encode()
        return regrouped(cache.of(pieces.dictionary, encode_strings).take(pieces.indices), np.searchsorted(starts, bounds))

    return encode_units, ColumnCache(CACHED_BYTES)


def tokens(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``slice, doc_id, before, n, ids`` in id order, and one row for each slice with the counts of its ids (``before`` NULL).

    ``before`` counts the ids of earlier documents of the slice; a slice is one range of document ids, tokenised in one task.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    width = shuffle_width(docs.sparkSession)
    ranged = (source.repartitionByRange(width, F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
              .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
              .withColumn("slice", F.spark_partition_id()))
    kind = source.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"slice int, doc_id {kind}, before bigint, n int, ids binary")
    arrow = to_arrow_schema(schema)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_units, cache = _library(path)
        before, counts, number = 0, np.zeros(end_id + 1, np.int64), None
        for batch in batches:
            for part in slices(batch, "text"):
                ids = encode_column(part.column("text"), cache, encode_units, end)
                n = pc.binary_length(ids).to_numpy().astype(np.int64) // 4
                seen = np.bincount(np.frombuffer(ids.buffers()[2], "<u4"))
                counts = np.pad(counts, (0, max(0, len(seen) - len(counts))))
                counts[:len(seen)] += seen
                number = part.column("slice")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [part.column("slice"), part.column("doc_id"), pa.array(before + np.cumsum(n) - n), pa.array(n, pa.int32()), ids],
                    schema=arrow)
                before += int(n.sum())
        if number is not None:
            yield pa.RecordBatch.from_pylist([{"slice": number, "n": 0, "ids": counts.astype("<i8").tobytes()}], schema=arrow)

    return map_batches(ranged, run, schema)


def counted(laid: DataFrame) -> np.ndarray:
    """How often each id occurs; as many numbers as the vocabulary has ids."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in batch.column("ids").to_pylist():
                part = np.frombuffer(row, "<i8")
                total = np.pad(total, (0, max(0, len(part) - len(total))))
                total[:len(part)] += part
        yield pa.RecordBatch.from_arrays([pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["ids"])

    parts = laid.where(F.col("before").isNull()).select("ids")
    # sums of sums: as many rows as the square root of the number of slices reach the driver, each as long as the vocabulary
    few = max(1, int(np.sqrt(shuffle_width(laid.sparkSession))))
    rows = map_batches(parts.repartition(few), add, "ids binary").collect()
    out = np.zeros(max((len(row["ids"]) // 8 for row in rows), default=0), np.int64)
    for row in rows:
        part = np.frombuffer(row["ids"], "<i8")
        out[:len(part)] += part
    return out


def write(docs: DataFrame, vocabulary: str, out: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text",
          block_ids: int = BLOCK_IDS) -> np.ndarray:
    """Write the ids of all documents, each followed by ``end_id``, to files in ``out``; returns the shared frequency table.

    The table is also in ``out``/table, so the files can be read alone.
    """
    spark = docs.sparkSession
    laid = durable(tokens(docs, vocabulary, end_id, doc_id, text))
    freq = scaled(counted(laid))
    held = laid.where(F.col("before").isNotNull())
    # one row for each slice
    sizes = sorted((row["slice"], row["n"]) for row in held.groupBy("slice").agg(F.sum("n").alias("n")).collect())
    first, total = {}, 0
    for number, n in sizes:
        first[number], total = total, total + n
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(freq) if f], "id int, freq int").coalesce(1).write.parquet(f"{out}/table")
    kind = laid.schema["doc_id"].dataType.simpleString()
    schema = StructType.fromDDL(f"start bigint, doc_ids array<{kind}>, lengths array<int>, block binary, crc32 bigint")
    arrow = to_arrow_schema(schema)
    shared = spark.sparkContext.broadcast((freq, first))    # as large as the vocabulary and the number of slices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, starts = shared.value
        coder = Coder(table)
        held_ids, names, start, size, due = [], [], 0, 0, None

        def block() -> pa.RecordBatch:
            flat = b"".join(held_ids)
            row = {"start": start, "doc_ids": names, "lengths": [len(x) // 4 for x in held_ids],
                   "block": coder.encode(np.frombuffer(flat, "<u4")), "crc32": zlib.crc32(flat)}
            return pa.RecordBatch.from_pylist([row], schema=arrow)

        for batch in batches:
            for part in slices(batch, "ids"):
                for number, name, before, ids in zip(*[part.column(c).to_pylist() for c in ("slice", "doc_id", "before", "ids")], strict=True):
                    at = starts[number] + before
                    if held_ids and (size >= block_ids or at != due):
                        yield block()
                        held_ids, names, size = [], [], 0
                    if not held_ids:
                        start = at
                    held_ids.append(ids)
                    names.append(name)
                    size += len(ids) // 4
                    due = at + len(ids) // 4
        if held_ids:
            yield block()

    map_batches(held.select("slice", "doc_id", "before", "ids"), run, schema).write.parquet(f"{out}/blocks")
    return freq


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids`` of every document in the files below ``folder``; raises if a block's checksum differs."""
    table = spark.read.parquet(f"{folder}/table").collect()      # as large as the vocabulary
    freq = np.zeros(max((row["id"] for row in table), default=-1) + 1, np.int64)
    for row in table:
        freq[row["id"]] = row["freq"]
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    schema = StructType.fromDDL(f"doc_id {kind}, start bigint, ids binary")
    arrow = to_arrow_schema(schema)
    shared = spark.sparkContext.broadcast(freq)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for row in (part.slice(i, 1).to_pylist()[0] for part in slices(batch, "block") for i in range(part.num_rows)):
                flat = coder.decode(row["block"]).astype("<u4").tobytes()
                if zlib.crc32(flat) != row["crc32"]:
                    raise ValueError(f"checksum of the block at {row['start']} differs")
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                starts = ends - np.array(row["lengths"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], arrow.field("doc_id").type), pa.array(row["start"] + starts),
                     pa.array([flat[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())], schema=arrow)

    return map_batches(blocks, run, schema)


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write ``docs`` as token files in the shared folder and read them back: ``doc_id, start, ids``."""
    spark = docs.sparkSession
    folder = workspace(spark, "tokens")
    write(docs, vocabulary, folder, end_id, doc_id, text)
    return read(spark, folder)
