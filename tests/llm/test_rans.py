"""Token files: exact round trips, checkpoints, checksums and the library's own ids."""

import random
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from medalyst.llm import bpe, rans
from medalyst.session import workspace

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def library_ids(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [0, 1, 63, 64, 129, 5000, 70_000])
def test_block_round_trip_and_checkpoints(n):
    ids = (np.random.default_rng(n).zipf(1.4, n) % 1000).astype(np.uint32)
    coder = rans.Coder(rans.scaled(np.bincount(ids, minlength=1000) + 1))
    block = coder.encode(ids)
    assert (coder.decode(block) == ids).all()
    marks = rans._HEAD.unpack_from(block)[4]
    if n:
        assert (np.concatenate([coder.decode(block, part) for part in range(marks)]) == ids).all()


def test_frequencies_keep_rare_ids():
    freq = rans.scaled(np.array([10**12, 1, 0, 1]))
    assert freq.sum() == 1 << rans.SCALE and (freq > 0).tolist() == [True, True, False, True]
    assert rans.scaled(np.zeros(3, np.int64)).sum() == 0
    many = rans.scaled(np.ones(50_000, np.int64))
    assert many.sum() == 1 << rans.SCALE and many.min() >= 1


def test_skewed_input_is_compressed():
    ids = np.zeros(100_000, np.uint32)
    ids[::100] = 7
    assert len(rans.Coder(rans.scaled(np.bincount(ids))).encode(ids)) < 100_000


def test_odd_rows(spark, odd_docs, odd_rows):
    found = rans.round_trip(odd_docs, VOCABULARY).collect()
    wanted = sorted(((i is not None, i or 0, zlib.crc32(np.array([*library_ids(t or ""), 2], "<u4").tobytes())) for i, t, *_ in odd_rows))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, zlib.crc32(r["ids"])) for r in found) == wanted
    placed = sorted((r["start"], len(r["ids"]) // 4, r["doc_id"]) for r in found)
    assert [start for start, *_ in placed] == [sum(n for _, n, _ in placed[:i]) for i in range(len(placed))]
    ids = [-1 if i is None else i for *_, i in placed]
    assert ids == sorted(ids)


def test_columns_of_any_characters_have_the_ids_of_the_library():
    rng = random.Random(5)
    marks = [*map(chr, range(0x250)), *" \n\t\r'" * 60, *"abcXY12.,;'stremvld" * 12, *map(chr, range(0x250, 0x3100, 7)), *"\u65e5\u672c\U0001f600\uffff\u2028\u3000\x85\x1c"]
    texts = ["".join(rng.choices(marks, k=rng.randrange(60))) for _ in range(5000)]
    texts += ["", " ", "  ", "a ", " a", "a  b", "a \n b", "\n a", "a\n a", "<|endoftext|> x", "it's we'll I'VE 's ''s x's's", "word" * 5000]
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    wanted = [[*x.ids, 2] for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    encode_units, cache = rans._library(VOCABULARY)
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["before", *texts], kind).slice(1)
        found = bpe.encode_column(column, cache, encode_units, np.array([2], "<u4").tobytes())
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found.to_pylist()] == wanted
    assert bpe.encode_column(pa.array([], pa.string()), cache, encode_units).to_pylist() == []


def test_a_worker_keeps_no_object_for_each_unit():
    encode_units, cache = rans._library(VOCABULARY)
    texts = ["".join(f" kept{i}x{n}" for i in range(10_000)) for n in range(3)]
    column = pa.array(texts)
    bpe.encode_column(pa.array(["warm up"]), cache, encode_units)
    before = sys.getallocatedblocks()
    found = bpe.encode_column(column, cache, encode_units)
    assert sys.getallocatedblocks() - before < 5000
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found.to_pylist()] == list(map(library_ids, texts))


def test_ids_are_right_when_the_cache_is_full():
    encode_units, _ = rans._library(VOCABULARY)
    cache = bpe.ColumnCache(2000)
    for n in range(30):
        texts = [f"a text of column {n} \u65e5\u672c{i} we'll" for i in range(n)] + ["", "the same"]
        found = bpe.encode_column(pa.array([" ".join(texts)]), cache, encode_units)
        assert bpe.encode_column(pa.array([" ".join(texts)]), bpe.ColumnCache(), encode_units).equals(found)
        assert cache.strings.nbytes + cache.ids.nbytes <= 4000
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found.to_pylist()] == [library_ids(" ".join(texts))]


def test_many_blocks_and_a_spoiled_one(spark, make_docs):
    docs = make_docs([(i, f"text number {i} " * (i % 5 + 1), "en", "a") for i in range(60)])
    folder = workspace(spark, "tokens")
    rans.write(docs, VOCABULARY, folder, block_ids=40)
    assert spark.read.parquet(f"{folder}/blocks").count() > 10
    found = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in rans.read(spark, folder).collect()}
    assert found == {i: [*library_ids(f"text number {i} " * (i % 5 + 1)), 2] for i in range(60)}
    spoiled = workspace(spark, "tokens")
    spark.read.parquet(f"{folder}/table").write.parquet(f"{spoiled}/table")
    spark.read.parquet(f"{folder}/blocks").selectExpr("start", "doc_ids", "lengths", "block", "crc32 + 1 AS crc32").write.parquet(f"{spoiled}/blocks")
    with pytest.raises(Exception, match="checksum"):
        rans.read(spark, spoiled).collect()


def test_empty_table(no_docs):
    assert rans.round_trip(no_docs, VOCABULARY).collect() == []
