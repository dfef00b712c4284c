"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from medalyst.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ALPHABET = " \n\t  'sabAZé漢字½²٣𝔘\x1c\x85\r\x0b!?_—🎉👍🏽ñ'll 're123"


@pytest.fixture(scope="module")
def library():
    ranks = bpe.vocabulary(PATH, public_tokenizers.PATTERN).ranks
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def test_random_texts(library):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["a" * 3000, "the" * 1000, " " * 2000, "!?" * 1000, "<|endoftext|> x", "ab   cd", "a \n b", "a\n ", " "]
    coder = bpe.vocabulary(PATH, public_tokenizers.PATTERN)
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        assert ids == as_bytes(library.encode_ordinary(text)), repr(text)
        assert coder.decode(ids) == text.encode()


def test_cache_bound_changes_nothing(library):
    texts = [f"word{i} other{i % 7}" for i in range(50)]
    coder = bpe.vocabulary(PATH, public_tokenizers.PATTERN)
    cache = bpe.UnitCache(limit=2000)
    found = [bpe.encode_cached([text], cache, coder.encode_units)[0] for text in texts]
    assert found == [as_bytes(library.encode_ordinary(text)) for text in texts]
    assert len(cache.young) + len(cache.old) < 20


def test_pair_table_collisions():
    pairs = {(a, b): a * 31 + b for a in range(40) for b in range(40)}
    table = bpe.PairTable(pairs)
    left, right = np.repeat(np.arange(-1, 41, dtype=np.int32), 42), np.tile(np.arange(-1, 41, dtype=np.int32), 42)
    wanted = [pairs.get((int(a), int(b)), int(bpe.NO_PAIR)) for a, b in zip(left, right, strict=True)]
    assert table(left, right).tolist() == wanted


def test_odd_rows(odd_docs, odd_rows, library):
    both = bpe.decode(bpe.encode(odd_docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert both.columns == ["doc_id", "ids", "decoded"]
    found = sorted((str(r["doc_id"]), hashlib.sha256(r["ids"]).hexdigest(), bytes(r["decoded"])) for r in both.collect())
    wanted = sorted((str(i), hashlib.sha256(as_bytes(library.encode_ordinary(t or ""))).hexdigest(), (t or "").encode()) for i, t, *_ in odd_rows)
    assert found == wanted


def test_empty_table(no_docs):
    assert bpe.encode(no_docs, PATH, public_tokenizers.PATTERN).collect() == []
