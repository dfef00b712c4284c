"""The quality network: held-out accuracy, whole-text scoring and odd tables."""

import random
import zlib

import numpy as np

from medalyst.llm import quality_cnn
from tests.llm.conftest import words


def corpus(n):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        text = words(i, rng.randint(20, 120))
        if not good:
            line = text.split()
            at = rng.randint(0, len(line) - 1)
            line[at:at] = [f"{w}$$$" for w in line[:12]]
            text = " ".join(line)
        rows.append((i, text, "en", "a"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy(spark, make_docs):
    rows, labels = corpus(400)
    found = quality_cnn.classified(make_docs(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    wanted = dict((i, q) for i, q, _ in labels)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r["held_out"]]
    assert len(held) > 40 and np.mean([r["predicted"] == wanted[r["doc_id"]] for r in held]) >= 0.9
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)


def test_every_byte_is_read():
    net = quality_cnn.Network.fresh()
    text = words(3, 3000).encode()
    small = quality_cnn.PART
    try:
        quality_cnn.PART = 64
        parts = net.pooled([text, b"", b"short", text[:63], text[:64], text[:65]])
    finally:
        quality_cnn.PART = small
    assert np.allclose(parts, net.pooled([text, b"", b"short", text[:63], text[:64], text[:65]]), atol=1e-5)
    blocks, _ = quality_cnn.padded([text])
    brute = max(float(net.vectors[blocks[i:i + 2].ravel()].ravel() @ np.concatenate([net.filters[:, 0], net.filters[:, quality_cnn.FILTERS]]))
                for i in range(len(blocks) - 1))
    assert abs(net.pooled([text])[0, 0] - brute) < 1e-4


def test_gradients_match_differences():
    net = quality_cnn.Network.fresh(3)
    texts, labels, weights = [b"some text here", b"another !!! text with more bytes", b"third"], np.array([1.0, 0, 1]), np.array([1.0, 2, 1])

    def loss():
        p = net.scores(net.pooled(texts))
        return -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / weights.sum()

    grads = quality_cnn._gradients(net, texts, labels, weights)
    rng = np.random.default_rng(0)
    for value, grad in zip((net.vectors, net.filters, net.offsets, net.weights), grads, strict=False):
        for at in rng.choice(value.size, 12, replace=False):
            if value is net.vectors and at < quality_cnn.DIMS:
                continue
            old = value.flat[at]
            value.flat[at] = old + 1e-2
            up = loss()
            value.flat[at] = old - 1e-2
            down = loss()
            value.flat[at] = old
            assert abs((up - down) / 2e-2 - grad.flat[at]) < 5e-3


def test_odd_rows_and_labels(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 0), (8, None, 0), (999, 1, 0), (12, 1, 0), (12, 0, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    found = quality_cnn.classified(odd_docs, labels).collect()
    assert len(found) == len(odd_rows)
    by_text = {}
    for r, (_, text, *_) in zip(sorted(found, key=str), sorted(odd_rows, key=str), strict=True):
        by_text.setdefault(text, set()).add(r["score"] is not None)
    assert all(v == {True} for v in by_text.values())
    none = spark.createDataFrame([], labels.schema)
    assert {r["score"] for r in quality_cnn.classified(odd_docs, none).collect()} == {0.5}
    assert quality_cnn.classified(no_docs, labels).collect() == []
    kept = quality_cnn.accepted(odd_docs, none)
    assert kept.columns == odd_docs.columns and kept.count() == len(odd_rows)
