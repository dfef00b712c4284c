"""Quality classifier: a byte-level convolutional network in numpy.

Each byte has a learned vector. Filters look at chunks of ``2 * STRIDE`` bytes that start every ``STRIDE`` bytes, so chunks overlap by half and
cover the whole text; each filter's largest answer over all chunks goes through a rectifier, and a weighted sum of those gives one probability.

The network learns from at most ``sample`` labelled texts of each class, taken by the hash of their ids (the documented bound of the fit); the classes
are weighted by how often they occur in all labels. Scoring reads every byte of every text.

Defined cases: NULL text counts as empty; an empty text has one chunk of padding; labels that are NULL, contradict each other or name no document are left
out; without labels of both classes every score is the share of label 1 (0.5 without any); repeated rows give repeated results; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.llm.arrow import with_outputs

STRIDE, DIMS, FILTERS = 8, 8, 32
PART = 1 << 19                 # bytes of text in one matrix


@dataclass
class Network:
    """Byte vectors, filters (first and second half of a chunk side by side), their offsets, output weights and offset."""

    vectors: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def fresh(cls, seed: int = 1) -> Network:
        rng = np.random.Generator(np.random.PCG64(seed))
        vectors = rng.normal(0, 0.5, (256, DIMS)).astype(np.float32)
        vectors[0] = 0
        filters = rng.normal(0, 1 / np.sqrt(2 * STRIDE * DIMS), (STRIDE * DIMS, 2 * FILTERS)).astype(np.float32)
        return cls(vectors, filters, np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, FILTERS).astype(np.float32), 0.0)

    def answers(self, blocks: np.ndarray) -> np.ndarray:
        """Answers of all filters to the chunks that start at each block (the last block has no chunk)."""
        halves = self.vectors[blocks].reshape(len(blocks), STRIDE * DIMS) @ self.filters
        return halves[:-1, :FILTERS] + halves[1:, FILTERS:]

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Each filter's largest answer over the whole of each text."""
        out = np.full((len(texts), FILTERS), -np.inf, np.float32)
        batch, owners, size = [], [], 0
        for i, text in enumerate(texts):
            for at in range(0, max(1, len(text)), PART):
                batch.append(text[at:at + PART + STRIDE])
                owners.append(i)
                size += len(batch[-1])
                if size >= PART:
                    np.maximum.at(out, owners, self._largest(batch))
                    batch, owners, size = [], [], 0
        if batch:
            np.maximum.at(out, owners, self._largest(batch))
        return out

    def _largest(self, texts: list[bytes]) -> np.ndarray:
        blocks, starts = padded(texts)
        ends = np.append(starts[1:], len(blocks)) - 1                  # the empty block after each text
        answers = np.vstack([self.answers(blocks), np.zeros((1, FILTERS), np.float32)])
        return np.maximum.reduceat(answers, np.stack([starts, ends], axis=1).ravel())[::2]

    def scores(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum(pooled + self.offsets, 0)
        return 1 / (1 + np.exp(-(hidden.astype(np.float64) @ self.weights.astype(np.float64) + self.bias)))


def padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in blocks of ``STRIDE`` bytes, each followed by an empty block, and the first block of each."""
    sizes = [max(1, -(-len(text) // STRIDE)) + 1 for text in texts]
    joined = b"".join([text.ljust(n * STRIDE, b"\0") for text, n in zip(texts, sizes, strict=True)])
    return np.frombuffer(joined, np.uint8).reshape(-1, STRIDE), np.cumsum([0, *sizes[:-1]])


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, steps: int = 800, batch: int = 64, rate: float = 0.01) -> Network:
    """Fit by Adam on weighted log loss; the gradient of a filter flows to the chunk of its largest answer."""
    net = Network.fresh()
    rng = np.random.Generator(np.random.PCG64(2))
    values = [net.vectors, net.filters, net.offsets, net.weights, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    order = np.empty(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(texts)):
            order = np.concatenate([order, rng.permutation(len(texts))])
        rows, order = order[:batch], order[batch:]
        net.bias = float(values[4][0])
        grads = _gradients(net, [texts[i] for i in rows], labels[rows], weights[rows])
        speed = rate * (1 - (step - 1) / steps)
        for v, g, m, s in zip(values, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            v -= speed * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        net.vectors[0] = 0
    net.bias = float(values[4][0])
    return net


def _gradients(net: Network, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    blocks, starts = padded(texts)
    answers = net.answers(blocks)
    ends = np.append(starts[1:], len(blocks)) - 1
    where = np.stack([a + answers[a:b].argmax(axis=0) for a, b in zip(starts, ends, strict=True)])
    pooled = np.take_along_axis(answers, where, axis=0)
    active = pooled + net.offsets
    hidden = np.maximum(active, 0)
    off = ((net.scores(pooled) - labels) * weights / weights.sum()).astype(np.float32)
    back = off[:, None] * net.weights * (active > 0)
    chunks = np.concatenate([blocks[where], blocks[where + 1]], axis=2)                   # text, filter, byte
    vectors = net.vectors[chunks].reshape(*where.shape, -1)
    by_filter = np.einsum("bf,bfd->df", back, vectors, optimize=True)
    filters = np.concatenate([by_filter[:STRIDE * DIMS], by_filter[STRIDE * DIMS:]], axis=1)
    full = np.concatenate([net.filters[:, :FILTERS], net.filters[:, FILTERS:]], axis=0)  # chunk dims, filter
    to_bytes = (back[:, :, None] * full.T[None]).reshape(-1, DIMS)
    vectors_grad = np.stack([np.bincount(chunks.ravel(), to_bytes[:, d], 256) for d in range(DIMS)], axis=1).astype(np.float32)
    return [vectors_grad, filters, back.sum(axis=0), hidden.T @ off, np.array([off.sum()], np.float32)]


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample: int = 1000, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Network | float:
    """A network, or the share of label 1 where there is nothing to tell apart."""
    usable = (labels.where(~held_out(doc_id) & F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_id"))
              .agg(F.min(label).alias("_low"), F.max(label).alias("_label")).where("_low = _label").select("_id", "_label"))
    shares = {row["_label"]: row["n"] for row in usable.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        return float(next(iter(shares), 0.5))
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    held = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    # at most 2 * sample rows
    rows = held.join(F.broadcast(chosen), "_id").orderBy("_id", "_text").collect()
    targets = np.array([row["_label"] for row in rows], np.float64)
    if len(set(targets.tolist())) < 2:
        return float(shares.get(1, 0)) / sum(shares.values())
    weights = np.where(targets == 1, shares[1] / (targets == 1).sum(), shares[0] / (targets == 0).sum())
    return train([row["_text"].encode() for row in rows], targets, weights * len(rows) / sum(shares.values()))


def score(docs: DataFrame, model: Network | float, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``out``."""
    if isinstance(model, float):
        return docs.withColumn(out, F.lit(model))

    def run(texts: list[str | None]) -> list[np.ndarray]:
        return [model.scores(model.pooled([(text or "").encode() for text in texts]))]

    return with_outputs(docs, text, f"`{out}` double", run)


def classified(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3,
               sample: int = 1000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row."""
    model = fit(docs, labels, sample, doc_id, text)
    scored = score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3,
             sample: int = 1000) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their own columns."""
    model = fit(docs, labels, sample, doc_id, text)
    return score(docs, model, text, "_quality_score").where(F.col("_quality_score") >= threshold).select(*docs.columns)
