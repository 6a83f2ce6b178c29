"""Quality classifier: a byte-level convolutional network in numpy.

A whole document is cut into overlapping chunks. Learned filters run over the embedded bytes of
every chunk, their outputs are max-pooled inside the chunk, and the mean of the pooled features
over all chunks gives one probability through a logistic unit. The mean keeps long documents
comparable with short ones. The network is fitted on a bounded sample of labelled documents and
is a few kilobytes; texts of a batch are laid end to end and go through in blocks of fixed size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from coursewise.llm.common import hash_sample, held_out, map_texts, texts_as_bytes
from coursewise.sources.staging import staged

WIDTH, STRIDE, EMBED, FILTERS = 12, 4, 4, 32
HOP = 256  # a chunk is two hops
STEPS = HOP // STRIDE
TAIL = math.ceil(WIDTH / STRIDE) - 1  # positions at a document's end that read beyond it
BLOCK_HOPS = 256
TRAIN_ROWS = 1_500  # of each class
TRAIN_BYTES = 16_384  # longer documents aren't used for fitting
EPOCHS, BATCH, RATE = 10, 32, 0.01


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.weights]


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts end to end, each padded with zeros to hops (two at least), and hops of each."""
    hops = np.array([max(2, math.ceil((len(t) + WIDTH) / HOP)) for t in texts], np.int64)
    data = np.zeros(int(hops.sum()) * HOP + WIDTH, np.uint8)
    at = 0
    for text, n in zip(texts, hops.tolist(), strict=True):
        data[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += n * HOP
    return data, hops


def hop_maxima(net: Network, data: np.ndarray, hops: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """The filters' maxima in every hop, and on request the positions they come from."""
    total = int(hops.sum())
    ends = np.zeros(total, bool)
    ends[np.cumsum(hops) - 1] = True
    best = np.empty((total, FILTERS), np.float32)
    at = np.empty((total, FILTERS), np.int64) if where else None
    for h in range(0, total, BLOCK_HOPS):
        n = min(BLOCK_HOPS, total - h)
        seen = net.embed[data[h * HOP : (h + n) * HOP + WIDTH]]
        patches = np.lib.stride_tricks.sliding_window_view(seen, WIDTH, axis=0)[: n * HOP : STRIDE]
        out = (patches.transpose(0, 2, 1).reshape(n * STEPS, -1) @ net.filters).reshape(n, STEPS, FILTERS)
        out[ends[h : h + n], STEPS - TAIL :] = -np.inf
        if where:
            at[h : h + n] = (h + np.arange(n))[:, None] * STEPS + out.argmax(1)
        best[h : h + n] = out.max(1)
    return best, at


def chunk_hops(hops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first hop of every chunk, and the document of every chunk."""
    doc = np.repeat(np.arange(len(hops)), hops)
    first = np.flatnonzero(doc[:-1] == doc[1:])
    return first, doc[first]


def features(net: Network, data: np.ndarray, hops: np.ndarray) -> np.ndarray:
    best, _ = hop_maxima(net, data, hops)
    first, doc = chunk_hops(hops)
    pooled = np.maximum(np.maximum(best[first], best[first + 1]) + net.bias, 0)
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    return np.add.reduceat(pooled, starts, axis=0, dtype=np.float64) / (hops - 1)[:, None]


def probabilities(net: Network, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    return 1 / (1 + np.exp(-(features(net, *laid_out(texts)) @ net.weights + net.offset)))


def fit_network(texts: list[bytes], labels: np.ndarray, seed: int = 1, epochs: int = EPOCHS) -> Network:
    """Adam on the logistic loss; without labels of both classes the score is their clipped share."""
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 1, (256, EMBED)).astype(np.float32),
        rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(FILTERS),
        0.0,
    )
    if not len(labels) or labels.min() == labels.max():
        share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
        net.offset = float(np.log(share / (1 - share)))
        return net
    net.weights = rng.normal(0, 0.3, FILTERS)
    momenta = [(np.zeros(x.shape), np.zeros(x.shape)) for x in [*net.arrays(), np.zeros(1)]]
    step = 0
    taps = np.arange(WIDTH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for k in range(0, len(order), BATCH):
            rows = order[k : k + BATCH]
            data, hops = laid_out([texts[i] for i in rows])
            best, at = hop_maxima(net, data, hops, True)
            first, doc = chunk_hops(hops)
            later = best[first + 1] > best[first]
            raw = np.where(later, best[first + 1], best[first]) + net.bias
            source = np.where(later, at[first + 1], at[first])
            pooled = np.maximum(raw, 0)
            starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
            mean = np.add.reduceat(pooled, starts, axis=0, dtype=np.float64) / (hops - 1)[:, None]
            p = 1 / (1 + np.exp(-(mean @ net.weights + net.offset)))
            error = (p - labels[rows]) / len(rows)
            g = (error / (hops - 1))[doc][:, None] * net.weights * (raw > 0)  # chunk x filter
            seen = data[(source * STRIDE)[:, :, None] + taps]  # chunk x filter x tap
            patch = net.embed[seen].reshape(len(g), FILTERS, -1)
            d_filters = np.einsum("cf,cfk->kf", g, patch, optimize=True)
            spread = (g[:, :, None] * net.filters.T).reshape(-1, EMBED)
            d_embed = np.stack([np.bincount(seen.ravel(), spread[:, e], 256) for e in range(EMBED)], 1)
            grads = [d_embed, d_filters, g.sum(0), mean.T @ error, np.array([error.sum()])]
            step += 1
            offset = np.array([net.offset])
            for x, d, (m, v) in zip([*net.arrays(), offset], grads, momenta, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            net.offset = float(offset[0])
    return net


def fit_quality(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, train_bytes: int = TRAIN_BYTES) -> Network:
    """Fit on at most ``train_rows`` different rows of either class that are not held out.

    The bound on the driver is train_rows * 2 documents of at most ``train_bytes`` bytes.
    """
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("label"))
    usable = docs.where(~held_out(F.col("doc_id")) & (F.octet_length("text") <= train_bytes)).select("doc_id", "text")
    hashed = usable.withColumn("text_hash", F.xxhash64("doc_id", "text"))
    keys = staged(hashed.select("doc_id", "text_hash").join(known, "doc_id").select("label", "text_hash"), "training-keys")
    sample = F.broadcast(hash_sample(keys, train_rows, "label"))  # 2 * train_rows rows at most; only their texts are moved
    picked = hashed.join(sample, "text_hash").groupBy("label", "text_hash").agg(F.min("text").alias("text"))
    rows = sorted((r["label"], r["text"]) for r in picked.toLocalIterator())
    return fit_network([t.encode() for _, t in rows], np.array([x for x, _ in rows], float))


def quality_scores(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """One row per document: doc_id, held_out, score (higher: good likelier), predicted.

    Null texts count as empty, and an empty text has a score like any other. Repeated rows score
    alike. Without labels of both classes, all scores are the clipped share of label 1.
    """
    net = fit_quality(docs, labels, **settings)

    def build(batch: pa.RecordBatch) -> dict:
        texts = texts_as_bytes(batch)
        scores = np.concatenate([probabilities(net, part) for part in slices(texts)])
        return {"doc_id": batch.column("doc_id"), "score": pa.array(scores), "predicted": pa.array((scores >= 0.5).astype(np.int32))}

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = map_texts(docs.select("doc_id", "text"), f"doc_id {kind}, score double, predicted int", build)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def slices(texts: list[bytes], most: int = 1 << 22) -> Iterator[list[bytes]]:
    """The texts in order, in lists of about ``most`` bytes."""
    own, size = [], 0
    for text in texts:
        own.append(text)
        size += len(text)
        if size >= most:
            yield own
            own, size = [], 0
    if own:
        yield own
