"""Quality classifier on random-indexing word vectors.

Each word (a hash bucket of words) has a fixed sparse random index vector. Its context vector is the
sum of the index vectors of the words around it, over all documents of the corpus; its word vector
is the context vector scaled to length one, plus its own index vector. A document is pooled to the mean
of its word vectors, and the mean of the products of neighbouring words' index vectors, which grows where
words repeat. A network of two layers, trained here in numpy, scores the pooled vector; the
temperature of its logit is calibrated on rows that it was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataframe.llm.common import run_hashes, text_steps, token_runs, written

BUCKET_BITS, DIM, NONZERO, REACH = 15, 48, 4, 2
#: Buckets that travel together.
BLOCK = 64
HIDDEN, EPOCHS, STEPS, BATCH, RATE, DECAY = 32, 30, 2000, 64, 0.003, 1e-4
#: Labelled rows of each class that the network is fitted on, by hash order of the id; every so many of them calibrate.
TRAIN_ROWS, CALIBRATION = 6000, 5
STEP_BYTES = 2 << 20

#: Classes of bytes: white space 0, letters and digits 1, other characters 2.
_CLASSES = np.full(256, 2, np.uint8)
_CLASSES[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = 1
_CLASSES[[9, 10, 11, 12, 13, 32]] = 0


def index_vectors(seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(places, signs) of the nonzero components of each bucket's index vector."""
    rng = np.random.default_rng(seed)
    n = 1 << BUCKET_BITS
    places = rng.permuted(np.tile(np.arange(DIM), (n, 1)), axis=1)[:, :NONZERO]
    return places, rng.choice(np.array([-1, 1]), (n, NONZERO))


def buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of the words and runs of other characters of each text."""
    start, end, text, _ = token_runs(raw, offsets, _CLASSES)
    return (run_hashes(raw, start, end - start) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), text


def add_contexts(sums: np.ndarray, bucket: np.ndarray, text: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> None:
    """Add the index vectors of the words within REACH, of the same text, to each word's sum."""
    places, signs = index
    for d in range(1, REACH + 1):
        near = text[d:] == text[:-d]
        a, b = bucket[:-d][near], bucket[d:][near]
        flat = np.concatenate([(a[:, None] * DIM + places[b]).ravel(), (b[:, None] * DIM + places[a]).ravel()])
        weight = np.concatenate([signs[b].ravel(), signs[a].ravel()])
        sums += np.bincount(flat, weight, sums.size).reshape(sums.shape)


def dense_index(index: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    out = np.zeros((1 << BUCKET_BITS, DIM), np.float32)
    np.put_along_axis(out, index[0], index[1].astype(np.float32), 1)
    return out / np.sqrt(NONZERO)


def word_vectors(sums: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    length = np.linalg.norm(sums, axis=1, keepdims=True)
    return (sums / np.maximum(length, 1)).astype(np.float32) + dense_index(index)


def pool(texts: pa.Array, vectors: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The pooled vector of each text; zeros for a text without words."""
    out = np.zeros((len(texts), 2 * DIM), np.float32)
    for a, _, part, offsets in text_steps(texts, STEP_BYTES // 4):
        bucket, text = buckets(part, offsets)
        if not len(bucket):
            continue
        used, first = np.unique(text, return_index=True)
        for t, own in zip((a + used).tolist(), np.split(bucket, first[1:]), strict=True):
            out[t, :DIM] = vectors[own].sum(0) / len(own)
            rows = index[own]
            out[t, DIM:] = np.einsum("ij,ij->j", rows[1:], rows[:-1]) / len(own)
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x).astype(float) / self.temperature, -500, 500)))


def fit(x: np.ndarray, label: np.ndarray, seed: int = 0) -> Network:
    """A network for rows x with labels 0 and 1; classes count alike. Without rows of both, it scores their share."""
    rng = np.random.default_rng(seed)
    n, d = len(x), 2 * DIM
    tune = np.zeros(n, bool)
    tune[rng.permutation(n)[:n // CALIBRATION]] = True
    learn, label = np.flatnonzero(~tune), label.astype(np.float32)
    mean, scale = (x[learn].mean(0), x[learn].std(0) + 1e-3) if len(learn) else (np.zeros(d), np.ones(d))
    net = Network(mean, scale, rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)).astype(np.float32), np.zeros(HIDDEN, np.float32), np.zeros(HIDDEN, np.float32), 0.0)
    if not len(learn) or len(np.unique(label[learn])) < 2:
        share = (label.sum() + 0.5) / (n + 1)
        net.b2 = float(np.log(share / (1 - share)))
        return net
    net.w2 = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN).astype(np.float32)
    z = ((x - mean) / scale).astype(np.float32)
    weight = np.where(label == 1, 0.5 / label[learn].mean(), 0.5 / (1 - label[learn].mean())).astype(np.float32)
    values = [net.w1, net.b1, net.w2, np.zeros(1, np.float32)]
    first, second, t = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // len(learn)))):
        for part in np.array_split(rng.permutation(learn), max(1, len(learn) // BATCH)):
            hidden = np.tanh(z[part] @ values[0] + values[1])
            error = (1 / (1 + np.exp(-(hidden @ values[2] + values[3]))) - label[part]) * weight[part] / len(part)
            back = error[:, None] * values[2] * (1 - hidden * hidden)
            grads = [z[part].T @ back + DECAY * values[0], back.sum(0), hidden.T @ error + DECAY * values[2], error.sum(keepdims=True)]
            t += 1
            for k, g in enumerate(grads):  # Adam
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                values[k] -= RATE * (first[k] / (1 - 0.9 ** t)) / (np.sqrt(second[k] / (1 - 0.999 ** t)) + 1e-8)
    net.b2 = float(values[3][0])
    if tune.any():
        logit, w, one = net.logits(x[tune]).astype(float), weight[tune], label[tune] == 1
        truth = np.where(one, (one.sum() + 1) / (one.sum() + 2), 1 / ((~one).sum() + 2))  # a class without errors has no temperature otherwise
        tried = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
        loss = [float((w * (np.logaddexp(0, logit / t) - truth * logit / t)).sum()) for t in tried]
        net.temperature = float(tried[int(np.argmin(loss))])
    return net


# ------------------------------------------------------------------ on tables
@dataclass
class Model:
    vectors: np.ndarray
    index: np.ndarray
    network: Network


def corpus_contexts(docs: DataFrame, text_col: str = "text", seed: int = 0) -> np.ndarray:
    """Each bucket's sum of contexts over all documents. Tasks add up what they read; the sums of
    tasks are added block by block of buckets, one after the other. The result's size is fixed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, sums = index_vectors(seed), np.zeros((1 << BUCKET_BITS, DIM))
        for batch in batches:
            for _, _, part, offsets in text_steps(batch.column(0), STEP_BYTES):
                add_contexts(sums, *buckets(part, offsets), index)
        press = zstandard.ZstdCompressor(level=1).compress
        blocks = sums.astype("<i8").reshape(-1, BLOCK, DIM)
        some = np.flatnonzero(blocks.any((1, 2)))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([press(blocks[k].tobytes()) for k in some], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        read = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for block, sums in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                value = np.frombuffer(read(sums.as_py()), "<i8")
                total[block] = total[block] + value if block in total else value
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["block", "sums"])

    shape = "block int, sums binary"
    found = docs.select(text_col).mapInArrow(count, shape).repartition("block").mapInArrow(add, shape)
    out = np.zeros((1 << BUCKET_BITS, DIM))
    for r in found.collect():  # at most 2 ** BUCKET_BITS / BLOCK rows
        out[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r.sums, "<i8").reshape(BLOCK, DIM)
    return out


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          rows_per_class: int = TRAIN_ROWS, seed: int = 0) -> Model:
    """A model whose contexts come from all of ``docs``, fitted on the documents with a label 0 or 1 and
    ``usable`` ids, at most ``rows_per_class`` of either label, by hash order of the id. Of rows that share an
    id the text of the least hash counts, of labels the greatest; so the driver gets one vector per labelled id."""
    index = index_vectors(seed)
    vectors, own = word_vectors(corpus_contexts(docs, text_col, seed), index), dense_index(index)
    named = labels.where(usable & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    sample = written(named.where("label = 0").orderBy(F.xxhash64("id"), "id").limit(rows_per_class).unionByName(
        named.where("label = 1").orderBy(F.xxhash64("id"), "id").limit(rows_per_class)), "labelled")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pool(batch.column(1), vectors, own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([row.tobytes() for row in x], pa.binary())], ["label", "x"])

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id")
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # each task passes on one text of an id
    rows = sorted(texts.select("label", "text").mapInArrow(read, "label int, x binary").collect(), key=lambda r: (r.x, r.label))
    x = np.frombuffer(b"".join(r.x for r in rows), np.float32).reshape(-1, 2 * DIM)
    return Model(vectors, own, fit(x, np.array([r.label for r in rows], np.int64), seed))


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, from 0 to 1; null and empty texts have one too."""
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())])
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            value = m.network.scores(pool(batch.column(place), m.vectors, m.index)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], [*batch.schema.names, out])

    return docs.mapInArrow(score, schema)
