"""Quality classifier: supervised subword embeddings.

A document is the mean of the learned vectors of its features, hashed into
``2^bits`` cells: words, pairs of neighbouring words, and character n-grams of
4 bytes over the whole text; each kind is averaged by itself and the three
means are averaged.  A softmax over the classes follows.  Vectors and softmax
are trained by stochastic gradient descent in numpy.

The pair hash is that of the difference of the two word hashes, so that a word
followed by itself is the same feature whatever the word.

Training uses at most ``SAMPLE`` labelled documents, those with the smallest
hash of their id: one task holds their sparse features.  Scoring covers every
document, whole, and needs one number per cell: the difference of the classes'
softmax inputs, which is linear in the document's mean.

Defined results: null and empty texts get the score of no features; labels
other than 0 and 1, null ids and null labels teach nothing; a document
labelled twice teaches twice; without any label the score is 0.5; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkernel as K
from vigil.llm.langid import held_out
from vigil.llm.storage import small_batches

SAMPLE = 4000        # labelled documents that train
BITS = 16            # 2^16 cells
DIM = 8
EPOCHS = 8
RATE = 2.0
EMBEDDING_RATE = np.float32(30)     # times RATE: a cell's share of a mean is small
THRESHOLD = 0.3

_KIND = K.mix(np.arange(1, 4, dtype=np.uint64))


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind (words, pairs, characters): (cells, first), the features
    of row i being ``cells[first[i]:first[i+1]]``."""
    shift = np.uint64(64 - bits)
    words = K.Words(data, offsets, K.NON_SPACE, lower=True)
    w = words.hash
    out = [((K.mix(w ^ _KIND[0]) >> shift).astype(np.int64), words.first)]
    row = words.row_of_word()
    same = row[1:] == row[:-1]
    pair = K.mix(K.mix(w[1:] - w[:-1]) ^ _KIND[1])[same] if len(w) else w
    out.append(((pair >> shift).astype(np.int64), np.searchsorted(row[1:][same], np.arange(words.n_rows + 1)) if len(w) else words.first))
    n = max(len(data) - 3, 0)
    d = data.astype(np.uint64)
    grams = sum((d[j:j + n] << np.uint64(8 * j) for j in range(4)), np.zeros(n, np.uint64))
    at = np.arange(n)
    rows = np.searchsorted(offsets, at, side="right") - 1
    inside = at + 4 <= offsets[rows + 1] if n else np.zeros(0, bool)
    out.append(((K.mix(grams[inside] ^ _KIND[2]) >> shift).astype(np.int64), np.searchsorted(at[inside], offsets)))
    return out


def _sparse(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """(id, label, cells, weights) of rows (id, label, text)."""
    for batch in batches:
        data, off = K.string_parts(batch.column(2))
        cells, weights = [], []
        for a, b in K.slices(off):
            kinds = features(data[off[a]:off[b]], off[a:b + 1] - off[a], bits)
            for r in range(b - a):
                c = np.concatenate([x[f[r]:f[r + 1]] for x, f in kinds])
                v = np.concatenate([np.full(f[r + 1] - f[r], 1 / (3 * max(f[r + 1] - f[r], 1))) for _, f in kinds])
                u, inv = np.unique(c, return_inverse=True)
                cells.append(u.astype(np.int32)), weights.append(np.bincount(inv, v, len(u)).astype(np.float32))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, pa.list_(pa.int32())),
                                          pa.array(weights, pa.list_(pa.float32()))], ["id", "label", "cells", "weights"])


def train(label: np.ndarray, cells: list[np.ndarray], weights: list[np.ndarray], bits: int = BITS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> tuple[np.ndarray, float]:
    """(cell values, bias): the class-1 minus class-0 softmax input of each cell."""
    rng = np.random.default_rng(seed)
    emb = ((rng.random((1 << bits, dim)) - 0.5) / dim).astype(np.float32)
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(label), 0
    for _ in range(epochs):
        for i in rng.permutation(len(label)):
            lr = np.float32(rate * (1 - done / steps))
            done += 1
            c, w = cells[i], weights[i]
            mean = w @ emb[c]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            back = out @ p
            out -= lr * np.outer(mean, p)
            bias -= np.float32(0.1) * lr * p
            emb[c] -= (EMBEDDING_RATE * lr * w)[:, None] * back
    return emb @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0])


def _train(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                    (np.asarray(x.values) for x in batch.column(2)), (np.asarray(x.values) for x in batch.column(3)))
    if rows:
        rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
        value, bias = train(np.array([r[1] for r in rows]), [r[2] for r in rows], [r[3] for r in rows], bits)
        yield pa.RecordBatch.from_arrays([pa.array([value.astype(np.float32).tobytes()], pa.binary()), pa.array([bias])], ["value", "bias"])


@dataclass
class Model:
    value: np.ndarray
    bias: float
    bits: int

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        z = np.full(len(offsets) - 1, self.bias)
        for cells, first in features(data, offsets, self.bits):
            total = np.append(0.0, np.cumsum(self.value[cells], dtype=np.float64))
            n = np.diff(first)
            z += (total[first[1:]] - total[first[:-1]]) / (3 * np.maximum(n, 1))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE, bits: int = BITS) -> Model:
    """Trains in one task on at most ``sample`` labelled documents that are not held out."""
    small_batches(docs.sparkSession)
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    chosen = usable.orderBy(F.xxhash64("id"), "id", "label").limit(sample)      # at most ``sample`` rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "id").select("id", "label", "text")
    sparse = rows.mapInArrow(partial(_sparse, bits=bits), T.StructType([
        rows.schema["id"], rows.schema["label"], T.StructField("cells", T.ArrayType(T.IntegerType())),
        T.StructField("weights", T.ArrayType(T.FloatType()))]))
    got = sparse.repartition(1).mapInArrow(partial(_train, bits=bits), "value binary, bias double").collect()
    if not got:
        return Model(np.zeros(1 << bits, np.float32), 0.0, bits)
    return Model(np.frombuffer(got[0].value, np.float32), got[0].bias, bits)


def _score(batches: Iterator[pa.RecordBatch], model_b) -> Iterator[pa.RecordBatch]:
    model: Model = model_b.value
    for batch in batches:
        data, off = K.string_parts(batch.column(1))
        s = np.zeros(batch.num_rows)
        for a, b in K.slices(off):
            s[a:b] = model.score(data[off[a]:off[b]], off[a:b + 1] - off[a])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["id", "score"])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, held_out, score, predicted) per document."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    out = src.mapInArrow(partial(_score, model_b=held), T.StructType([src.schema["id"], T.StructField("score", T.DoubleType())]))
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
