"""A byte-level convolutional network for document quality, in numpy.

Learned filters look at windows of eight bytes every two bytes, so that overlapping windows cover the whole document.
Each filter is max-pooled over stretches of windows; the mean over the stretches and the maximum over the document
enter a logistic unit. For scoring, the filters are tabulated for byte pairs: a window costs four look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attesta.llm.common import slices

WIDTH, STRIDE, FILTERS, STRETCH = 8, 2, 12, 128
#: Windows that are scored at once: bounds the memory that a very long text takes.
BLOCK = STRETCH * 256


def as_bytes(text: str | None) -> np.ndarray:
    """The text in UTF-8, filled up with zeros to one window at least and to an even length."""
    raw = np.frombuffer((text or "").encode(), np.uint8)
    fill = max(WIDTH - len(raw), len(raw) % 2)
    return np.concatenate([raw, np.zeros(fill, np.uint8)]) if fill else raw


@dataclass
class Network:
    """kernel[position, byte, filter], bias[filter], out[2 * filters], offset."""

    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    offset: float

    @classmethod
    def fit(cls, texts: list[str], labels: list[int], epochs: int = 6, size: int = 32, rate: float = 0.01, l2: float = 1e-5, seed: int = 7) -> Network:
        """Train by Adam on log loss; the gradient of a maximum goes to the window that attains it. Few rows are gone over more often: 450 steps at least."""
        rng = np.random.default_rng(seed)
        theta = [rng.normal(0, 0.05, (WIDTH, 256, FILTERS)), np.full(FILTERS, 0.05), rng.normal(0, 0.1, 2 * FILTERS), np.zeros(1)]
        if len(set(labels)) < 2:  # nothing to tell apart
            p = (sum(labels) + 1) / (len(labels) + 2)
            return cls(np.zeros((WIDTH, 256, FILTERS), np.float32), theta[1].astype(np.float32), np.zeros(2 * FILTERS), float(np.log(p / (1 - p))))
        m, v = [np.zeros_like(p) for p in theta], [np.zeros_like(p) for p in theta]
        data, step = [as_bytes(t) for t in texts], 0
        for _ in range(max(epochs, -(-450 // -(-len(data) // size)))):
            order = rng.permutation(len(data))
            for at in range(0, len(order), size):
                step += 1
                grads = [np.zeros_like(p) for p in theta]
                kernel, bias, out, offset = theta
                for i in order[at : at + size]:
                    raw = data[i]
                    n = (len(raw) - WIDTH) // STRIDE + 1
                    starts = np.arange(0, n, STRETCH)
                    tops, peaks = [], []
                    for first in range(0, n, BLOCK):
                        k = min(BLOCK, n - first)
                        at0 = STRIDE * first
                        a = sum(kernel[j][raw[at0 + j : at0 + j + STRIDE * k : STRIDE]] for j in range(WIDTH)) + bias
                        own = [s + a[s : s + STRETCH].argmax(0) for s in range(0, k, STRETCH)]
                        tops += [first + x for x in own]
                        peaks += [a[x, np.arange(FILTERS)] for x in own]
                    where = np.array(tops)
                    pooled = np.array(peaks)
                    live = pooled > 0
                    pooled = pooled * live
                    best = pooled.argmax(0)
                    feats = np.concatenate([pooled.mean(0), pooled.max(0)])
                    delta = (labels[i] - 1 / (1 + np.exp(-(feats @ out + offset[0])))) / size
                    grads[2] += delta * feats
                    grads[3] += delta
                    back = np.repeat(delta * out[None, :FILTERS] / len(starts), len(starts), 0)
                    back[best, np.arange(FILTERS)] += delta * out[FILTERS:]
                    back *= live
                    grads[1] += back.sum(0)
                    rows, cols = where.ravel(), np.tile(np.arange(FILTERS), len(starts))
                    for j in range(WIDTH):
                        np.add.at(grads[0][j], (raw[STRIDE * rows + j], cols), back.ravel())
                for k, g in enumerate(grads):
                    g = g - l2 * theta[k]
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    theta[k] = theta[k] + rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return cls(theta[0].astype(np.float32), theta[1].astype(np.float32), theta[2], float(theta[3][0]))

    def tables(self) -> list[np.ndarray]:
        """For each of the four byte pairs of a window, what it adds to every filter; little-endian pairs."""
        return [np.ascontiguousarray((self.kernel[j + 1][:, None] + self.kernel[j][None]).reshape(65536, FILTERS)) for j in range(0, WIDTH, 2)]

    def score(self, text: str | None, tables: list[np.ndarray]) -> float:
        pairs = as_bytes(text).view("<u2")
        n = len(pairs) - WIDTH // 2 + 1
        total, top, stretches = np.zeros(FILTERS), np.zeros(FILTERS), 0
        for at in range(0, n, BLOCK):
            k = min(BLOCK, n - at)
            a = tables[0].take(pairs[at : at + k], 0)
            for j in range(1, WIDTH // 2):
                a += tables[j].take(pairs[at + j : at + j + k], 0)
            whole = k // STRETCH * STRETCH
            pooled = [a[:whole].reshape(-1, STRETCH, FILTERS).max(1)] if whole else []
            if whole < k:
                pooled.append(a[whole:].max(0, keepdims=True))
            x = np.maximum(np.concatenate(pooled) + self.bias, 0)
            total += x.sum(0, dtype=float)
            stretches += len(x)
            top = np.maximum(top, x.max(0))
        z = np.concatenate([total / stretches, top]) @ self.out + self.offset
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def held_out(id_col: str) -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 2500, max_chars: int = 48_000_000, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Network:
    """Train on a bounded sample of the labelled rows that are not held out and have a text.

    The sample is the first rows in the order of a hash of the id, so it does not depend on the layout of the tables:
    max_rows at most, and no more than max_chars characters in all. Each is learned from as a whole. Of labels repeated
    for an id the greatest counts; repeated documents are rows like any other; further columns are not read.
    """
    pick = F.xxhash64(F.col(id_col))
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col)).groupBy(id_col).agg(F.max(label_col).alias("_label"))
    facts = docs.where(F.col(text_col).isNotNull()).select(id_col, F.length(text_col).alias("_n")).join(own, id_col).orderBy(pick, id_col).limit(max_rows)
    total, few = 0, []
    for r in facts.collect():  # max_rows numbers
        total += r["_n"]
        if total > max_chars and few:
            break
        few.append((r[id_col], int(r["_label"])))
    if not few:
        return Network.fit([], [])
    # broadcast: max_rows ids at most
    chosen = docs.sparkSession.createDataFrame(sorted(set(few)), f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, _label int")
    found = docs.where(F.col(text_col).isNotNull()).select(id_col, F.col(text_col).alias("t")).join(F.broadcast(chosen), id_col).orderBy(pick, id_col, "t").collect()
    return Network.fit([r["t"] for r in found], [r["_label"] for r in found])


def score(docs: DataFrame, network: Network, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Probability that a whole text is good: one row per input row, with no shuffle.

    Columns: id, held_out, score, predicted; with keep, all columns of docs and then score. Null and empty texts are
    scored as a window of zero bytes; null ids are not held out; repeated rows are scored alike; an empty table gives
    an empty result.
    """
    schema = docs.schema

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables()
        for b in slices(batches):
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([network.score(t, tables) for t in texts], pa.float64())], [*b.schema.names, "_score"])

    if keep:
        return docs.mapInArrow(scored, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", _score double")

    def slim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in scored(batches):
            yield b.select([0, 2])

    kind = schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(slim, f"`{id_col}` {kind}, _score double")
    return found.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
