"""Quality by a byte-level convolutional network, in numpy.

Every byte enters as a learned embedding and as flags of whether it repeats the byte one
to ``LAGS`` places before it. Filters span chunks of ``2 * CELL`` bytes that begin every
``CELL`` bytes, so chunks overlap and cover the whole document; each filter keeps its
largest response, and a logistic layer combines the maxima into one probability.

A text is laid out in cells of ``CELL`` bytes with empty cells behind it, so a chunk never
spans two texts and a cell's part of a response is computed once for both chunks it is in.
Training is Adam over mini-batches; the gradient of a maximum goes to the chunk it came
from. It uses at most ``SAMPLE`` labelled documents of smallest hash, of each at most
``WINDOW`` characters at a hashed place; scoring reads every byte of every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, slices, text_bytes
from .language import fold, sample

CELL, LAGS, EMBED, FILTERS = 8, 24, 6, 16
PAD = LAGS // CELL + 1
SAMPLE, WINDOW = 3000, 16384
EPOCHS, BATCH, RATE = 14, 32, 0.01
ACCEPT = 0.7
SLICE = 1 << 20


def cells(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes laid out in cells, and the n + 1 first cells of the rows (each with its empty cells)."""
    size = np.diff(offsets)
    first = np.concatenate(([0], np.cumsum(-(-size // CELL) + PAD)))
    out = np.zeros(int(first[-1]) * CELL, np.uint8)
    if len(data):
        shift = first[:-1] * CELL - offsets[:-1]
        out[np.arange(len(data)) + np.repeat(shift, size)] = data
    return out, first


def repeats(laid: np.ndarray) -> np.ndarray:
    """(cells, LAGS) shares of a cell's bytes that equal the byte so many places before."""
    out = np.zeros((len(laid) // CELL, LAGS), np.float32)
    same = np.zeros(len(laid), bool)
    for lag in range(1, LAGS + 1):
        same[:lag] = False
        np.equal(laid[lag:], laid[:-lag], out=same[lag:])
        same &= laid != 0
        out[:, lag - 1] = np.bitwise_count(same.view(np.uint64))
    return out / CELL


class Network:
    """Embedding, chunk filters (two halves of a chunk), their bias, and the logistic layer."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        width = CELL * EMBED + LAGS
        self.embed = rng.normal(0, 0.5, (256, EMBED)).astype(np.float32)
        self.embed[0] = 0
        self.near = rng.normal(0, 0.15, (2, width, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = rng.normal(0, 0.1, FILTERS + 1).astype(np.float32)

    def maxima(self, laid: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The largest rectified response of each filter in each row, and what training needs."""
        x = np.concatenate((self.embed[laid].reshape(-1, CELL * EMBED), repeats(laid)), axis=1)
        response = x @ self.near[0] + self.bias
        second = x[1:] @ self.near[1]
        second[first[1:-1] - 1] = 0  # the last cell of a row has no second half
        response[:-1] += second
        np.maximum(response, 0, out=response)
        return np.maximum.reduceat(response, first[:-1], axis=0), (x, response)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        if len(offsets) < 2:
            return np.zeros(0)
        top, _ = self.maxima(*cells(data, offsets))
        return 1 / (1 + np.exp(-(top @ self.out[:-1] + self.out[-1]).astype(np.float64)))

    def gradient(self, data: np.ndarray, offsets: np.ndarray, want: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy and its gradients."""
        laid, first = cells(data, offsets)
        top, (x, response) = self.maxima(laid, first)
        p = 1 / (1 + np.exp(-(top @ self.out[:-1] + self.out[-1])))
        loss = -float(np.mean(np.log(np.where(want == 1, p, 1 - p) + 1e-9)))
        d = ((p - want) / len(want)).astype(np.float32)
        g_out = np.append(d @ top, d.sum()).astype(np.float32)
        d_top = d[:, None] * self.out[:-1] * (top > 0)
        g_near, g_embed = np.zeros_like(self.near), np.zeros_like(self.embed)
        bytes_ = laid.reshape(-1, CELL)
        for row in range(len(want)):
            at = first[row] + response[first[row] : first[row + 1]].argmax(0)
            for half in (0, 1):
                ok = at + half < first[row + 1]
                cell = np.minimum(at + half, len(x) - 1)
                own = x[cell] * ok[:, None]
                g_near[half] += own.T * d_top[row]
                back = (self.near[half][: CELL * EMBED].T * (d_top[row] * ok)[:, None]).reshape(-1, CELL, EMBED)
                np.add.at(g_embed, bytes_[cell], back)
        g_embed[0] = 0
        return loss, [g_embed, g_near, d_top.sum(0), g_out]

    def train(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 4) -> None:
        rng = np.random.default_rng(seed)
        weights = [self.embed, self.near, self.bias, self.out]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        share = labels.mean()
        self.out[-1] = np.log((share + 0.01) / (1 - share + 0.01))
        per, step = max(1, len(texts) // BATCH), 0
        for epoch in range(epochs):
            for part in np.array_split(rng.permutation(len(texts)), per):
                step += 1
                own = [texts[k] for k in part]
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in own])))
                _, grads = self.gradient(np.frombuffer(b"".join(own), np.uint8), offsets, labels[part])
                now = rate * (1 - epoch / epochs) + 1e-4
                for w, m, v, g in zip(weights, first, second, grads):
                    m += 0.1 * (g - m)
                    v += 0.005 * (g * g - v)
                    w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-7)


def train(self, texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 4) -> None:
        rng = np.random.default_rng(seed)
        weights = [self.embed, self.near, self.bias, self.out]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        share = labels.mean()
        self.out[-1] = np.log((share + 0.01) / (1 - share + 0.01))
        per, step = max(1, len(texts) // BATCH), 0
        for epoch in range(epochs):
            for part in np.array_split(rng.permutation(len(texts)), per):
                step += 1
                own = [texts[k] for k in part]
                offsets = np.concatenate(([0], np.cumsum([len(t) for t in own])))
                _, grads = self.gradient(np.frombuffer(b"".join(own), np.uint8), offsets, labels[part])
                now = rate * (1 - epoch / epochs) + 1e-4
                for w, m, v, g in zip(weights, first, second, grads):
                    m += 0.1 * (g - m)
                    v += 0.005 * (g * g - v)
                    w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-7)


class Untrained(ValueError):
    """The labels that documents have are not of two classes."""


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, size: int = SAMPLE, window: int = WINDOW) -> Network | None:
    """Learn ``quality`` from labelled documents outside the held-out fold.

    Labels of other tables' documents do not count: the sample is taken among documents
    with text. None where those do not hold both classes: nothing can be learned then.
    """
    known = labels.where(F.col("quality").isNotNull() & (F.coalesce(fold("doc_id", folds), F.lit(held)) != held))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    texts = docs.where("text is not null")
    mine = texts.groupBy("doc_id").agg(F.count("*").alias("_n")).join(known, "doc_id")
    few = mine.orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id").limit(size).drop("_n")  # at most ``size`` rows are broadcast
    rows = sample(texts.join(F.broadcast(few), "doc_id").select("doc_id", "text", "quality"), "quality", size, window)
    marks = np.array([y for _, y in rows], np.float32)
    if len(set(marks.tolist())) < 2:
        return None
    net = Network()
    net.train([t.encode() for t, _ in rows], marks)
    return net


def scored(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, net: Network | None = None, id_column: str = "doc_id") -> DataFrame:
    """Per document doc_id, held_out, score and predicted (1 if the score is 0.7 or more).

    Empty and null texts are scored as no chunks at all. Rows without id are scored but
    never learned from or held out. Where the documents' labels are not of both classes
    nothing is known of any text: all scores are one half. An empty table gives no rows;
    other columns are ignored.
    """
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    net = net or train(slim, labels, folds, held)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(None)
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                p = shared.value.score(*text_bytes(b.column(2))) if shared.value else np.full(b.num_rows, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(p), pa.array((p >= ACCEPT).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    rows = slim.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(scan, "doc_id long, held_out boolean, score double, predicted int")
