"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads runs of ``RUN`` bytes in both directions, labels every byte position
with a distribution over languages, and a document's probabilities are the mean over all
its bytes. Runs of many documents advance together, one byte a step, as matrix products.

It is trained here, in numpy, by backpropagation through time, on a bounded sample: of
every language that occurs at most ``EACH`` labelled documents, those of smallest hash, and
of each a window of ``WINDOW`` characters at a hashed place. Scoring reads every byte of
every text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import kept, slices, text_bytes

RUN, HIDDEN, BATCH = 128, 8, 2048
EACH, WINDOW = 500, 2048
#: Languages learned at most, those of most documents; salts that a language is dealt over for its sample.
MOST, SALTS = 1000, 64
STEPS, TRAIN_RUN, TRAIN_BATCH, RATE = 300, 64, 128, 0.02
SLICE = 2 << 20


class Network:
    """Two gated recurrent layers, one each way, and a softmax at every position.

    ``x`` (2, 256, 3 H) holds what each byte adds to the gates (update, reset, candidate),
    ``h`` (2, H, 3 H) the recurrent weights, ``o`` (2 H + 1, L) the output with its bias.
    """

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.x = rng.normal(0, 0.3, (2, 256, 3 * hidden)).astype(np.float32)
        self.h = rng.normal(0, 0.3, (2, hidden, 3 * hidden)).astype(np.float32)
        self.o = rng.normal(0, 0.3, (2 * hidden + 1, len(languages))).astype(np.float32)

    def run(self, data: np.ndarray, mask: np.ndarray | None = None, keep: bool = False):
        """States (T, 2, N, H) for byte runs (T, N); direction 1 reads backwards and is stored by its own steps."""
        steps, n = data.shape
        size = self.h.shape[1]
        out = np.zeros((steps + 1, 2, n, size), np.float32)
        gates = np.zeros((steps, 2, n, 4 * size), np.float32) if keep else None
        for t in range(steps):
            before = out[t]
            row = np.stack((self.x[0][data[t]], self.x[1][data[steps - 1 - t]]))
            from_h = before @ self.h
            zr = row[..., : 2 * size] + from_h[..., : 2 * size]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[..., :size], zr[..., size:]
            c = np.tanh(row[..., 2 * size :] + r * from_h[..., 2 * size :])
            np.subtract(before, c, out=out[t + 1])
            out[t + 1] *= z
            out[t + 1] += c
            if mask is not None:
                out[t + 1, 0] *= mask[t][:, None]
                out[t + 1, 1] *= mask[steps - 1 - t][:, None]
            if keep:
                gates[t] = np.concatenate((zr, c, from_h[..., 2 * size :]), axis=-1)
        return (out, gates) if keep else out

    def label(self, out: np.ndarray) -> np.ndarray:
        """Distributions (T, N, L) at every position."""
        size = out.shape[-1]
        logits = out[1:, 0] @ self.o[:size] + out[:0:-1, 1] @ self.o[size : 2 * size] + self.o[-1]
        logits -= logits.max(-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(-1, keepdims=True)
        return logits

    def gradient(self, data: np.ndarray, want: np.ndarray, mask: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over all positions, and its gradients by backpropagation through time."""
        out, gates = self.run(data, mask, keep=True)
        p = self.label(out)
        steps, n, _ = p.shape
        size, total = self.h.shape[1], max(1.0, float(mask.sum()))
        loss = -float((np.log(p[:, np.arange(n), want] + 1e-9) * mask).sum()) / total
        d = p
        d[:, np.arange(n), want] -= 1
        d *= mask[..., None] / total
        forward, backward = out[1:, 0], out[:0:-1, 1]
        go = np.concatenate((
            np.einsum("tni,tnl->il", forward, d), np.einsum("tni,tnl->il", backward, d), d.sum((0, 1))[None]
        ))
        into = np.stack((d @ self.o[:size].T, (d @ self.o[size : 2 * size].T)[::-1]), axis=1)
        gx, gh = np.zeros_like(self.x), np.zeros_like(self.h)
        dh = np.zeros_like(out[0])
        for t in reversed(range(steps)):
            z, r, c, u = (gates[t][..., k * size : (k + 1) * size] for k in range(4))
            dh = dh + into[t]
            dh[0] *= mask[t][:, None]
            dh[1] *= mask[steps - 1 - t][:, None]
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (out[t] - c) * z * (1 - z)
            dr = dc * u * r * (1 - r)
            both = np.concatenate((dz, dr, dc), axis=-1)
            np.add.at(gx[0], data[t], both[0])
            np.add.at(gx[1], data[steps - 1 - t], both[1])
            through = np.concatenate((dz, dr, dc * r), axis=-1)
            gh += out[t].transpose(0, 2, 1) @ through
            dh = dh * z + through @ self.h.transpose(0, 2, 1)
        return loss, [gx, gh, go]

    def train(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, rate: float = RATE, seed: int = 2) -> None:
        """Adam over random runs; languages are drawn evenly."""
        rng = np.random.default_rng(seed)
        by = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        weights = [self.x, self.h, self.o]
        first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
        for step in range(1, steps + 1):
            want = rng.integers(0, len(by), TRAIN_BATCH)
            data = np.zeros((TRAIN_RUN, TRAIN_BATCH), np.uint8)
            mask = np.zeros((TRAIN_RUN, TRAIN_BATCH), np.float32)
            for k, lang in enumerate(want):
                text = texts[rng.choice(by[lang])]
                at = int(rng.integers(0, max(1, len(text) - TRAIN_RUN + 1)))
                part = np.frombuffer(text[at : at + TRAIN_RUN], np.uint8)
                data[: len(part), k] = part
                mask[: len(part), k] = 1
            _, grads = self.gradient(data, want, mask)
            for w, m, v, g in zip(weights, first, second, grads):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                now = rate * min(1.0, 2 * (1 - step / steps) + 0.02)
                w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean distribution over all bytes of each row; zeros for an empty row."""
        size = np.diff(offsets)
        runs = -(-size // RUN)
        row = np.repeat(np.arange(len(size)), runs)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
        start = offsets[row] + nth * RUN
        length = np.minimum(RUN, offsets[row + 1] - start)
        total = np.zeros((len(size), len(self.languages)))
        order = np.argsort(length, kind="stable")
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            steps = int(length[own].max())
            place = start[own][None, :] + np.arange(steps)[:, None]
            mask = (np.arange(steps)[:, None] < length[own][None, :]) if int(length[own].min()) < steps else None
            runs_ = data[np.minimum(place, len(data) - 1)]
            if mask is None:
                p = self.label(self.run(runs_)).sum(0)
            else:
                mask = mask.astype(np.float32)
                p = (self.label(self.run(runs_ * mask.astype(np.uint8), mask)) * mask[..., None]).sum(0)
            np.add.at(total, row[own], p)
        return total / np.maximum(size, 1)[:, None]


def fold(column: str, folds: int) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, label: str, size: int, window: int) -> list[tuple[str, str]]:
    """At most ``size`` labelled texts of smallest hash, of each a window at a hashed place."""
    h = F.xxhash64("doc_id", F.lit(5))
    begin = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.greatest(F.length("text") - window, F.lit(0)) + 1) + 1
    rows = docs.withColumn("_h", h).orderBy("_h", "doc_id").limit(size)
    return [(r[0], r[1]) for r in rows.select(F.substring("text", begin.cast("int"), F.lit(window)), label).collect()]


def each_sample(docs: DataFrame, label: str, size: int, window: int) -> list[tuple[str, str]]:
    """As ``sample``, at most ``size`` texts of every label, so a rare label is not lost among the others.

    The largest hash to take is found for each label without the texts, first among the
    rows of each salt, then among those that are left, so a label that a third of all rows
    have is ranked by many tasks. Of more than ``MOST`` labels the most frequent are taken.
    """
    hashed = docs.withColumn("_h", F.xxhash64("doc_id", F.lit(5)))
    common = docs.groupBy(label).count().orderBy(F.desc("count"), label).limit(MOST).select(label)
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", "doc_id"))
    dealt = F.row_number().over(Window.partitionBy(label, "_salt").orderBy("_h", "doc_id"))
    slim = hashed.join(F.broadcast(common), label).select(label, "doc_id", "_h", F.pmod("_h", F.lit(SALTS)).alias("_salt"))
    first = slim.withColumn("_r", dealt).where(F.col("_r") <= size).withColumn("_r", rank).where(F.col("_r") <= size)
    cuts = {r[0]: r[1] for r in first.groupBy(label).agg(F.max("_h")).collect()}
    if not cuts:
        return []
    cut = F.create_map(*(F.lit(x) for pair in cuts.items() for x in pair))
    few = hashed.where(F.col("_h") <= cut[F.col(label)]).withColumn("_salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)))
    begin = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.greatest(F.length("text") - window, F.lit(0)) + 1) + 1
    parts = few.select(F.substring("text", begin.cast("int"), F.lit(window)).alias("_t"), label, "doc_id", "_h", "_salt")
    rows = parts.withColumn("_r", dealt).where(F.col("_r") <= size).withColumn("_r", rank).where(F.col("_r") <= size)
    return [(r[0], r[1]) for r in rows.orderBy("_h", "doc_id").select("_t", label).collect()]


def train(docs: DataFrame, folds: int = 3, held: int = 1, size: int = EACH, window: int = WINDOW) -> Network:
    """Learn from documents outside the held-out fold that have text with a letter and a language.

    The sample holds ``size`` documents of each language, so it is bounded by their number.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & (F.coalesce(fold("doc_id", folds), F.lit(held)) != held))
    rows = each_sample(known.select("doc_id", "text", "lang"), "lang", size, window)
    languages = sorted({lang for _, lang in rows})
    net = Network(languages)
    if len(languages) > 1:
        net.train([t.encode() for t, _ in rows], np.array([languages.index(x) for _, x in rows]))
    return net


def _lettered(text: str | None, data: np.ndarray) -> bool:
    ascii_letters = ((data | 32) >= 97) & ((data | 32) <= 122)
    return bool(ascii_letters.any()) or (text is not None and any(map(str.isalpha, text)))


def identify(docs: DataFrame, folds: int = 3, held: int = 1, net: Network | None = None, id_column: str = "doc_id") -> DataFrame:
    """Per document doc_id, held_out, lang_pred and score, the probability of the predicted language.

    ``und`` with score 0 for null, empty and letterless texts, and for all if nothing could
    be learned. Rows without id or language are scored but never learned from; a null id
    is not held out. Repeated rows are rows of their own; an empty table gives no rows.
    """
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text", "lang")
    net = net or train(slim, folds, held)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept(None)
        net = shared.value
        names = np.array([*net.languages, "und"], dtype=object)
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                data, offsets = text_bytes(b.column(2))
                if net.languages:
                    p = net.score(data, offsets)
                else:
                    p = np.zeros((b.num_rows, 1))
                best = p.argmax(1) if net.languages else np.zeros(b.num_rows, int)
                score = p[np.arange(len(p)), best]
                texts = b.column(2)
                for k in range(b.num_rows):
                    own = data[offsets[k] : offsets[k + 1]]
                    if not net.languages or not len(own) or not _lettered(None, own) and not _lettered(texts[k].as_py(), own):
                        best[k], score[k] = len(net.languages), 0.0
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1))],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = slim.select("doc_id", F.coalesce(fold("doc_id", folds) == held, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(scan, "doc_id long, held_out boolean, lang_pred string, score double")
