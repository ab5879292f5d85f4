"""Hard-negative mining by segment summaries.

A score is the integer inner product of two vectors whose components are
``floor(scale * x)``. A vector is cut into 1, 2, 4, ... segments, and of each segment the
mean m and the deviation d (the length of what is left after taking the mean off) are
kept. Over a segment of n components the product of x and y is n*mx*my plus the product of
the two remainders, which lies within dx*dy of zero. Summed over the segments this bounds
the score from both sides. A pair goes to the next, finer level only while its bounds leave
it open, and is scored exactly only behind the last one.

Anchors are the stated query set. They are dealt into blocks of bounded bytes; a block
travels to the tasks, which read all rows where they lie, so vectors are never shuffled. A
task keeps the best few rows of every anchor of the block, and its worst kept score is the
bound that later rows must reach. Two scans serve a block: the first finds the positives,
the second the negatives inside the bands that the positives set. The few rows each task
returns are ranked by a window that drops the rest before its shuffle. A hot label or a
group of equal vectors only adds rows to the scans, never a group to one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import new_path, stored

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative scores between these per cent of the positive's score.
LOW, HIGH = 80, 100
#: Bytes of anchor vectors in a block; rows and anchors of one tile; most segments of a vector.
BLOCK_BYTES, ROWS, ANCHORS, SEGMENTS = 16 << 20, 2048, 1024, 16
#: A level is computed for all pairs of a tile while more than this share of them is open.
DENSE = 0.1
EXACT = 2.0**53
NONE = np.iinfo(np.int64).min


class Vectors:
    """Integer vectors of one dimension with the summaries of every level."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, values: np.ndarray):
        self.ids, self.labels, self.values = ids, labels, values
        self.peak = float(np.abs(values).max(initial=0.0))
        self.size = np.linalg.norm(values, axis=1)
        self.levels = [self._level(n) for n in segment_counts(values.shape[1])]

    def _level(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Means (times the root of the segment's length) and deviations of ``n`` segments."""
        dim = self.values.shape[1]
        at = (np.arange(n) * dim) // n
        length = np.diff(np.append(at, dim)).astype(np.float64)
        mean = np.add.reduceat(self.values, at, axis=1) / length
        rest = self.values - np.repeat(mean, length.astype(int), axis=1)
        return mean * np.sqrt(length), np.sqrt(np.add.reduceat(rest * rest, at, axis=1))

    def part(self, lo: int, hi: int) -> Vectors:
        out = object.__new__(Vectors)
        out.ids, out.labels, out.values, out.size = self.ids[lo:hi], self.labels[lo:hi], self.values[lo:hi], self.size[lo:hi]
        out.peak, out.levels = self.peak, [(m[lo:hi], d[lo:hi]) for m, d in self.levels]
        return out


def segment_counts(dim: int) -> list[int]:
    """1, 2, 4, ... segments of at least two components each."""
    return [n for n in (1 << k for k in range(20)) if n <= SEGMENTS and 2 * n <= dim]


def exact(a: Vectors, r: Vectors, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Scores of the pairs (u, v), within the range of a long."""
    dim = a.values.shape[1]
    if dim * a.peak * r.peak < EXACT:  # every partial sum is a whole number that a double holds
        if len(u) > DENSE * len(a.ids) * len(r.ids):
            return (a.values @ r.values.T)[u, v].astype(np.int64)
        out = np.empty(len(u), np.int64)
        for at in range(0, len(u), 1 << 16):
            s = slice(at, at + (1 << 16))
            out[s] = np.einsum("ij,ij->i", a.values[u[s]], r.values[v[s]])
        return out
    top = np.iinfo(np.int64).max
    whole = lambda w: [int(x) for x in w]
    return np.array([max(-top, min(top, sum(x * y for x, y in zip(whole(a.values[i]), whole(r.values[j]))))) for i, j in zip(u, v)], np.int64)


def open_pairs(a: Vectors, r: Vectors, wanted: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs among ``wanted`` whose score may lie between their anchor's ``least`` and ``most``."""
    u = v = None
    slack = 1e-9 * float(a.size.max(initial=0.0)) * float(r.size.max(initial=0.0)) + 1e-6
    with np.errstate(over="ignore", invalid="ignore"):
        for (am, ad), (rm, rd) in zip(a.levels, r.levels):
            if u is None and np.count_nonzero(wanted) <= DENSE * wanted.size:
                u, v = np.nonzero(wanted)
            if u is None:
                mid, off = am @ rm.T, ad @ rd.T
                wanted &= ~(mid + off + slack < least[:, None]) & ~(mid - off - slack > most[:, None])
            elif len(u):
                ok = np.empty(len(u), bool)
                for at in range(0, len(u), 1 << 16):
                    s = slice(at, at + (1 << 16))
                    i, j = u[s], v[s]
                    mid, off = np.einsum("ij,ij->i", am[i], rm[j]), np.einsum("ij,ij->i", ad[i], rd[j])
                    ok[s] = ~(mid + off + slack < least[i]) & ~(mid - off - slack > most[i])
                u, v = u[ok], v[ok]
    return np.nonzero(wanted) if u is None else (u, v)


class Best:
    """The first ``k`` rows of each of ``n`` searches: higher score first, then smaller id; repeated rows once."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.key, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.worst = np.full(n, NONE)  # score of the k-th row, where there are k

    def add(self, key: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        better = score >= self.worst[key]
        if not better.any():
            return
        key, score = np.concatenate((self.key, key[better])), np.concatenate((self.score, score[better]))
        ids = np.concatenate((self.id, ids[better]))
        order = np.lexsort((ids, -score, key))
        key, score, ids = key[order], score[order], ids[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        key, score, ids = key[new], score[new], ids[new]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.append(first, len(key))))
        full = rank == self.k - 1
        self.worst[key[full]] = score[full]
        self.key, self.score, self.id = key[rank < self.k], score[rank < self.k], ids[rank < self.k]


def read_vectors(batch: pa.RecordBatch, scale: int) -> Iterator[Vectors]:
    """Vectors of a batch (id, label, vector), by dimension; rows that take no part are left out."""
    ids, labels, lists = batch.column(0), batch.column(1), batch.column(2)
    if not batch.num_rows:
        return
    flat = lists.flatten()
    there = np.asarray(lists.is_valid())
    sizes = np.where(there, np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null component becomes NaN
    at = np.concatenate(([0], np.cumsum(sizes)))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    fine = there & (bad[at[1:]] == bad[at[:-1]]) & np.asarray(ids.is_valid()) & np.asarray(labels.is_valid())
    number, mark = ids.fill_null(0).to_numpy(zero_copy_only=False), labels.fill_null(0).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes[fine]):
        rows = np.flatnonzero(fine & (sizes == dim))
        for k in range(0, len(rows), ROWS):
            some = rows[k : k + ROWS]
            block = values[at[some][:, None] + np.arange(dim)] if dim else np.zeros((len(some), 0))
            yield Vectors(number[some], mark[some], np.floor(block * scale))


@dataclass
class Search:
    """A block of anchors of one dimension; ``bands`` are (k, n) score limits of their positives, if known."""

    anchors: Vectors
    bands: tuple[np.ndarray, np.ndarray] | None
    k: int

    def run(self, found: list[Best], r: Vectors) -> None:
        a = self.anchors
        for lo in range(0, len(a.ids), ANCHORS):
            part = a.part(lo, lo + ANCHORS)
            n = len(part.ids)
            mine = np.arange(lo, lo + n)
            same = part.labels[:, None] == r.labels
            if self.bands is None:
                wanted = same & (part.ids[:, None] != r.ids)
                least, most = found[0].worst[mine].astype(np.float64), np.full(n, np.inf)
            else:
                low, high = self.bands[0][:, mine], self.bands[1][:, mine]
                wanted = ~same
                some = low <= high  # a positive below zero leaves no band
                worst = np.stack([b.worst[mine] for b in found])
                least = np.where(some, np.maximum(low, worst), np.iinfo(np.int64).max).min(0).astype(np.float64)
                most = np.where(some, high, NONE).max(0).astype(np.float64)
                wanted &= some.any(0)[:, None]
            u, v = open_pairs(part, r, wanted, least, most)
            if not len(u):
                continue
            score = exact(part, r, u, v)
            for p, best in enumerate(found):
                ok = np.ones(len(u), bool) if self.bands is None else (score >= low[p][u]) & (score <= high[p][u])
                best.add(lo + u[ok], score[ok], r.ids[v[ok]])


def _scan(rows: DataFrame, blocks: dict[int, Vectors], bands: dict | None, ranks: int, k: int, scale: int) -> DataFrame:
    """(dim, a, p, rank, score, id): the first ``k`` rows of each anchor, for each of its bands."""
    shared = rows.sparkSession.sparkContext.broadcast({d: Search(v, bands and bands[d], k) for d, v in blocks.items()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = shared.value
        found = {d: [Best(len(s.anchors.ids), k) for _ in range(ranks)] for d, s in searches.items()}
        for batch in batches:
            for r in read_vectors(batch, scale):
                dim = r.values.shape[1]
                if dim in searches:
                    searches[dim].run(found[dim], r)
        for d, each in found.items():
            for p, b in enumerate(each):
                if len(b.key):
                    n = len(b.key)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, d, np.int32)), pa.array(b.key), pa.array(np.full(n, p, np.int32)), pa.array(b.score), pa.array(b.id)],
                        names=["dim", "a", "p", "score", "id"],
                    )

    got = rows.mapInArrow(scan, "dim int, a long, p int, score long, id long").distinct()
    w = Window.partitionBy("dim", "a", "p").orderBy(F.desc("score"), "id")
    return got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _bands(blocks: dict[int, Vectors], best: pa.Table, ranks: int, low: int, high: int) -> tuple[dict, dict]:
    """Score limits of each positive, and its (id, score); a missing positive has an empty band."""
    bands, chosen = {}, {}
    for d, v in blocks.items():
        n = len(v.ids)
        bands[d] = np.full((ranks, n), 1, np.int64), np.full((ranks, n), 0, np.int64)
        chosen[d] = np.zeros((ranks, n), np.int64), np.zeros((ranks, n), np.int64)
    for d, a, rank, score, i in zip(*(best.column(c).to_pylist() for c in ("dim", "a", "rank", "score", "id"))):
        bands[d][0][rank - 1, a], bands[d][1][rank - 1, a] = -((-low * score) // 100), (high * score) // 100
        chosen[d][0][rank - 1, a], chosen[d][1][rank - 1, a] = i, score
    return bands, chosen


def mine(vectors: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
         scale: int = SCALE, block_bytes: int = BLOCK_BYTES, id_column: str = "vec_id", label_column: str = "label",
         vector_column: str = "embedding") -> DataFrame:
    """Per anchor and positive its negatives: anchor_id, positive_id, rank, negative_id and both scores.

    ``anchors`` is a condition over the columns of ``vectors``. Rows with a null id, label
    or vector, or any null or non-finite component take no part; vectors of different
    dimension do not meet. Rows that share an anchor's id are not among its partners; rows
    repeated with the same id and score count once, and an anchor repeated with another
    label or vector searches for each. Scores beyond a long are held at its range. Nothing
    is returned for an anchor without positives or a positive without negatives, and an
    empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    columns = [F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("long").alias("label"), F.col(vector_column).alias("v")]
    rows = vectors.select(*columns)
    asked = stored(vectors.where(anchors).select(*columns).where("id is not null and label is not null and v is not null").distinct(), "anchors")
    n, widest = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    blocks = max(1, -(-n * 8 * max(1, widest or 1) // block_bytes))
    path = new_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    for b in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id", "label", "v"), F.lit(blocks)) == b).orderBy("id", "label").toArrow()
        parts: dict[int, list[Vectors]] = {}
        for batch in own.combine_chunks().to_batches():
            for v in read_vectors(batch, scale):
                parts.setdefault(v.values.shape[1], []).append(v)
        held = {d: Vectors(*(np.concatenate([getattr(v, c) for v in vs]) for c in ("ids", "labels", "values"))) for d, vs in parts.items()}
        if not held:
            continue
        best = _scan(rows, held, None, 1, positives, scale).toArrow()
        bands, chosen = _bands(held, best, positives, low, high)
        found = _scan(rows, held, bands, positives, negatives, scale)
        names = spark.sparkContext.broadcast({d: (v.ids, *chosen[d]) for d, v in held.items()})

        def name(batches: Iterator[pa.RecordBatch], names=names) -> Iterator[pa.RecordBatch]:
            for t in batches:
                d, a, p = (t.column(c).to_numpy() for c in ("dim", "a", "p"))
                for dim in np.unique(d):
                    at = np.flatnonzero(d == dim)
                    ids, pos, score = names.value[dim]
                    few = t.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[a[at]]), pa.array(pos[p[at], a[at]]), few.column("rank"), few.column("id"), pa.array(score[p[at], a[at]]), few.column("score")],
                        names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
                    )

        found.mapInArrow(name, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)
