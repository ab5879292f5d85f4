"""Best-fit packing of token sequences over counts by size.

Texts are encoded once; pieces of at most ``CAPACITY`` ids, with the number they have
among the pieces of their length in their block of rows, are written as a slim table.
Documents and gaps have whole sizes up to the capacity, and those of equal size are
interchangeable: sorting by size is counting by size. So the matching needs no distributed
sort and no distributed sweep: one sweep on the driver over at most ``CAPACITY`` counts,
longest length first, finds the successor among the sorted gaps for all pieces of a length
at once, and notes intervals of ranks and of sequences. That is exactly best-fit decreasing
over all pieces.

Spark does what grows with the corpus. Ranks are counted distributively (a number within
the block plus what earlier blocks hold of that length), and every piece looks its interval
up: sequences are placed in one pass, without a sort of the rows and without a group that
grows with the data.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .tokens import Vocabulary, encoded

CAPACITY = 1024
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, block int, nth long"


def cut(n: int, capacity: int) -> list[int]:
    """Places where the pieces of ``n`` ids begin; only the first may be short."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)] if n > capacity else [0]


def pieces(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, keep_ids: bool = False, id_column: str = "doc_id") -> DataFrame:
    """One row per piece, with its number ``nth`` among the pieces of its length in its block."""
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(tokenizer))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        for b, found in encoded(batches, 1, shared.value, end):
            rows: list[tuple] = []
            kept: list = []
            for doc, ids in zip(b.column(0).to_pylist(), found):
                starts = cut(len(ids), capacity)
                for k, (lo, hi) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append((doc, k, lo, hi - lo, zlib.crc32(ids[lo:hi].astype("<u4")), block, seen[hi - lo]))
                    seen[hi - lo] += 1
                    if keep_ids:
                        kept.append(ids[lo:hi].astype(np.int32))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            names = [c.split()[0] for c in _PIECES.split(", ")]
            if keep_ids:
                columns, names = [*columns, pa.array(kept, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return stored(slim.mapInArrow(scan, _PIECES + (", ids array<int>" if keep_ids else "")), "pieces")


class Plan:
    """Where pieces of each length go, by rank: the outcome of the sweep.

    ``counts`` maps lengths to numbers of pieces. An interval (length, first rank, first
    sequence, pieces per sequence, offset) holds for the ranks up to the next interval.
    """

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.sequences = 0
        self.intervals: list[tuple[int, int, int, int, int]] = []
        gaps: list[int] = []  # sorted sizes of open gaps
        open_at: dict[int, list[tuple[int, int]]] = {}  # ranges of sequences by gap

        def leave(gap: int, lo: int, hi: int) -> None:
            if gap and hi > lo:
                if gap not in open_at:
                    insort(gaps, gap)
                open_at.setdefault(gap, []).append((lo, hi))

        for length in sorted(counts, reverse=True):
            rank, left = 0, counts[length]
            while left:
                at = bisect_left(gaps, length)
                if at < len(gaps):
                    gap = gaps[at]
                    lo, hi = open_at[gap].pop()
                    if not open_at[gap]:
                        del open_at[gap], gaps[at]
                else:  # nothing holds it: as many new sequences as the rest needs
                    gap, lo = capacity, self.sequences
                    hi = lo + -(-left // (capacity // length))
                    self.sequences = hi
                each = gap // length
                full = min(hi - lo, left // each)
                if full:
                    self.intervals.append((length, rank, lo, each, capacity - gap))
                    leave(gap - each * length, lo, lo + full)
                    rank, left, lo = rank + full * each, left - full * each, lo + full
                if left and lo < hi:  # the last sequence takes the few that remain
                    self.intervals.append((length, rank, lo, each, capacity - gap))
                    leave(gap - left * length, lo, lo + 1)
                    rank, left, lo = rank + left, 0, lo + 1
                leave(gap, lo, hi)
        self.intervals.sort()
        self.table = np.array(self.intervals, np.int64).reshape(-1, 5)

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        key = (self.table[:, 0] << 48) + self.table[:, 1]
        row = self.table[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
        nth = rank - row[:, 1]
        return row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length


def placed(cut_up: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    counts = cut_up.groupBy("block", "length").agg(F.count("*").alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("block")) - F.col("n")
    base = counts.select("block", "length", earlier.alias("base"))
    plan = Plan({r[0]: r[1] for r in cut_up.groupBy("length").count().collect()}, capacity)  # at most capacity rows
    shared = cut_up.sparkSession.sparkContext.broadcast(plan)
    rows = cut_up.join(base, ["block", "length"]).withColumn("rank", F.col("nth") + F.col("base")).drop("nth", "base", "block")
    at = rows.columns.index("length"), rows.columns.index("rank")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "rank")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(k).to_numpy() for k in at)
            sequence, offset = shared.value.place(length, rank)
            columns = [c for k, c in enumerate(b.columns) if k != at[1]] + [pa.array(sequence), pa.array(offset)]
            names = [n for n in b.schema.names if n != "rank"] + ["sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(scan, kinds + ", sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    Null text is empty: it has its end id, and so has its place. Repeated rows and rows
    without id are documents of their own. An empty table gives no rows; other columns
    are ignored.
    """
    out = placed(pieces(docs, tokenizer, end, capacity), capacity)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and doc_ids and starts of their parts."""
    out = placed(pieces(docs, tokenizer, end, capacity, keep_ids=True), capacity)
    part = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))  # at most capacity ids a group
    rows = out.groupBy("sequence_id").agg(part.alias("p"))
    return rows.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("starts"))
