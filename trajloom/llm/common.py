"""Helpers shared by the operators: written tables, byte buffers of text columns, word hashes, components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.ones(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = False
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[97:123] = _ALNUM[128:] = True
#: Bytes that belong to a word, by kind of word; multi-byte characters belong wholly to one.
WORD_BYTES = {"alnum": _ALNUM, "unspaced": _SPACE}
_BYTE_KEY = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def folder(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``; only a local master without it gets its own."""
    sc = spark.sparkContext
    name = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not name:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        name = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", name)
    return name.rstrip("/")


def new_path(spark: SparkSession, kind: str) -> str:
    return f"{folder(spark)}/llm/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, so that later jobs do not run it again."""
    spark = df.sparkSession
    path = new_path(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files behind a table of :func:`stored` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm/" in name:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


#: What worker processes keep from task to task, by operator.
_KEPT: dict[str, dict] = {}


def kept(owner: str | None) -> dict:
    """The cache of one operator in this worker; those of all others are dropped, as their tasks have passed."""
    for name in [n for n in _KEPT if n != owner]:
        del _KEPT[name]
    if owner != "hashes":
        _TABLES[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
    return _KEPT.setdefault(owner, {}) if owner else {}


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows holding about ``size`` bytes of text each; a row is never cut."""
    ends = text_bytes(batch.column(column))[1]
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets of its rows; a null row is empty."""
    column = column.cast(pa.large_string()) if column.type != pa.large_string() else column
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


class Words:
    """Words of the rows of a text column.

    ``start`` and ``end`` are byte places in the joined buffer, ``row`` the row of each
    word, ``first`` the n + 1 places in these arrays where a row's words begin, and
    ``hash`` a 64-bit hash of each word after A-Z became a-z.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: str):
        kept("hashes")
        self.offsets = offsets
        self.data = low = _LOWER[data]
        inside = WORD_BYTES[kind][low]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(low))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    @property
    def hash(self) -> np.ndarray:
        powers, inverse = _powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_KEY[self.data] * powers[: len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start])


_TABLES: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_TABLES[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            steps = np.full(n + n // 4, base, np.uint64)
            steps[0] = 1
            _TABLES[k] = np.cumprod(steps, dtype=np.uint64)
    return _TABLES


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hits(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted array ``wanted``, or -1."""
    if not len(wanted) or not len(values):
        return np.full(len(values), -1, np.int64)
    bits = np.uint64(64 - 20)
    seen = np.zeros(1 << 20, bool)
    seen[wanted >> bits] = True
    out = np.full(len(values), -1, np.int64)
    maybe = np.flatnonzero(seen[values >> bits])
    at = np.minimum(np.searchsorted(wanted, values[maybe]), len(wanted) - 1)
    right = wanted[at] == values[maybe]
    out[maybe[right]] = at[right]
    return out


def stars(linked: np.ndarray, ids: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that span the components of a block of links between ``ids`` (rows) and ``others`` (columns)."""
    rows, cols = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    linked = linked[np.ix_(rows, cols)]
    left, right = ids[rows], others[cols]
    top = np.iinfo(np.int64).max
    while True:
        new_left = np.minimum(left, np.where(linked, right[None, :], top).min(1))
        new_right = np.minimum(right, np.where(linked, new_left[:, None], top).min(0))
        if (new_left == left).all() and (new_right == right).all():
            break
        left, right = new_left, new_right
    a, b = np.concatenate((ids[rows], others[cols])), np.concatenate((left, right))
    return a[a != b], b[a != b]


def components(links: DataFrame) -> DataFrame:
    """Connected components of the undirected ``links`` (a, b): columns node, component (its smallest node).

    Alternates large-star and small-star steps until no edge changes; each step is two
    map-side combined aggregates, so a node with very many links costs no task more than
    its share, and the edge table is written once a step. Self links are ignored.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links"
    )
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        big = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = big.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        new = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        new = stored(new, "links")
        mark = F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")
        was, now = edges.agg(*mark).first(), new.agg(*mark).first()
        forget(edges)
        edges = new
        if was == now:
            break
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
