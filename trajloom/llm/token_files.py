"""Token-id files: one concatenated id array and Elias-Fano coded document boundaries.

File layout, little-endian: the 8 bytes ``TLIDS1\\0\\0``; nine int64 (documents, ids,
bytes of an id, rows without document id, smallest document id, low bits and universe of
the boundaries, the same of the document ids); then the id array; then for both monotone
sequences the packed low bits and the high bits, each padded to 8 bytes.

A monotone sequence of n values up to u keeps l = log2(u / n) low bits of each value as
they are, and the rest as a bit vector that has a one for each value and a zero for each
step of the high part: about 2 + log2(u / n) bits a value, against 64 in an offset table.
``select`` finds the i-th one by the counts of ones before every eighth 64-bit word, in 32
bits (a sixteenth of the high part), and then among the words of that run.

Files are written by tasks to the shared folder under a passing name and then moved, so
a task that runs again, or twice, leaves one whole file with the same content.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_path, stored
from .tokens import Vocabulary, encoded

MAGIC = b"TLIDS1\0\0"
#: Ids in a file before the next one is begun; a document is never split.
FILE_IDS = 4 << 20
#: Words between two counts of ones.
RUN = 8


class EliasFano:
    """A monotone sequence of non-negative integers with access by place: a binary search over sampled counts."""

    def __init__(self, low: np.ndarray, high: np.ndarray, n: int, bits: int):
        self.low, self.high, self.n, self.bits = low, high, n, bits
        ones = np.bitwise_count(high)
        counts = np.add.reduceat(ones, np.arange(0, len(ones), RUN), dtype=np.int64) if len(ones) else ones
        self.before = np.concatenate(([0], np.cumsum(counts))).astype(np.uint32 if n < 1 << 32 else np.uint64)

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        values = values.astype(np.uint64)
        places = np.arange(n, dtype=np.int64) * bits
        low = np.zeros((n * bits + 63) // 64 + 1, np.uint64)
        if bits:
            part = values & np.uint64((1 << bits) - 1)
            word, shift = places >> 6, (places & 63).astype(np.uint64)
            np.bitwise_or.at(low, word, part << shift)
            over = np.flatnonzero((places & 63) + bits > 64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        marks = np.zeros(((universe >> bits) + n) // 64 * 64 + 64, bool)
        marks[ones] = True
        return cls(low, np.packbits(marks, bitorder="little").view(np.uint64), n, bits)

    @staticmethod
    def sizes(n: int, universe: int, bits: int) -> tuple[int, int]:
        """64-bit words of the low and of the high part."""
        return (n * bits + 63) // 64 + 1, ((universe >> bits) + n) // 64 + 1

    def select(self, i: np.ndarray) -> np.ndarray:
        """The values at places ``i``."""
        i = np.asarray(i, np.int64)
        run = np.searchsorted(self.before, i.astype(self.before.dtype), side="right") - 1
        words = np.minimum(run[:, None] * RUN + np.arange(RUN), max(0, len(self.high) - 1))
        upto = self.before[run].astype(np.int64)[:, None] + np.cumsum(np.bitwise_count(self.high[words]), axis=1, dtype=np.int64)
        inside = (upto > i[:, None]).argmax(axis=1)
        word = run * RUN + inside
        ahead = upto[np.arange(len(i)), inside] - np.bitwise_count(self.high[word])
        bits = np.unpackbits(self.high[word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        inner = (np.cumsum(bits, axis=1, dtype=np.int16) == (i - ahead + 1)[:, None]).argmax(axis=1)
        out = (word * 64 + inner - i).astype(np.uint64) << np.uint64(self.bits)
        if self.bits:
            at = i * self.bits
            w, shift = at >> 6, (at & 63).astype(np.uint64)
            part = self.low[w] >> shift
            over = (at & 63) + self.bits > 64
            part[over] |= self.low[w[over] + 1] << (np.uint64(64) - shift[over])
            out |= part & np.uint64((1 << self.bits) - 1)
        return out.astype(np.int64)

    @property
    def nbytes(self) -> int:
        return self.low.nbytes + self.high.nbytes


def pack_file(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """The bytes of one file; documents in ascending order of id, those without id first."""
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    if len(flat) and int(flat.max()) >> (8 * width):
        raise ValueError(f"id {int(flat.max())} does not fit {width} bytes")
    known = [d for d in doc_ids if d is not None]
    first, span = (known[0], known[-1] - known[0]) if known else (0, 0)
    bounds = EliasFano.encode(np.cumsum([len(x) for x in ids], dtype=np.int64), len(flat))
    names = EliasFano.encode(np.array([d - first for d in known], np.uint64), span)
    head = [len(ids), len(flat), width, len(ids) - len(known), first, bounds.bits, len(flat), names.bits, span]
    data = flat.astype(f"<u{width}").tobytes()
    parts = [MAGIC, np.array(head, "<i8").tobytes(), data, bytes(-len(data) % 8)]
    return b"".join([*parts, *(x.tobytes() for ef in (bounds, names) for x in (ef.low, ef.high))])


class TokenFile:
    """A file read back: ids by document place, places by select."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        n, m, width, unnamed, first, b_bits, b_top, d_bits, d_top = np.frombuffer(data, "<i8", 9, 8).tolist()
        self.n, self.unnamed, self.first = n, unnamed, first
        self.ids = np.frombuffer(data, f"<u{width}", m, 80)
        at, found = 80 + -(-m * width // 8) * 8, []
        for count, top, bits in ((n, b_top, b_bits), (n - unnamed, d_top, d_bits)):
            words = []
            for size in EliasFano.sizes(count, top, bits):
                words.append(np.frombuffer(data, "<u8", size, at))
                at += size * 8
            found.append(EliasFano(words[0], words[1], count, bits))
        self.bounds, self.names = found

    def offsets(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First id of the documents at places ``i`` and the one after their last."""
        i = np.asarray(i, np.int64)
        begin = np.zeros(len(i), np.int64)
        begin[i > 0] = self.bounds.select(i[i > 0] - 1)
        return begin, self.bounds.select(i)

    def doc_id(self, i: np.ndarray) -> list[int | None]:
        i = np.asarray(i, np.int64)
        names = self.names.select(i[i >= self.unnamed] - self.unnamed).tolist()
        return [None] * int((i < self.unnamed).sum()) + [self.first + x for x in names]


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _settle(store, passing: str, name: str) -> None:
    """Give a written file its name; one that an earlier run of the task left has the same content and stays."""
    from pyarrow import fs

    there = lambda: store.get_file_info(name).type == fs.FileType.File
    if not there():
        try:
            store.move(passing, name)
            return
        except OSError:
            if not there():
                raise
    store.delete_file(passing)


def write(docs: DataFrame, tokenizer: str, end: int, path: str | None = None, width: int | None = None, file_ids: int = FILE_IDS,
          id_column: str = "doc_id") -> DataFrame:
    """Encode every text and write the files in ascending id order; returns the manifest.

    The manifest has part, file, path, docs, ids and start (ids of all files before).
    Null text is an empty one, so every document has its end id at least. Rows of equal
    ids stand in the order of a hash of their texts; null ids come first. An empty table
    gives no files. ``width`` is the size of an id in bytes, by default what the vocabulary
    needs; an id that does not fit is an error.
    """
    spark = docs.sparkSession
    path = path or new_path(spark, "tokens")
    vocabulary = Vocabulary.load(tokenizer)
    width = width or vocabulary.width
    shared = spark.sparkContext.broadcast(vocabulary)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = [F.asc_nulls_first("doc_id"), F.asc("tie")]
    slim = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text").withColumn("tie", F.xxhash64("text"))
    ranged = slim.repartitionByRange(parts, *key).sortWithinPartitions(*key)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), 0
        store, base = _files(path)
        store.create_dir(base, recursive=True)
        doc_ids: list = []
        ids: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            name = f"{base}/part-{part:06d}-{done:06d}.ids"
            passing = f"{base}/.{uuid.uuid4().hex}"
            with store.open_output_stream(passing) as f:
                f.write(pack_file(doc_ids, ids, width))
            _settle(store, passing, name)
            uri = f"{path}/{name.rsplit('/', 1)[1]}"
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "file": pa.array([done], pa.int32()), "path": [uri],
                                               "docs": [len(ids)], "ids": [size]})

        for b, found in encoded(batches, 1, shared.value, end):
            for doc, own in zip(b.column(0).to_pylist(), found):
                doc_ids.append(doc)
                ids.append(own)
                size += len(own)
                if size >= file_ids:
                    yield flush()
                    doc_ids, ids, size, done = [], [], 0, done + 1
        if ids:
            yield flush()

    made = stored(ranged.select("doc_id", "text").mapInArrow(scan, "part int, file int, path string, docs long, ids long"), "manifest")
    totals = {r[0]: r[1] for r in made.groupBy("part").agg(F.sum("ids")).collect()}  # one row a partition
    before, base = 0, []
    for part in sorted(totals):
        base.append((part, before))
        before += totals[part]
    base = spark.createDataFrame(base, "part int, base long")
    own = F.sum("ids").over(Window.partitionBy("part").orderBy("file")) - F.col("ids")
    return made.join(F.broadcast(base), "part").withColumn("start", F.col("base") + own).drop("base")


def read(manifest: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens and ids_crc32."""
    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                store, name = _files(path)
                with store.open_input_stream(name) as f:
                    held = TokenFile(f.read())
                for lo in range(0, held.n, 4096):
                    at = np.arange(lo, min(held.n, lo + 4096))
                    begin, stop = held.offsets(at)
                    sums = [zlib.crc32(held.ids[x:y].astype("<u4")) for x, y in zip(begin.tolist(), stop.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(held.doc_id(at), pa.int64()), pa.array(start + begin), pa.array(stop - begin), pa.array(sums, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    rows = manifest.select("path", "start").repartition(parts, "path")
    return rows.mapInArrow(scan, "doc_id long, start long, n_tokens long, ids_crc32 long")
