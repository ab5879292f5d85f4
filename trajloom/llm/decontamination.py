"""Benchmark decontamination: one FM-index per training shard, searched backwards for every test window.

A shard is a run of whole documents. Its text is the sequence of their words as ids of
the benchmark's vocabulary. A word that no test window holds can be part of no
occurrence, so runs of such words are one break symbol, as are runs of vocabulary words
shorter than the shortest window. The suffix array of that sequence gives the
Burrows-Wheeler string, kept as a wavelet matrix; a window is found by one rank step for
each of its words, from the last to the first, for all windows at once. Places are read
from suffix positions sampled every few words by walking backwards, and the spans of one
document are merged.

Nothing is shuffled: documents stay in their partition, and only the benchmark travels,
in blocks of ``block_bytes`` of text. Each block is one broadcast of bounded size and one
pass; with several blocks the spans of a document meet in one aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, hits, slices, text_bytes

WINDOW = 13
SHARD_BYTES = 2 << 20
BLOCK_BYTES = 2 << 20
SAMPLE = 8
#: Occurrences located at once; more are taken in turns.
LOCATE = 1 << 20


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        words = np.zeros(len(bits) // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1

    def ones(self, i: np.ndarray) -> np.ndarray:
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & mask)


class Wavelet:
    """A wavelet matrix: the symbols level by level from the highest bit, each level split stably by its bit."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels, self.zeros = [], []
        self.depth = max(1, int(alphabet - 1).bit_length())
        for bit in reversed(range(self.depth)):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append(Bits(ones))
            self.zeros.append(len(ones) - int(ones.sum()))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))
        self.base = np.zeros(alphabet, np.int64)
        self.base = self._down(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _down(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.ones(i)
            i = np.where((symbol >> (self.depth - 1 - level)) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``symbol`` stands before place ``i``."""
        return self._down(symbol, i) - self.base[symbol]

    def at(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at place ``i`` and how often it stands before."""
        symbol = np.zeros(len(i), np.int64)
        for bits, zeros in zip(self.levels, self.zeros):
            one, ones = bits.get(i), bits.ones(i)
            symbol = symbol * 2 + one
            i = np.where(one, zeros + ones, i - ones)
        return symbol, i - self.base[symbol]


def suffix_array(rank: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length until all differ."""
    n = len(rank)
    order = np.argsort(rank, kind="stable")
    length = 1
    while True:
        new = np.empty(n, np.int64)
        key = rank[order]
        if length > 1:
            key = pair[order]
        new[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank = new
        if int(rank[order[-1]]) == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: max(0, n - length)] = rank[length:] + 1
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        length *= 2


class FmIndex:
    """An FM-index of a sequence in which symbol 0 is a break that nothing matches."""

    def __init__(self, symbols: np.ndarray, alphabet: int, sample: int = SAMPLE):
        n = len(symbols)
        breaks = symbols == 0
        rank = symbols + n
        rank[breaks] = np.arange(int(breaks.sum()))  # breaks differ, so comparisons end with the run
        suffixes = suffix_array(rank)
        before = symbols[suffixes - 1]
        self.wavelet = Wavelet(before, alphabet)
        counts = np.bincount(symbols, minlength=alphabet)
        self.less = np.cumsum(counts) - counts
        kept = (suffixes % sample == 0) | (before == 0)  # never step over a break
        self.kept, self.places = Bits(kept), suffixes[kept]
        self.n = n

    def find(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of the suffixes that begin with each pattern; patterns are right-aligned."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        for step in range(width):
            live = np.flatnonzero((lengths > step) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, width - 1 - step]
            ends = self.wavelet.rank(np.tile(symbol, 2), np.concatenate((low[live], high[live])))
            low[live] = self.less[symbol] + ends[: len(live)]
            high[live] = self.less[symbol] + ends[len(live) :]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of suffix rows."""
        out, steps, live = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(live):
            known = self.kept.get(rows)
            out[live[known]] = self.places[self.kept.ones(rows[known])] + steps
            live, rows = live[~known], rows[~known]
            symbol, nth = self.wavelet.at(rows)
            rows = self.less[symbol] + nth
            steps += 1
        return out


class Windows:
    """The distinct windows of a benchmark block, as vocabulary ids, and the items that hold each."""

    def __init__(self, items: list, texts: list, width: int):
        data, offsets = text_bytes(pa.array(texts, pa.large_string()))
        words = Words(data, offsets, "alnum")
        self.vocabulary, ids = np.unique(words.hash, return_inverse=True)
        first_use = np.unique(ids, return_index=True)[1] if len(ids) else np.zeros(0, int)
        self.spelling = [words.data[words.start[k] : words.end[k]].tobytes() for k in first_use]
        found: dict[tuple, set] = {}
        for k, item in enumerate(items):
            own = ids[words.first[k] : words.first[k + 1]] + 1
            for at in range(max(1, len(own) - width + 1) if len(own) else 0):
                found.setdefault(tuple(own[at : at + width].tolist()), set()).add(item)
        keys = list(found)
        self.items = [found[k] for k in keys]
        self.lengths = np.array([len(k) for k in keys], np.int64)
        self.table = np.zeros((len(keys), width), np.int64)
        for k, key in enumerate(keys):
            self.table[k, width - len(key) :] = key
        self.shortest = int(self.lengths.min()) if len(keys) else 0
        long = max(map(len, self.spelling), default=1)
        self.letters = np.zeros((len(self.spelling), long), np.uint8)
        for k, word in enumerate(self.spelling):
            self.letters[k, : len(word)] = np.frombuffer(word, np.uint8)

    def ids(self, words: Words) -> np.ndarray:
        """1-based vocabulary id of each word, 0 for others; spellings are compared, so equal hashes do not matter."""
        ids = hits(words.hash, self.vocabulary)
        known = np.flatnonzero(ids >= 0)
        want = self.letters[ids[known]]
        size = words.end[known] - words.start[known]
        fits = size <= want.shape[1]
        for k in range(want.shape[1]):
            at = np.minimum(words.start[known] + k, len(words.data) - 1)
            fits &= np.where(k < size, words.data[at], 0) == want[:, k]
        ids[known[~fits]] = -1
        return ids + 1


def search(words: Words, windows: Windows, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Every occurrence of a window: the place of its first word, and the window."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(windows.lengths) or not len(words.start):
        return none
    ids = windows.ids(words)
    new_row = np.zeros(len(ids), bool)
    new_row[words.first[:-1][words.count > 0]] = True
    begins = (ids > 0) & (new_row | np.concatenate(([True], ids[:-1] == 0)))
    ends = (ids > 0) & np.concatenate((new_row[1:] | (ids[1:] == 0), [True]))
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = end - start >= windows.shortest
    start, end = start[long], end[long]
    if not len(start):
        return none
    size = end - start
    into = np.cumsum(size + 1) - size  # a break before each run
    place = np.zeros(int(size.sum()) + len(size), np.int64)
    run = np.repeat(np.arange(len(size)), size)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    place[into[run] + inner] = start[run] + inner
    symbols = np.zeros(len(place), np.int64)
    symbols[into[run] + inner] = ids[start[run] + inner]
    index = FmIndex(symbols, len(windows.vocabulary) + 1, sample)
    low, high = index.find(windows.table, windows.lengths)
    count = high - low
    at, which = [], []
    hot = np.flatnonzero(count)
    for part in np.array_split(hot, max(1, -(-int(count.sum()) // LOCATE))):
        own = np.repeat(part, count[part])
        rows = low[own] + np.arange(len(own)) - np.repeat(np.cumsum(count[part]) - count[part], count[part])
        at.append(place[index.locate(rows)])
        which.append(own)
    return np.concatenate(at), np.concatenate(which)


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals as disjoint, non-adjacent ones in order."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1) if len(start) else np.zeros(0, int)
    return start[new], reach[last]


def _marks(blocks: Iterator[pa.RecordBatch], windows: Windows, shard: int, out: pa.Schema):
    """One row per document: words, merged hit spans in words and bytes, and the items found."""
    for block in blocks:
        for batch in slices(block, "text", shard):
            data, offsets = text_bytes(batch.column(1))
            words = Words(data, offsets, "alnum")
            at, which = search(words, windows)
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            items: list[set] = [set() for _ in range(batch.num_rows)]
            hit = np.searchsorted(words.first, at, side="right") - 1
            for row, k in {*zip(hit.tolist(), which.tolist())}:
                items[row] |= windows.items[k]
            order = np.argsort(hit, kind="stable")
            edges = np.searchsorted(hit[order], np.arange(batch.num_rows + 1))
            for row in np.flatnonzero(np.diff(edges)).tolist():
                own = order[edges[row] : edges[row + 1]]
                lo, hi = merge(at[own], at[own] + windows.lengths[which[own]])
                base, byte = words.first[row], offsets[row]
                spans[row] = [
                    {"word": int(s - base), "words": int(e - s), "start": int(words.start[s] - byte), "end": int(words.end[e - 1] - byte)}
                    for s, e in zip(lo.tolist(), hi.tolist())
                ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(words.count, pa.int64()), pa.array(spans, out.field("spans").type)]
                + [pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                schema=out,
            )


def occurrences(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
                shard_bytes: int = SHARD_BYTES, id_column: str = "doc_id") -> DataFrame:
    """One row per document: ``n_words``, merged ``spans`` and the ``items`` with occurring windows.

    Spans hold the first word and number of words, and UTF-8 byte places (end exclusive).
    Null text has no words; null item texts, items without words and null item ids match
    nothing. Repeated items and rows count as they stand; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("key"))
    tests = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string"), "text")
    blocks = max(1, -(-int(tests.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    schema = "doc_id long, key long, n_words long, spans array<struct<word:int,words:int,start:long,end:long>>, items array<string>"
    span = pa.struct([("word", pa.int32()), ("words", pa.int32()), ("start", pa.int64()), ("end", pa.int64())])
    out = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.string()))])
    found = None
    for block in range(blocks):
        own = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = own.collect()  # at most about block_bytes of text
        shared = spark.sparkContext.broadcast(Windows([r[0] for r in rows], [r[1] for r in rows], window))

        def scan(batches, shared=shared):
            return _marks(batches, shared.value, shard_bytes, out)

        marks = docs.mapInArrow(scan, schema)
        found = marks if found is None else found.union(marks)
    if blocks == 1:
        return found.drop("key")
    return _joined(found, blocks)


def _joined(found: DataFrame, blocks: int) -> DataFrame:
    """Marks of several benchmark blocks brought together by document and text; repeated rows stay repeated."""
    after = lambda x: x["word"] + x["words"]
    last = lambda done: F.element_at(done, -1)

    def add(done, x):
        wider = F.struct(
            last(done)["word"].alias("word"),
            (F.greatest(after(last(done)), after(x)) - last(done)["word"]).alias("words"),
            last(done)["start"].alias("start"),
            F.greatest(last(done)["end"], x["end"]).alias("end"),
        )
        touches = (F.size(done) > 0) & (after(last(done)) >= x["word"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(x))
        )

    empty = F.expr("cast(array() as array<struct<word:int,words:int,start:long,end:long>>)")
    met = found.groupBy("doc_id", "key", "n_words").agg(
        F.array_sort(F.flatten(F.collect_set("spans"))).alias("s"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count("*") / blocks).cast("int").alias("copies"),
    )
    met = met.withColumn("spans", F.aggregate("s", empty, add))
    return met.select("doc_id", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


def contamination(docs: DataFrame, benchmark: DataFrame, share: int = 20, **options) -> DataFrame:
    """Per document the numbers of words, hit words and found items, a digest of the items, and the verdict.

    A document is contaminated if at least one word in ``share`` is hit.
    """
    marks = occurrences(docs, benchmark, **options)
    hit = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["words"]), F.lit(0).cast("long"))
    return marks.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((hit > 0) & (F.lit(share) * hit >= F.col("n_words"))).alias("contaminated"), "spans", "items",
    )
