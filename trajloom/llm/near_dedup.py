"""MinHash near-dedup by an inverted join of signature coordinates.

1. *Sketch.* A document is its set of word shingles. Each of ``K`` coordinates keeps the
   smallest value of one hash over the set. Documents of equal sets (a 128-bit
   fingerprint) form a class and only its smallest id goes on, so copies cost nothing.
2. *Prefix.* Two signatures that agree in ``T`` coordinates share one of the ``K - T + 1``
   first entries of any common order of (coordinate, value) pairs. Entries are ordered
   rarest first, by counts over the whole corpus, hashed to a table of bounded size.
   A document is posted under its prefix entries only.
3. *First pairs.* Each document is paired with the first document of the list they share
   most often; collisions are counted and the pair is confirmed on the full sets. That
   links groups of thousands of near copies at one confirmation a document.
4. *Merge and skip.* Lists whose documents are all in one component are skipped. The others
   are merged in blocks of bounded size: a pair counts in the first list that both
   documents share, if their sizes allow the similarity, and what reaches ``T`` collisions
   stays. A document with such a partner is sent, once
   for each block, with its text, and the block is compared on the full sets. What
   travels is documents, never pairs, and a block returns stars that span its links.
5. Components of the confirmed links.

A pair of similarity 0.8 misses ``T`` = 15 of ``K`` = 32 collisions with probability
below 1e-5, less above; everything after that is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, components, forget, mix, slices, stars, stored, text_bytes

K, T = 32, 15
WIDTH = 5
#: Slots of the table of entry counts.
SLOTS = 1 << 18
#: Documents of one list merged in one group; longer lists are merged block by block.
BLOCK = 512
#: Members confirmed against one document in one group.
MEMBERS = 256
#: Documents whose full sets are compared at once.
COMPARED = 1024
SLICE = 1 << 20
#: Pairs of a merge compared at once.
PAIRS = 1 << 20
#: Up to so many ids are sent to all executors (8 MB); beyond, texts are joined by shuffle.
SENT_IDS = 1 << 20
#: A key that more than this part of all rows have is joined by sending its one row to them; there are fewer than so many.
SPREAD = 1000

_MUL = mix(np.arange(1, K + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row."""
    words = Words(data, offsets, "unspaced")
    h = words.hash
    out = []
    if len(h) >= width:
        joined = h[: len(h) - width + 1].copy()
        for k in range(1, width):
            joined = joined * _STEP + h[k : len(h) - width + 1 + k]
        joined = mix(joined)
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if hi - lo >= width:
            out.append(np.unique(joined[lo : hi - width + 1]))
        elif hi > lo:
            one = np.array([hi - lo], np.uint64)
            for x in h[lo:hi]:
                one = mix(one * _STEP + x)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Signature of each set, one row of ``K`` 32-bit values; an empty set has all ones."""
    out = np.full((len(sets), K), 0xFFFFFFFF, np.uint32)
    full = np.array([k for k, s in enumerate(sets) if len(s)], np.int64)
    if not len(full):
        return out
    h = (np.concatenate([sets[k] for k in full]) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(sets[k]) for k in full])[:-1]))
    for c in range(K):
        v = h * _MUL[c]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        out[full, c] = np.minimum.reduceat(v, starts)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    size = rows.shape[1] * rows.itemsize
    ends = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.BinaryArray.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures of a binary column."""
    if not len(column):
        return np.zeros((0, K), np.uint32)
    data, at = np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int32)
    lo = int(at[column.offset])
    return data[lo : lo + len(column) * K * 4].view(np.uint32).reshape(-1, K)


def sketch(docs: DataFrame, width: int) -> DataFrame:
    """Per document the size of its set, a 128-bit fingerprint of it, and the signature."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                sets = shingle_sets(*text_bytes(b.column(1)), width)
                prints = [np.array([(mix(s ^ salt)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                          for salt in (np.uint64(0x51ED270B), np.uint64(0xA5A5F00D))]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[0]), pa.array(prints[1])]
                    + [_binary(signatures(sets))],
                    names=["doc_id", "n", "p", "q", "sig"],
                )

    return docs.mapInArrow(scan, "doc_id long, n long, p long, q long, sig binary")


def _entries(sig: np.ndarray) -> np.ndarray:
    """(coordinate, value) pairs as 64-bit entries."""
    return mix(sig.astype(np.uint64) | (np.arange(1, K + 1, dtype=np.uint64) << np.uint64(32)))


_SHIFT = np.uint64(64 - SLOTS.bit_length() + 1)


def entry_counts(classes: DataFrame) -> np.ndarray:
    """How many entries of the corpus fall into each slot."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for b in batches:
            total += np.bincount((_entries(_matrix(b.column(0))) >> _SHIFT).astype(np.int64).ravel(), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["slot", "n"])

    counts = np.zeros(SLOTS, np.int64)
    rows = classes.select("sig").mapInArrow(scan, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    for slot, n in rows.collect():  # at most SLOTS rows
        counts[slot] = n
    return counts


def _prefix(sig: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of the rarest ``K - T + 1`` entries of each signature in order, and the entries."""
    entries = _entries(sig)
    first = np.lexsort((entries, counts[(entries >> _SHIFT).astype(np.int64)]), axis=1)[:, : K - T + 1]
    return first, np.take_along_axis(entries, first, 1).view(np.int64)


def postings(classes: DataFrame, shared) -> DataFrame:
    """The prefix entries of each class; ``shared`` is the broadcast of the entry counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = _prefix(_matrix(b.column(1)), shared.value)[1]
            ids = np.repeat(b.column(0).to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(ids)], names=["entry", "id"])

    return classes.select("id", "sig").mapInArrow(scan, "entry long, id long")


def _agree(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures ``sa`` and ``sb`` collide often enough."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hit = (_matrix(b.column(2)) == _matrix(b.column(3))).sum(1) >= T
            yield b.select([0, 1]).filter(pa.array(hit))

    return pairs.select("a", "b", "sa", "sb").mapInArrow(scan, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) with at least ``percent`` similarity of their full shingle sets.

    The members b of one a come in groups of bounded size, each beside a copy of a's text,
    and are read as a sorted stream.
    """
    spark = pairs.sparkSession
    pairs = stored(pairs, "pairs")
    size = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("groups"))
    split = pairs.join(size, "a").withColumn("g", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int"))
    wanted = split.select("a", "g", F.lit(1).alias("role"), F.col("b").alias("id")).union(
        size.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("g"), F.lit(0).alias("role"), F.col("a").alias("id"))
    )
    texts = _texts(docs, pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = wanted.join(texts, "id").select("a", "g", "role", "id", "text")
    rows = rows.repartition(parts, "a", "g").sortWithinPartitions("a", "g", "role")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, np.zeros(0, np.uint64)
        for whole in batches:
            for b in slices(whole, "text", SLICE):
                sets = shingle_sets(*text_bytes(b.column(4)), width)
                a, g, role, ids = (b.column(k).to_pylist() for k in range(4))
                out: list[list] = [[], []]
                for k, s in enumerate(sets):
                    if role[k] == 0:
                        key, own = (a[k], g[k]), s
                    elif key == (a[k], g[k]) and len(s) and len(own):
                        small, large = (s, own) if len(s) < len(own) else (own, s)
                        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        both = int((large[at] == small).sum())
                        if 100 * both >= percent * (len(s) + len(own) - both):
                            out[0].append(a[k])
                            out[1].append(ids[k])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    return stored(rows.mapInArrow(scan, "a long, b long"), "links")


def _groups(batches: Iterator[pa.RecordBatch], keys: int, rows: int) -> Iterator[pa.Table]:
    """Whole groups of a stream sorted by its first ``keys`` columns, together up to ``rows`` rows or one group."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for b in batches:
        key = np.stack([b.column(k).to_numpy() for k in range(keys)])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        edges = [0, *cuts.tolist(), b.num_rows] if b.num_rows else []
        begin = 0
        for lo, hi in zip(edges[:-1], edges[1:]):
            now = tuple(key[:, lo].tolist())
            if now != last and size + (hi - lo) > rows and size:
                if lo > begin:
                    held.append(b.slice(begin, lo - begin))
                yield pa.Table.from_batches(held)
                held, size, begin = [], 0, lo
            size, last = size + hi - lo, now
        if b.num_rows > begin:
            held.append(b.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _blocks(lists: DataFrame) -> DataFrame:
    """Rows dealt into pairs of blocks (i, j) of their list and sorted by them; ``own`` is the row's own block."""
    parts = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = lists.withColumn("k", F.ceil(F.col("size") / BLOCK).cast("int"))
    own = own.withColumn("own", F.pmod(F.xxhash64("id", "entry"), F.col("k")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    own = own.select(
        "entry", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "part", "n", "sig"
    )
    key = ["entry", "i", "j"]
    return own.repartition(parts, *key).sortWithinPartitions(*key)


def _candidates(lists: DataFrame, shared, percent: int) -> DataFrame:
    """The rows of each block that have a partner of another component with enough collisions in it.

    ``lists`` holds entry, size, id, part (component), n and sig.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches, 3, 4096):
            key = np.stack([t.column(k).to_numpy() for k in range(3)])
            own, part, n = (t.column(k).to_numpy() for k in (3, 5, 6))
            sig = _matrix(t.column(7).combine_chunks())
            first, entries = _prefix(sig, shared.value)
            bits = np.int64(1) << first
            here = (entries == key[0][:, None]).argmax(1)
            before = (np.cumsum(bits, axis=1) - bits)[np.arange(len(here)), here]  # coordinates of rarer entries
            ends = np.append(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, t.num_rows)
            later = ends[np.searchsorted(ends, np.arange(t.num_rows), side="right")] - np.arange(t.num_rows) - 1
            within = key[1] == key[2]
            wanted = np.zeros(t.num_rows, bool)
            turns = np.cumsum(later) // PAIRS
            for turn in np.unique(turns):
                rows = np.flatnonzero(turns == turn)
                u = np.repeat(rows, later[rows])
                v = u + 1 + np.arange(len(u)) - np.repeat(np.cumsum(later[rows]) - later[rows], later[rows])
                ok = (part[u] != part[v]) & (within[u] | (own[u] != own[v]))
                ok &= 100 * np.minimum(n[u], n[v]) >= percent * np.maximum(n[u], n[v])
                u, v = u[ok], v[ok]
                for at in range(0, len(u), 1 << 16):
                    x, y = u[at : at + (1 << 16)], v[at : at + (1 << 16)]
                    equal = sig[x] == sig[y]
                    ok = equal.sum(1) >= T
                    x, y, equal = x[ok], y[ok], equal[ok]
                    packed = np.zeros((len(x), 8), np.uint8)
                    packed[:, : K // 8] = np.packbits(equal, axis=1, bitorder="little")
                    fresh = (packed.view(np.int64).ravel() & before[x] & before[y]) == 0
                    wanted[x[fresh]] = wanted[y[fresh]] = True
            yield from t.filter(pa.array(wanted)).select(range(6)).combine_chunks().to_batches()

    schema = "entry long, i int, j int, own int, id long, part long"
    return stored(_blocks(lists).mapInArrow(scan, schema), "candidates")


def shared_counts(sets: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    """Sizes of the pairwise intersections of sets of one group; 0 across groups.

    Shingles that many sets hold are counted by a matrix product, the others by their pairs.
    """
    n = len(sets)
    out = np.zeros((n, n), np.float32)
    size = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(n), size)
    value = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    value = mix(value ^ mix(group.astype(np.uint64))[row])
    order = np.argsort(value, kind="stable")
    value, row = value[order], row[order]
    begins = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, int)
    count = np.diff(np.append(begins, len(value)))
    many = count > max(2, n // 16)
    columns = np.flatnonzero(many)
    for at in range(0, len(columns), 2048):
        own = columns[at : at + 2048]
        flat = np.repeat(begins[own] - np.concatenate(([0], np.cumsum(count[own])[:-1])), count[own]) + np.arange(int(count[own].sum()))
        dense = np.zeros((n, len(own)), np.float32)
        dense[row[flat], np.repeat(np.arange(len(own)), count[own])] = 1
        out += dense @ dense.T
    left = np.where(many, 0, count)
    ends = np.repeat(begins + left, count)
    later = np.maximum(ends - np.arange(len(value)) - 1, 0)
    turns = np.cumsum(later) // (1 << 21)
    for turn in np.unique(turns[later > 0]):
        own = np.flatnonzero((turns == turn) & (later > 0))
        x = np.repeat(own, later[own])
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(later[own]) - later[own], later[own])
        pairs = np.bincount(row[x] * n + row[y], minlength=n * n).reshape(n, n)
        out += pairs + pairs.T
    return out


def _compared(rows: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between documents of each block, on their full sets, as stars that span them."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = _texts(docs, rows.select("id").distinct())
    key = ["entry", "i", "j"]
    rows = rows.join(texts, "id").select(*key, "own", "id", "part", "text").repartition(parts, *key).sortWithinPartitions(*key)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups((s for b in batches for s in slices(b, "text", SLICE)), 3, COMPARED):
            key = np.stack([t.column(k).to_numpy() for k in range(3)])
            own, ids, part = (t.column(k).to_numpy() for k in range(3, 6))
            group = np.cumsum(np.append(0, (key[:, 1:] != key[:, :-1]).any(0)))
            sets = [s for c in t.column(6).chunks for s in shingle_sets(*text_bytes(c), width)]
            both = shared_counts(sets, group).astype(np.float64)
            size = np.array([len(s) for s in sets])
            linked = (100 * both >= percent * (size[:, None] + size[None, :] - both)) & (group[:, None] == group[None, :])
            linked &= (part[:, None] != part[None, :]) & (size > 0)
            linked &= (key[1] == key[2])[:, None] | (own[:, None] != own[None, :])
            a, b = stars(linked, ids, ids)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return stored(rows.mapInArrow(scan, "a long, b long"), "links")


def _texts(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Texts of the documents of ``ids``, sent to all executors only if they are few."""
    ids = stored(ids, "ids")
    few = ids.count() <= SENT_IDS
    return docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(ids) if few else ids, "id", "left_semi")


def _members(every: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (doc_id, n) with the name of their class, null for rows that have none.

    Classes of more than a thousandth of all rows are sent to the rows, a thousand at most;
    so no task gets more than that share of the rows by one key. Rows without words or id
    belong to no class and do not meet any.
    """
    rows = every.select("doc_id", "n", "p", "q")
    own = rows.where("n > 0 and doc_id is not null")
    least = max(1, rows.count() // SPREAD)
    found = _dealt(own, classes.select("p", "q", "n", "id", "copies"), ["p", "q", "n"], "copies", least)
    none = rows.where("n = 0 or doc_id is null").select("doc_id", "n", F.lit(None).cast("long").alias("id"))
    return found.select("doc_id", "n", "id").union(none)


def _dealt(rows: DataFrame, table: DataFrame, keys: list[str], size: str, least: int) -> DataFrame:
    """Inner join with a table of one row a key; keys of more than ``least`` rows are sent, the others shuffled."""
    large, small = table.where(F.col(size) > least), table.where(F.col(size) <= least)
    hot = rows.join(F.broadcast(large), keys)
    rest = rows.join(F.broadcast(large.select(keys)), keys, "left_anti").join(small, keys)
    return hot.unionByName(rest)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (smallest id reachable by links) and kept.

    Links join documents whose sets of ``width``-word shingles have a Jaccard similarity of
    ``percent`` or more (80 or more: the number of collisions asked for fits no less). A
    document of fewer words has its whole word sequence as its one shingle; null, empty
    and blank texts have none and link with nothing. Ids name documents: repeated rows are
    one node, and all of them are kept or none. A row without id links with nothing and is
    kept with a null component. An empty table gives no rows; other columns are ignored.
    """
    if percent < 80:
        raise ValueError("the prefix is laid out for similarities of 80 percent or more")
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    every = stored(sketch(docs, width), "sketch")
    classes = stored(
        every.where("n > 0 and doc_id is not null").groupBy("p", "q", "n").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.count("*").alias("copies")),
        "classes",
    )
    shared = spark.sparkContext.broadcast(entry_counts(classes))
    every_post = stored(postings(classes, shared), "postings")
    lists = every_post.groupBy("entry").agg(F.min("id").alias("a"), F.count("*").alias("size")).where("size > 1")
    most = max(1, every_post.count() // SPREAD)
    posts = stored(_dealt(every_post, lists, ["entry"], "size", most), "lists")
    forget(every_post)
    sigs = classes.select("id", "sig")
    met = posts.where("id <> a").groupBy("id", "a").count()
    pairs = met.groupBy(F.col("id").alias("b")).agg(F.max(F.struct("count", (-F.col("a")).alias("a"))).alias("m"))
    pairs = pairs.select("b", (-F.col("m.a")).alias("a"))  # the first of a list with which most lists are shared
    pairs = pairs.join(sigs.toDF("b", "sb"), "b").join(sigs.toDF("a", "sa"), "a")
    links = confirmed(_agree(pairs), docs, width, percent)
    nodes = stored(components(links), "nodes")
    part = F.coalesce("component", "id").alias("part")
    named = posts.join(nodes.withColumnRenamed("node", "id"), "id", "left").select("entry", "size", "id", part)
    named = stored(named, "named")
    forget(posts)
    live = named.groupBy("entry").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("_size"))
    live = live.where("lo < hi").select("entry", "_size")
    rows = _dealt(named, live, ["entry"], "_size", most).drop("_size").join(classes.select("id", "n", "sig"), "id")
    links = links.union(_compared(_candidates(rows, shared, percent), docs, width, percent))
    member = stored(_members(every, classes), "members")
    ids = member.where("id is not null").select("doc_id", "id").distinct()
    if not ids.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").isEmpty():
        links = links.union(ids.where("doc_id <> id").toDF("a", "b"))  # an id of several texts is one node
    nodes = stored(components(links), "nodes")
    member = member.join(nodes.withColumnRenamed("node", "id"), "id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
    return member.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
