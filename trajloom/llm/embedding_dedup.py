"""Embedding near-dedup by int8 tile products with error bounds.

Equal vectors form a class and one of them goes on. Classes are dealt into bands by a
hash, and every pair of bands is one group of work of bounded size and one task: an
all-pairs search in blocks, whose work is quadratic by its contract. A vector travels once
for each band, so bands are as few as the tasks and their memory allow. A group goes
through its bands tile by tile.

In a tile every unit vector u is quantised to u' = s * q with int8 q, and the length of
its error e = u - u' is kept. Then u.v differs from u'.v' by at most
|u'||e_v| + |e_u||v'| + |e_u||e_v|, whatever the vectors. A scale s is a power of two, so
that u'.v' is a sum of whole numbers below 2^24 times one power of two, and exact in a float32
matrix product. One comparison with the largest bound of two tiles leaves the rows and
columns that may hold links; only there each pair gets its own bound. Pairs certainly above
or below the threshold are settled; the rest, a few thousandths, is computed again in double
precision from the vectors themselves.

Links are counted where they are found and never listed: a group returns the number of
links of each vector and, for each block of rows, the stars that span its components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stars, stored

THRESHOLD = 0.9
TILE = 4096
ROWS, COLUMNS = 512, 1024
#: Components of a band, unless one tile has more.
BAND = 1 << 22
#: Covers the rounding of double and float32 arithmetic around the bound.
SLACK = 1e-6
#: Above this share of open pairs a block is first multiplied in double precision, which settles all but this distance.
DENSE, ROUNDING = 0.02, 1e-9


class Tile:
    """Unit vectors, their int8 form, and what its error can do."""

    def __init__(self, vectors: np.ndarray):
        v = vectors.astype(np.float64)
        top = np.abs(v).max(1, keepdims=True)
        length = np.linalg.norm(v / top, axis=1)[:, None]
        self.unit = v / length / top
        self.scale = np.ldexp(1.0, np.frexp((top / length / top)[:, 0] / 127)[1])
        q = np.rint(self.unit / self.scale[:, None])
        self.q = q.astype(np.int8)
        near = q * self.scale[:, None]
        self.error = np.linalg.norm(self.unit - near, axis=1)
        self.length = np.linalg.norm(near, axis=1)

    @property
    def near(self) -> np.ndarray:
        """The quantised vectors u', which float32 holds exactly."""
        return self.q * self.scale[:, None].astype(np.float32)


def products(left: np.ndarray, right: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    """Exact products of all rows of two :attr:`Tile.near`."""
    step = 1024  # so many products of int8 stay below 2^24
    if left.shape[1] <= step:
        return np.matmul(left, right.T, out=out)
    return sum((left[:, k : k + step] @ right[:, k : k + step].T).astype(np.float64) for k in range(0, left.shape[1], step))


def links(x: Tile, y: Tile, threshold: float = THRESHOLD, rows: int = ROWS) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, block of booleans) of the pairs with cosine at or above the threshold; blocks without one may be left out."""
    whole, right = x.near, y.near
    most = x.length.max() * y.error.max() + x.error.max() * (y.length.max() + y.error.max()) + SLACK
    least = np.float32(threshold - most)
    space = np.empty((rows, COLUMNS), np.float32)
    for lo in range(0, len(x.q), rows):
        left = whole[lo : lo + rows]
        linked = np.empty((len(left), len(right)), bool)
        for k in range(0, len(right), COLUMNS):
            part = right[k : k + COLUMNS]
            dot = products(left, part, space[: len(left), : len(part)])
            np.greater_equal(dot, least, out=linked[:, k : k + COLUMNS])
        i, j = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
        if not len(i):
            continue
        at = lo + i
        dot = products(left[i], right[j])
        e, n = x.error[at, None], x.length[at, None]
        bound = (n * y.error[j] + e * (y.length[j] + y.error[j]) + SLACK).astype(np.float32)
        sure = dot - bound >= threshold
        unsettled = (dot + bound >= threshold) & ~sure
        if np.count_nonzero(unsettled) > DENSE * unsettled.size:
            dot = x.unit[at] @ y.unit[j].T
            sure |= unsettled & (dot >= threshold + ROUNDING)
            unsettled &= np.abs(dot - threshold) < ROUNDING
        u, v = np.divmod(np.flatnonzero(unsettled), len(j))
        for k in range(0, len(u), 1 << 16):
            a, b = u[k : k + (1 << 16)], v[k : k + (1 << 16)]
            sure[a, b] = np.einsum("ij,ij->i", x.unit[at[a]], y.unit[j[b]]) >= threshold
        linked[np.ix_(i, j)] = sure
        yield lo, linked


def band_count(classes: int, components: int, tile: int, parts: int) -> int:
    """Bands of one tile at least: as few as make two groups for each of ``parts`` and keep to the size of a band."""
    wanted = math.ceil((math.sqrt(1 + 16 * parts) - 1) / 2)
    return max(1, min(-(-classes // tile), max(wanted, -(-components // BAND))))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group (first column), which follow each other."""
    rest: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        group = batch.column(0).to_numpy()
        edges = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi > lo:
                if rest and key != group[lo]:
                    yield pa.Table.from_batches(rest)
                    rest = []
                key = group[lo]
                rest.append(batch.slice(lo, hi - lo))
    if rest:
        yield pa.Table.from_batches(rest)


def _work(t: pa.Table, threshold: float, tile: int) -> Iterator[tuple]:
    """Counts (id, links) and edges of one pair of bands."""
    side, ids, copies = (t.column(k).to_numpy() for k in (1, 2, 3))
    vectors = t.column(4).combine_chunks()
    size = pc.list_value_length(vectors).to_numpy()
    same = side[0] == 0
    for dim in np.unique(size):

        def tiles(rows: np.ndarray, dim: int = dim) -> list[tuple]:
            """(ids, copies, links so far, vectors) of each tile of a band."""
            rows = np.flatnonzero(rows & (size == dim))
            cut = (rows[at : at + tile] for at in range(0, len(rows), tile))
            return [(ids[k], copies[k], np.zeros(len(k), np.int64), Tile(vectors.take(pa.array(k)).flatten().to_numpy().reshape(-1, dim))) for k in cut]

        left = tiles(side <= 0)
        right = left if same else tiles(side >= 0)
        for k, (a, na, of_a, x) in enumerate(left):
            edges = []
            for b, nb, of_b, y in right[k:] if same else right:
                for lo, linked in links(x, y, threshold):
                    if x is y:
                        linked[np.arange(len(linked)), lo + np.arange(len(linked))] = False
                    rows, cols = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
                    linked = linked[np.ix_(rows, cols)]
                    part = linked.astype(np.float64)
                    of_a[lo + rows] += np.rint(part @ nb[cols]).astype(np.int64)
                    if x is not y:
                        of_b[cols] += np.rint(na[lo + rows] @ part).astype(np.int64)
                    edges.append(stars(linked, a[lo + rows], b[cols]))
            if edges:
                p, q = (np.concatenate(ends) for ends in zip(*edges))
                yield p, q, None
        for who, _, n, _ in left if same else left + right:
            yield who[n > 0], None, n[n > 0]


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """Per vector: vec_id, n_links, component_id (smallest id reachable by links, itself included) and kept.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing; vectors of different dimension never link. Equal vectors link with each other
    and are counted as they stand. Ids name vectors: rows that repeat an id are one node
    for components. A row without id links with nothing and is kept with a null component.
    An empty table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.col("v")
    fine = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = fine & F.exists(v, lambda x: x != 0) & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    keyed = rows.withColumn("p", F.xxhash64("v")).withColumn("q", F.xxhash64(F.lit(1), "v"))
    classes = stored(
        keyed.where("fine").groupBy("p", "q").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v")), "vectors"
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bands = band_count(*classes.select(F.count("*"), F.coalesce(F.sum(F.size("v")), F.lit(0))).first(), tile, parts)
    dealt = classes.select(F.pmod(F.xxhash64("id"), F.lit(bands)).cast("int").alias("own"), "id", "copies", "v")
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    # A band with itself is half the work of others, and so comes last.
    group = F.when(F.col("i") == F.col("j"), F.expr(f"{bands * (bands - 1) // 2} + i")).otherwise(F.expr("j * (j - 1) div 2 + i")).cast("int")
    dealt = dealt.select(group.alias("group"), F.signum(F.col("own") - F.col("other")).cast("int").alias("side"), "id", "copies", "v")
    dealt = dealt.repartitionById(bands * (bands + 1) // 2, "group")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            for a, b, n in _work(t, threshold, tile):
                none = pa.nulls(len(a), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), none if b is None else pa.array(b), none if n is None else pa.array(n)], names=["a", "b", "n"]
                )

    found = stored(dealt.mapInArrow(scan, "a long, b long, n long"), "found")
    nodes = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    counts = found.where("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    each = classes.select("p", "q", "id", "copies").join(counts, "id", "left").join(nodes, "id", "left")
    each = each.select("p", "q", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "id").alias("c"))
    every = keyed.select("vec_id", "fine", F.when(F.col("fine"), F.col("p")).alias("p"), "q").join(each, ["p", "q"], "left")
    out = every.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
