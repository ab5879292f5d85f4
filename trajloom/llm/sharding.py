"""Sharding by a keyed permutation of global row numbers.

Rows are numbered in ascending order of (id, size, checksum), so the numbering does not
depend on how the table is partitioned. A Feistel network over the smallest even number
of bits that holds the row count permutes the numbers; a value beyond the count is
encrypted again until it falls inside (cycle walking), which keeps the map a bijection of
0 .. n - 1. Place p belongs to shard p mod shards at slot p div shards: counts differ by
one at most, slots have no gaps, and anyone who knows (n, key) computes either way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, stored

SHARDS = 24
KEY = 2024
ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, -(-max(1, n - 1).bit_length() // 2))


def _round_keys(key: int) -> np.ndarray:
    return mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key))


def _feistel(x: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for k in keys:
        left, right = right, left ^ (mix(right + k) & low)
    return left << np.uint64(bits) | right


def _unfeistel(x: np.ndarray, bits: int, keys: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << bits) - 1)
    left, right = x >> np.uint64(bits), x & low
    for k in keys[::-1]:
        left, right = right ^ (mix(left + k) & low), left
    return left << np.uint64(bits) | right


def _walk(step, x: np.ndarray, n: int, key: int) -> np.ndarray:
    out = np.asarray(x, np.uint64).copy()
    live = np.arange(len(out))
    bits, keys = _half_bits(n), _round_keys(key)
    while len(live):
        out[live] = step(out[live], bits, keys)
        live = live[out[live] >= np.uint64(n)]
    return out.astype(np.int64)


def permute(rows: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Shuffled places of row numbers 0 .. n - 1."""
    return _walk(_feistel, rows, n, key)


def unpermute(places: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Row numbers that stand at the shuffled places."""
    return _walk(_unfeistel, places, n, key)


def numbered(df: DataFrame, order: list[str], column: str = "row") -> DataFrame:
    """Global row numbers from 0 in the given order, nulls first; equal rows get any of their numbers.

    Rows are range-partitioned on the order and then on a hash, so rows of equal keys do
    not meet in one task. One count per partition reaches the driver.
    """
    spark = df.sparkSession
    df = df.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc_nulls_first(c) for c in [*order, "_salt"]]
    ranged = stored(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()), "ranged")
    sizes = {r[0]: r[1] for r in ranged.groupBy("_part").count().collect()}
    starts = np.cumsum([0] + [sizes.get(p, 0) for p in range(max(sizes, default=-1) + 1)]).tolist()
    base = spark.createDataFrame([(p, starts[p]) for p in sizes], "_part int, _base long")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*keys)) - 1
    return ranged.join(F.broadcast(base), "_part").withColumn(column, F.col("_base") + within).drop("_part", "_base", "_salt")


def shards(docs: DataFrame, count: int = SHARDS, key: int = KEY, id_column: str = "doc_id") -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes + 8), text_crc32, law, shard, slot and grown_shard (null: law is ``rows``).

    Null text has size 8 and the checksum of the empty text. Equal texts are rows like any
    other and spread over shards, since counts must stay within one of each other. An
    empty table gives no rows. Repeated and null ids are rows of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = numbered(slim, ["doc_id", "size", "text_crc32"])
    n = rows.count()
    schema = "doc_id long, size long, text_crc32 long, law string, shard int, slot long, grown_shard int"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = permute(b.column("row").to_numpy(), n, key)
            k = len(at)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(["rows"] * k, pa.string())]
                + [pa.array((at % count).astype(np.int32)), pa.array(at // count), pa.nulls(k, pa.int32())],
                names=["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
            )

    return rows.select("doc_id", "size", "text_crc32", "row").mapInArrow(place, schema)
