"""Sampling, sharding, paging and ranking of clips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectorized import sample_share
from ..session import reliable


def hash_sample(df: DataFrame, key: str, ratio: float, algo: str = "md5") -> DataFrame:
    """Keep a deterministic share of the keys."""
    if ratio <= 0.0:
        return df.limit(0)
    if ratio >= 1.0:
        return df
    return df.filter(sample_share(F.col(key), algo) < ratio)


def visualize_flag(df: DataFrame, key: str, ratio: float, algo: str = "md5", out: str = "visualize") -> DataFrame:
    """Mark instead of keep."""
    if ratio <= 0.0 or ratio >= 1.0:
        return df.withColumn(out, F.lit(ratio >= 1.0))
    return df.withColumn(out, sample_share(F.col(key), algo) < ratio)


def global_rank(df: DataFrame, order: Sequence[str | Column], out: str = "rank") -> DataFrame:
    """0-based position in the global order, without gathering the rows in one task.

    Rows are range-partitioned and sorted; a row's position inside its partition
    comes with the id Spark gives it, and the partition starts are a running sum
    over one count per partition. The ranged rows are checkpointed, as sampling
    the ranges twice could draw different borders.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = reliable(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    starts, total = [], 0
    for row in sorted(sizes, key=lambda r: r["_part"]):
        starts.append((row["_part"], total))
        total += row["n"]
    table = df.sparkSession.createDataFrame(starts, "_part bigint, _start bigint")
    placed = ranged.withColumn("_part", part).join(F.broadcast(table), "_part")  # one row per partition
    return placed.withColumn(out, F.col("_start") + inside).drop("_at", "_part", "_start")


def shard(df: DataFrame, key: str, num_parts: int, part: int) -> DataFrame:
    """Round-robin share of the clips in id order: ``rank % num_parts == part``."""
    if num_parts <= 0:
        raise ValueError("num_parts must be positive")
    if not 0 <= part < num_parts:
        raise ValueError(f"part must satisfy 0 <= part < {num_parts}, got {part}")
    if num_parts == 1:
        return df
    blank = F.raise_error(F.lit("sharding needs a non-empty id on every row")).cast("string")
    text = F.col(key).cast("string")
    checked = df.withColumn("_key", F.when(F.length(text) > 0, text).otherwise(blank))
    ranked = global_rank(checked, ["_key"], "_rank")
    return ranked.filter(F.pmod("_rank", F.lit(num_parts)) == part).drop("_rank", "_key")


def page_after(df: DataFrame, key: str, last: object | None, size: int) -> DataFrame:
    """The ``size`` rows that follow the key ``last`` (None: the first ones) in key order.

    However deep the page lies, a task keeps ``size`` rows and the filter reaches the source.
    """
    if size <= 0:
        raise ValueError("the page size must be positive")
    return (df if last is None else df.filter(F.col(key) > F.lit(last))).orderBy(key).limit(int(size))


def page(df: DataFrame, order: Sequence[str | Column], start: int, size: int) -> DataFrame:
    """Ordered page ``[start, start + size)``; for deep pages use :func:`page_after`, as this one keeps all before it."""
    if size <= 0:
        raise ValueError("the page size must be positive")
    return df.orderBy(*order).offset(int(start)).limit(int(size))
