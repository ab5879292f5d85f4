"""Bounded blocks of a clip's frames.

A clip may be short or hold a large share of all rows, so no operator gathers
one: frames are split into blocks of consecutive frame indexes, each block is an
independent unit of work, and only a few values per block travel between the
blocks of a clip.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = 8192
KEYS = ("sample_id",)


def with_block(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """Add ``_block``, the number of the frame block."""
    return df.withColumn("_block", F.expr(f"cast(frame_index div {int(block)} as bigint)"))


def spread_blocks(df: DataFrame, keys: Sequence[str] = KEYS, block: int = BLOCK, parts: int | None = None) -> DataFrame:
    """Blocks as shuffle units.

    Grouping by (clip, block) would accept an input already partitioned by clip
    and leave a very long clip in one task, so the shuffle is asked for. On any
    other input it is the one the grouping needs anyway. ``parts`` fixes the number
    of tasks where the work is more than the bytes tell.
    """
    marked = with_block(df, block)
    return marked.repartition(parts, *keys, "_block") if parts else marked.repartition(*keys, "_block")


def bounded_parts(spark: SparkSession, rows: int, least: int = 1 << 19, most: int = 1 << 22, direct: int = 200) -> int:
    """Number of tasks of a shuffle that keeps the rows of each bounded, however many there are.

    A task gets ``least`` rows. Up to ``direct`` targets Spark writes rows straight to their
    files, beyond that it first gathers those of a task in memory; so there are more targets
    only where ``direct`` tasks would get over ``most`` rows each.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(direct, max(parts, -(-rows // least))), -(-rows // most))


def block_window(keys: Sequence[str]) -> WindowSpec:
    """Frames of one block in order."""
    return Window.partitionBy(*keys, "_block").orderBy("frame_index")


def with_context(
    df: DataFrame,
    keys: Sequence[str],
    block: int,
    summary: dict[str, Column],
    carry: Callable[[WindowSpec, WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Attach to every frame what the other blocks of its clip know.

    ``summary`` holds aggregates per block, combined map-side before their
    shuffle. ``carry`` gets two windows over those slim rows, the ordered one and
    the whole-clip one, and names the values to attach. The join back is on (clip,
    block): a long clip spreads over many tasks, and the window functions that
    follow reuse that partitioning.
    """
    slim = with_block(df, block).groupBy(*keys, "_block").agg(*[c.alias(n) for n, c in summary.items()])
    whole = Window.partitionBy(*keys)
    carried = carry(whole.orderBy("_block"), whole)
    slim = slim.select(*keys, "_block", *[c.alias(n) for n, c in carried.items()])
    return spread_blocks(df, keys, block).join(slim, [*keys, "_block"])


def with_neighbours(
    df: DataFrame, keys: Sequence[str], block: int, behind: Column | None, ahead: Column | None, k: int
) -> DataFrame:
    """Attach the last ``k`` rows of the block before and the first ``k`` of the block after.

    Frames have no gaps, so these are the rows next to a block border, picked by
    their number alone: nothing is aggregated over the data, and clips shorter than
    a block contribute nothing. ``_behind`` and ``_ahead`` are arrays in frame order
    (NULL at a clip's end).
    """
    marked = with_block(df, block)
    offset = F.col("frame_index") - F.col("_block") * block
    out = spread_blocks(df, keys, block)
    for name, value, near, step in (
        ("_behind", behind, offset >= block - k, 1),
        ("_ahead", ahead, (offset < k) & (F.col("_block") > 0), -1),
    ):
        if value is None:
            continue
        rows = marked.filter(near).select(
            *keys, (F.col("_block") + step).alias("_block"), F.struct("frame_index", value.alias("v")).alias("_r")
        )
        border = rows.groupBy(*keys, "_block").agg(F.sort_array(F.collect_list("_r"))["v"].alias(name))
        out = out.join(border, [*keys, "_block"], "left")
    return out


def before(w: WindowSpec) -> WindowSpec:
    """All earlier blocks."""
    return w.rowsBetween(Window.unboundedPreceding, -1)


def after(w: WindowSpec) -> WindowSpec:
    """All later blocks."""
    return w.rowsBetween(1, Window.unboundedFollowing)


def upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def onward(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.currentRow, Window.unboundedFollowing)


def number_frames(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, name: str = "frame_index"
) -> DataFrame:
    """0-based rank of each row within its clip.

    ``bucket`` must not decrease along ``order``; rows are ranked inside (clip,
    bucket) and shifted by the size of the earlier buckets, so a clip with very
    many rows is ranked by many tasks.
    """
    marked = df.withColumn("_bucket", bucket)
    sizes = marked.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    inner = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        marked.join(sizes, [*keys, "_bucket"])
        .withColumn(name, (F.row_number().over(inner) - 1 + F.col("_start")).cast("int"))
        .drop("_bucket", "_start")
    )
