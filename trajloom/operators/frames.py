"""Between clip arrays and frame rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import KEYS


def to_frames(clips: DataFrame, arrays: Sequence[str], keys: Sequence[str] = KEYS, constants: Sequence[str] = ()) -> DataFrame:
    """One row per frame from parallel arrays, clip constants repeated.

    Shorter arrays end in NULL. ``first_frame`` (if present) is where the row's
    arrays start, else they start at frame 0.
    """
    start = F.col("first_frame") if "first_frame" in clips.columns else F.lit(0)
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    keep = [*keys, *constants]
    return clips.select(*keep, start.alias("_start"), F.posexplode(zipped).alias("_pos", "_z")).select(
        *keep, (F.col("_start") + F.col("_pos")).cast("int").alias("frame_index"), *[F.col("_z")[a].alias(a) for a in arrays]
    )


def to_clips(frames: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS, block: int | None = None) -> DataFrame:
    """Clip arrays in frame order: one row per clip, or on demand one per ``block`` frames of a clip.

    A row of a whole clip must fit in a task; ask for blocks where clips have no bound.
    """
    row = F.struct("frame_index", *cols)
    packed = (
        frames.withColumn("block", F.expr(f"cast(frame_index div {int(block)} as bigint)") if block else F.lit(0).cast("bigint"))
        .groupBy(*keys, "block")
        .agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    )
    return packed.select(
        *keys,
        "block",
        F.col("_rows")["frame_index"][0].alias("first_frame"),
        *[F.col("_rows")[c].alias(c) for c in cols],
    )
