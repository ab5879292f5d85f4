"""Link pairs and collision flags from a clearance table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import finite
from .blocks import KEYS
from .series import extend_tail


def ordered_pairs(df: DataFrame, a: str = "link_a", b: str = "link_b") -> DataFrame:
    """Each unordered pair of different links once, smaller name first."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return df.filter(F.col(a) != F.col(b)).select(lo.alias("link_a"), hi.alias("link_b")).distinct()


def active_pairs(
    pairs: DataFrame,
    adjacent: DataFrame,
    neutral: DataFrame,
    ignored: Sequence[str] = (),
    forced: DataFrame | None = None,
    tolerance: float = 1e-9,
) -> DataFrame:
    """Pairs to check: all, minus ignored links, adjacent links and pairs that touch at rest, plus forced ones.

    ``neutral`` has each pair's rest distance. All are pair tables with
    ``link_a < link_b``; the subtraction is by anti join.
    """
    pair = ["link_a", "link_b"]
    kept = pairs.select(*pair)
    if ignored:
        kept = kept.filter(~F.col("link_a").isin(*ignored) & ~F.col("link_b").isin(*ignored))
    kept = kept.join(adjacent.select(*pair), pair, "left_anti")
    kept = kept.join(neutral.filter(F.col("distance") <= tolerance).select(*pair), pair, "left_anti")
    if forced is not None:
        kept = kept.unionByName(forced.select(*pair).join(pairs.select(*pair), pair, "left_semi"))
    return kept.distinct()


def pair_counts(pairs: DataFrame, active: DataFrame) -> DataFrame:
    """Total, active and filtered pair counts in one pass over both."""
    marked = pairs.select(F.lit(1).alias("t"), F.lit(0).alias("a")).unionByName(
        active.select(F.lit(0).alias("t"), F.lit(1).alias("a"))
    )
    agg = marked.agg(
        F.coalesce(F.sum("t"), F.lit(0)).alias("pair_count_total"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("pair_count_active"),
    )
    return agg.withColumn("pair_count_filtered", F.col("pair_count_total") - F.col("pair_count_active"))


def collision_flags(
    clearance: DataFrame, active: DataFrame | None, safe: float, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Per frame: does any active pair come closer than ``safe``, and the squared penalty.

    Non-finite distances are ignored. The pair table is bounded by the robot, not by the
    data, so it is broadcast: a table dealt by frame stays so, and no shuffle by its few pairs
    is planned.
    """
    used = clearance if active is None else clearance.join(F.broadcast(active), ["link_a", "link_b"], "left_semi")
    d = finite(F.col("distance"))
    close = F.coalesce(d < safe, F.lit(False))
    return used.groupBy(*keys, "frame_index").agg(
        F.max(close).alias("collision"),
        F.sum(F.when(close, (safe - d) * (safe - d)).otherwise(0.0)).alias("penalty"),
    )


def combine_sides(left: DataFrame, right: DataFrame, zero: Column, keys: Sequence[str] = KEYS) -> DataFrame:
    """Joint state of both arms per frame; the shorter side repeats its last frame.

    ``left_own`` and ``right_own`` tell which frames a side really has, so that
    flags computed on the joint state can be cut back to it.
    """
    def size(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg((F.max("frame_index") + 1).alias(name))

    lengths = size(left, "_l").join(size(right, "_r"), list(keys), "full_outer")
    lengths = lengths.select(
        *keys,
        F.coalesce("_l", F.lit(0)).alias("_l"),
        F.coalesce("_r", F.lit(0)).alias("_r"),
        F.greatest(F.coalesce("_l", F.lit(0)), F.coalesce("_r", F.lit(0))).alias("n"),
    )
    a = extend_tail(left, lengths.select(*keys, "n"), ["joints"], {"joints": zero}, keys)
    b = extend_tail(right, lengths.select(*keys, "n"), ["joints"], {"joints": zero}, keys)
    both = a.withColumnRenamed("joints", "left_joints").join(
        b.withColumnRenamed("joints", "right_joints"), [*keys, "frame_index"], "full_outer"
    )
    return both.join(lengths.drop("n"), list(keys)).select(
        *keys,
        "frame_index",
        "left_joints",
        "right_joints",
        (F.col("frame_index") < F.col("_l")).alias("left_own"),
        (F.col("frame_index") < F.col("_r")).alias("right_own"),
    )
