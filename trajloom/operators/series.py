"""Ordered time series per clip: fills, filters and frame-to-frame statistics.

Frames of a clip are numbered from 0 without gaps. Everything here is native
window functions over bounded blocks plus a slim carry between blocks; the
state-carried recurrences are in ``recurrence``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import clean_signal, is_finite
from .blocks import BLOCK, KEYS, after, before, block_window, onward, upto, with_context, with_neighbours


def _ends(ok: Column, value: Column) -> dict[str, Column]:
    """First and last valid point of a block, as plain numbers so that the aggregate hashes."""
    at = F.when(ok, F.col("frame_index"))
    return {"_lo_f": F.min(at), "_lo_v": F.min_by(value, at), "_hi_f": F.max(at), "_hi_v": F.max_by(value, at)}


def _end(which: str) -> Column:
    f, v = F.col(f"_{which}_f"), F.col(f"_{which}_v")
    return F.when(f.isNotNull(), F.struct(f.alias("f"), v.alias("v")))


def interp_gaps(
    df: DataFrame,
    col: str,
    valid: str,
    out: str | None = None,
    hold_invalid: bool = True,
    keys: Sequence[str] = KEYS,
    block: int = BLOCK,
) -> DataFrame:
    """Fill invalid frames linearly over the frame index, holding the ends.

    A clip without any valid frame becomes zeros; ``hold_invalid=False`` leaves
    the signal as it is.
    """
    out = out or col
    if not hold_invalid:
        return df.withColumn(out, F.col(col))
    ok = F.coalesce(F.col(valid), F.lit(False)) & F.col(col).isNotNull()
    point = F.when(ok, F.struct(F.col("frame_index").alias("f"), F.col(col).alias("v")))
    ctx = with_context(
        df,
        keys,
        block,
        _ends(ok, F.col(col)),
        lambda w, _: {
            "_prev": F.last(_end("hi"), ignorenulls=True).over(before(w)),
            "_next": F.first(_end("lo"), ignorenulls=True).over(after(w)),
        },
    )
    w = block_window(keys)
    ctx = ctx.withColumns(
        {
            "_prev": F.coalesce(F.last(point, ignorenulls=True).over(upto(w)), F.col("_prev")),
            "_next": F.coalesce(F.first(point, ignorenulls=True).over(onward(w)), F.col("_next")),
        }
    )
    x, a, b = F.col("frame_index"), F.col("_prev"), F.col("_next")
    line = (b["v"] - a["v"]) / (b["f"] - a["f"]) * (x - a["f"]) + a["v"]
    value = F.when(ok, F.col(col)).when(a.isNull(), b["v"]).when(b.isNull(), a["v"]).otherwise(line)
    return ctx.withColumn(out, F.coalesce(value, F.lit(0.0))).drop("_block", "_prev", "_next")


def moving_median(
    df: DataFrame, col: str, size: int, out: str | None = None, keys: Sequence[str] = KEYS, block: int = BLOCK
) -> DataFrame:
    """Centred moving median with replicated edges; an even size grows by one."""
    out = out or col
    size = max(1, int(size))
    if size <= 1:
        return df.withColumn(out, F.col(col))
    size += 1 - size % 2
    k = size // 2
    if block < k:
        raise ValueError("a block must hold at least half a window")
    point = F.struct(F.col(col).alias("v"))
    offset = F.col("frame_index") - F.col("_block") * block
    ctx = with_neighbours(df, keys, block, point, point, k)
    ctx = ctx.withColumn("_near", F.collect_list(point).over(block_window(keys).rowsBetween(-k, k)))
    near, prev, foll = F.col("_near"), F.col("_behind"), F.col("_ahead")
    here = F.least(offset, F.lit(k))  # rows before this one inside the block
    left = (F.lit(k) - here).cast("int")
    right = (F.lit(k) - (F.size(near) - 1 - here)).cast("int")
    empty = F.slice(near, 1, 0)
    lead = F.when(left == 0, empty).when(prev.isNull(), F.array_repeat(near[0], left)).otherwise(
        F.slice(prev, F.size(prev) - left + 1, left)
    )
    tail = F.when(right == 0, empty).otherwise(F.slice(F.coalesce(foll, empty), F.lit(1), right))
    ctx = ctx.withColumn("_win", F.concat(lead, near, tail))
    win = F.col("_win")
    # The clip's end has fewer followers than the window wants: repeat its last frame.
    win = F.concat(win, F.array_repeat(F.element_at(win, -1), F.lit(size) - F.size(win)))
    values = F.transform(win, lambda p: p["v"])
    median = F.when(~F.exists(values, lambda v: v.isNull()), F.sort_array(values)[k])
    return ctx.withColumn(out, median).drop("_block", "_behind", "_ahead", "_near", "_win")


def ffill_signal(
    df: DataFrame, col: str, out: str | None = None, keys: Sequence[str] = KEYS, block: int = BLOCK
) -> DataFrame:
    """Forward fill, leading gaps 0, clip to [0, 1]; a clip with no value at all stays NULL."""
    out = out or col
    known = F.when(is_finite(F.col(col)), F.col(col))
    ctx = with_context(
        df,
        keys,
        block,
        {"_tail": F.max_by(known, F.when(known.isNotNull(), F.col("frame_index")))},
        lambda w, whole: {
            "_prev": F.last("_tail", ignorenulls=True).over(before(w)),
            "_any": F.max(F.col("_tail").isNotNull()).over(whole),
        },
    )
    held = F.coalesce(F.last(known, ignorenulls=True).over(upto(block_window(keys))), F.col("_prev"))
    value = F.when(F.col("_any"), clean_signal(held))
    return ctx.withColumn(out, value).drop("_block", "_prev", "_any")


def extend_tail(
    df: DataFrame, lengths: DataFrame, cols: Sequence[str], zero: dict[str, Column], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Repeat each clip's last row up to ``lengths.n`` frames; a clip without rows gets ``zero``.

    Only the missing tail is generated: existing rows are neither shuffled nor
    sorted, the last row per clip comes from a map-side combined aggregate.
    """
    last = df.groupBy(*keys).agg(
        F.max("frame_index").alias("_last"),
        F.max_by(F.struct(*cols), "frame_index").alias("_row"),
    )
    todo = (
        lengths.join(last, list(keys), "left")
        .withColumn("_from", F.coalesce(F.col("_last") + 1, F.lit(0)))
        .filter(F.col("n") > F.col("_from"))
    )
    # Two bounded explodes: chunks first, spread them, then the frames of a chunk.
    first, final = F.expr(f"_from div {BLOCK}"), F.expr(f"(n - 1) div {BLOCK}")
    chunks = todo.withColumn("_c", F.explode(F.sequence(first, final))).repartition(*keys, "_c")
    lo = F.greatest(F.col("_from").cast("bigint"), F.col("_c") * BLOCK)
    hi = F.least(F.col("n").cast("bigint") - 1, (F.col("_c") + 1) * BLOCK - 1)
    tail = chunks.withColumn("_f", F.explode(F.sequence(lo, hi))).select(
        *keys,
        F.col("_f").cast("int").alias("frame_index"),
        *[F.when(F.col("_last").isNull(), zero[c]).otherwise(F.col("_row")[c]).alias(c) for c in cols],
    )
    return df.select(*keys, "frame_index", *cols).unionByName(tail)


def frame_deltas(
    df: DataFrame, cols: dict[str, str], keys: Sequence[str] = KEYS, block: int = BLOCK
) -> DataFrame:
    """Absolute change of vectors since the previous frame (NULL on the first), all in one pass.

    ``cols`` maps each vector column to the name of its change.
    """
    row = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    ctx = with_neighbours(df, keys, block, row, None, 1)
    prev = F.coalesce(F.lag(row).over(block_window(keys)), F.col("_behind")[0])
    ctx = ctx.withColumn("_prev", prev)
    outs = {
        out: F.zip_with(F.col(c), F.col("_prev")[f"v{i}"], lambda a, b: F.abs(a - b)) for i, (c, out) in enumerate(cols.items())
    }
    return ctx.withColumns(outs).drop("_block", "_prev", "_behind")


def frame_delta(
    df: DataFrame, col: str, out: str = "_delta", keys: Sequence[str] = KEYS, block: int = BLOCK
) -> DataFrame:
    """Absolute change of one vector since the previous frame."""
    return frame_deltas(df, {col: out}, keys, block)


def delta_stats(delta: Column) -> tuple[Column, Column]:
    """Aggregates over a clip's changes: largest and mean over all dimensions.

    One frame or none gives 0, 0; changes that are never finite give NULL, NULL.
    """
    known = F.filter(delta, is_finite)
    still = F.count(F.lit(1)) <= 1
    total = F.sum(F.aggregate(known, F.lit(0.0), lambda a, x: a + x))
    n = F.sum(F.when(known.isNotNull(), F.size(known)))
    return (
        F.when(still, 0.0).otherwise(F.max(F.array_max(known))),
        F.when(still, 0.0).when(n > 0, total / n),
    )


def continuity(df: DataFrame, col: str, keys: Sequence[str] = KEYS, block: int = BLOCK) -> DataFrame:
    """Largest and mean absolute change between frames over all dimensions, per clip."""
    top, mean = delta_stats(F.col("_delta"))
    deltas = frame_delta(df, col, keys=keys, block=block)
    return deltas.groupBy(*keys).agg(top.alias("max_abs_delta"), mean.alias("mean_abs_delta"))


def violations(col: str, lower: Sequence[float], upper: Sequence[float]) -> Column:
    """Values of a vector outside their limits (with 1e-8 tolerance)."""
    tol = 1e-8
    per_dim = [
        F.coalesce(((F.col(col)[i] < lo - tol) | (F.col(col)[i] > hi + tol)).cast("int"), F.lit(0))
        for i, (lo, hi) in enumerate(zip(lower, upper))
    ]
    return sum(per_dim[1:], per_dim[0])


def limit_violations(
    df: DataFrame, col: str, lower: Sequence[float], upper: Sequence[float], keys: Sequence[str] = KEYS
) -> DataFrame:
    """Values outside their limits per clip."""
    return df.groupBy(*keys).agg(F.sum(violations(col, lower, upper)).alias("limit_violation_count"))


def nearest_flagged(
    df: DataFrame, flag: str, out: str = "nearest_frame", keys: Sequence[str] = KEYS, block: int = BLOCK
) -> DataFrame:
    """Index of the nearest flagged frame in either direction; a tie takes the lower index."""
    hit = F.when(F.coalesce(F.col(flag), F.lit(False)), F.col("frame_index"))
    ctx = with_context(
        df,
        keys,
        block,
        {"_lo": F.min(hit), "_hi": F.max(hit)},
        lambda w, _: {
            "_prev": F.last("_hi", ignorenulls=True).over(before(w)),
            "_next": F.first("_lo", ignorenulls=True).over(after(w)),
        },
    )
    w = block_window(keys)
    ctx = ctx.withColumns(
        {
            "_prev": F.coalesce(F.last(hit, ignorenulls=True).over(upto(w)), F.col("_prev")),
            "_next": F.coalesce(F.first(hit, ignorenulls=True).over(onward(w)), F.col("_next")),
        }
    )
    a, b, x = F.col("_prev"), F.col("_next"), F.col("frame_index")
    pick = F.when(b.isNull() | (x - a <= b - x), a).otherwise(b)
    return ctx.withColumn(out, F.coalesce(pick, a, b)).drop("_block", "_prev", "_next")


def first_valid(df: DataFrame, col: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """First known entry of a column per clip."""
    return df.filter(F.col(col).isNotNull()).groupBy(*keys).agg(F.min_by(col, "frame_index").alias(col))

