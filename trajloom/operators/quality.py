"""Quality measures per clip, acceptance rules and consistency reports."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import finite, is_finite, safe_float
from ..functions.matrix import norm_diff, rot_err_deg
from .blocks import KEYS
from .series import delta_stats, frame_deltas, violations

# ---------------------------------------------------------------- aggregates


def finite_mean(c: Column) -> Column:
    """Mean of the finite values; none is NULL."""
    return F.avg(finite(c))


def both_known(pos: Column, ori: Column) -> Column:
    return is_finite(pos) & is_finite(ori)


def reachable_ratio(reachable: Column, pos: Column, ori: Column) -> Column:
    """Share of reachable frames among those whose errors are both finite."""
    return F.avg(F.when(both_known(pos, ori), F.coalesce(reachable, F.lit(False)).cast("double")))


def collision_count(collision: Column) -> Column:
    """Colliding frames; NULL when the side has no collision data at all."""
    return F.when(F.count(collision) > 0, F.count_if(collision))


def collision_ratio(collision: Column) -> Column:
    """Share of colliding frames over all the side's frames."""
    known = F.count(collision)
    return F.when(known > 0, F.count_if(collision) / known)


def error_counts(pos: Column, ori: Column) -> tuple[Column, Column]:
    """Frames with both errors finite, and the others."""
    return F.count_if(both_known(pos, ori)), F.count_if(~both_known(pos, ori))


def _own_frames(side: str, columns: Sequence[str]) -> Column:
    """Whether a frame of a wide table belongs to a side, which may end before the other."""
    if f"{side}_own" in columns:
        return F.coalesce(F.col(f"{side}_own"), F.lit(False))
    values = ("pose", "joint_position", "reachable", "collision", "position_error", "orientation_error", "gripper_signal")
    some = [F.col(f"{side}_{v}").isNotNull() for v in values if f"{side}_{v}" in columns]
    return reduce(lambda a, b: a | b, some, F.lit(False))


#: Settings of the collision check in clip metadata, fixed names and types.
SOLVER_FIELDS = {
    "available": "boolean", "enabled": "boolean", "mode": "string", "filter_adjacent_pairs": "boolean",
    "filter_neutral_touching_pairs": "boolean", "ignore_links": "array<string>", "pair_count_total": "bigint",
    "pair_count_active": "bigint", "pair_count_filtered": "bigint",
}
RUN_FIELDS = {
    "mode": "string", "pair_filter_adjacent_pairs": "boolean", "pair_filter_neutral_touching_pairs": "boolean",
    "ignore_links": "array<string>",
}


def with_solver_fields(
    summary: DataFrame,
    joint_names: Mapping[str, Sequence[str]],
    solver: Mapping[str, Mapping[str, object]],
    run: Mapping[str, object] = {},
    sides: Sequence[str] = ("left", "right"),
) -> DataFrame:
    """Adds joint names and collision settings of each side, and those of the run, to clip metadata.

    ``solver`` maps a side to values of :data:`SOLVER_FIELDS`, ``run`` holds values of
    :data:`RUN_FIELDS`; both are settings of the whole run. What is not given is NULL, or
    an empty list for joint names and a side's ignored links.
    """

    def typed(value: object, kind: str) -> Column:
        if value is not None and kind.startswith("array"):
            return F.array(*map(F.lit, value)).cast(kind)
        return F.lit(value).cast(kind)

    columns = {f"ik_collision_{n}": typed(run.get(n), k) for n, k in RUN_FIELDS.items()}
    for s in sides:
        columns[f"{s}_joint_names"] = typed(joint_names.get(s, ()), "array<string>")
        own = {"ignore_links": (), **solver.get(s, {})}
        columns |= {f"{s}_solver_collision_{n}": typed(own.get(n), k) for n, k in SOLVER_FIELDS.items()}
    return summary.withColumns(columns)


def clip_summary(
    frames: DataFrame,
    clips: DataFrame | None = None,
    limits: tuple[Sequence[float], Sequence[float]] | None = None,
    sides: Sequence[str] = ("left", "right"),
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """One row per clip with both sides' statistics as columns, in one aggregate.

    Missing columns of a side give NULLs. Frames with and without errors are counted over
    the side's own frames: those flagged by ``<side>_own`` where there is such a column,
    else those with any value of the side; a side without frames has NULL counts.
    ``clips`` adds identity and geometry.
    """
    have = set(frames.columns)
    none = F.lit(None)
    joints = {s: f"{s}_joint_position" for s in sides if f"{s}_joint_position" in have}
    if joints:
        frames = frame_deltas(frames, {c: f"_{s}_delta" for s, c in joints.items()}, keys)
    stats: list[Column] = [F.count(F.lit(1)).alias("frame_count")]
    for s in sides:
        if f"{s}_position_error" in have:
            pos, ori = F.col(f"{s}_position_error"), F.col(f"{s}_orientation_error")
        else:
            pos = ori = none.cast("double")
        own = _own_frames(s, frames.columns)
        known = F.count_if(own) > 0
        seen, lost = (F.when(known, F.count_if(own & c)) for c in (both_known(pos, ori), ~both_known(pos, ori)))
        reach = F.col(f"{s}_reachable") if f"{s}_reachable" in have else none.cast("boolean")
        hit = F.col(f"{s}_collision") if f"{s}_collision" in have else none.cast("boolean")
        stats += [
            reachable_ratio(reach, pos, ori).alias(f"{s}_reachable_ratio"),
            finite_mean(pos).alias(f"{s}_mean_position_error"),
            finite_mean(ori).alias(f"{s}_mean_orientation_error"),
            (seen if f"{s}_position_error" in have else none.cast("bigint")).alias(f"{s}_valid_error_frame_count"),
            (lost if f"{s}_position_error" in have else none.cast("bigint")).alias(f"{s}_invalid_error_frame_count"),
            collision_count(hit).alias(f"{s}_collision_count"),
            collision_ratio(hit).alias(f"{s}_collision_ratio"),
        ]
        if s in joints:
            top, mean = delta_stats(F.col(f"_{s}_delta"))
            stats += [
                top.alias(f"{s}_continuity_max_abs_delta"),
                mean.alias(f"{s}_continuity_mean_abs_delta"),
            ]
            if limits is not None:
                stats.append(F.sum(violations(joints[s], *limits)).alias(f"{s}_limit_violation_count"))
    out = frames.groupBy(*keys).agg(*stats)
    return out if clips is None else clips.join(out, list(keys), "left")


# ---------------------------------------------------------------- acceptance


def quality_filter(
    meta: DataFrame, reachable: float = 0.9, collision: float = 0.05, missing_default: float = 1.0
) -> DataFrame:
    """Annotate clips with ``render_filter_passed``; nothing is dropped.

    One missing reachable ratio takes the default, which is also filled into its column;
    two missing ones fail, and so does any missing collision ratio. Both limits are strict.
    """
    if not math.isfinite(missing_default):
        raise ValueError("the default for a missing ratio must be finite")
    left, right = safe_float(F.col("left_reachable_ratio")), safe_float(F.col("right_reachable_ratio"))
    lc, rc = safe_float(F.col("left_collision_ratio")), safe_float(F.col("right_collision_ratio"))
    lr = F.coalesce(left, F.when(right.isNotNull(), F.lit(float(missing_default))))
    rr = F.coalesce(right, F.when(left.isNotNull(), F.lit(float(missing_default))))
    passed = (lr > reachable) & (rr > reachable) & (lc < collision) & (rc < collision)
    return meta.withColumns(
        {
            "render_filter_passed": F.coalesce(passed, F.lit(False)),
            "render_filter_threshold": F.lit(float(reachable)),
            "render_filter_collision_threshold": F.lit(float(collision)),
            "render_filter_left_ratio": lr,
            "render_filter_right_ratio": rr,
            "render_filter_left_collision_ratio": lc,
            "render_filter_right_collision_ratio": rc,
            **{n: F.coalesce(F.col(n), c.cast(meta.schema[n].dataType)) for n, c in (("left_reachable_ratio", lr), ("right_reachable_ratio", rr))},
        }
    )


def flag_share(values: Column) -> Column:
    """Share of entries above 0.5 in a nested list, unknown ones skipped; nothing known is NULL."""
    known = F.filter(values, is_finite)
    return F.when(F.size(known) > 0, F.size(F.filter(known, lambda v: v > 0.5)) / F.size(known))


def ratio_with_fallback(ratio: Column, alternative: Column | None, nested: Column | None) -> Column:
    """A stored ratio, else its other spelling, else the share of flags in the nested list."""
    picks = [safe_float(ratio)]
    if alternative is not None:
        picks.append(safe_float(alternative))
    if nested is not None:
        picks.append(flag_share(nested))
    return F.coalesce(*picks)


def _ratios(meta: DataFrame) -> list[Column]:
    """Reachable and collision ratios of both sides, with the fallbacks that the metadata has columns for.

    These are ``<side>_reachable``, a ratio under another name, and the lists of flags
    ``<side>_reachable_values`` and ``<side>_collision_values``.
    """

    def ratio(side: str, what: str) -> Column:
        other, values = (n if n in meta.columns else None for n in (f"{side}_{what}", f"{side}_{what}_values"))
        scalar = F.col(other) if other and what == "reachable" else None
        return ratio_with_fallback(F.col(f"{side}_{what}_ratio"), scalar, F.col(values) if values else None)

    return [ratio(s, w) for w in ("reachable", "collision") for s in ("left", "right")]


def _passes(meta: DataFrame, reachable: float, collision: float) -> Column:
    lr, rr, lc, rc = _ratios(meta)
    return F.coalesce((lr > reachable) & (rr > reachable) & (lc < collision) & (rc < collision), F.lit(False))


def pass_report(meta: DataFrame, reachable: float = 0.95, collision: float = 0.05) -> DataFrame:
    """Counts of valid, missing, passing and failing clips; a missing value excludes the clip."""
    lr, rr, lc, rc = _ratios(meta)
    no_ratio = lr.isNull() | rr.isNull()
    no_hit = ~no_ratio & (lc.isNull() | rc.isNull())
    agg = meta.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~no_ratio & ~no_hit).alias("valid"),
        F.count_if(no_ratio).alias("missing_ratio"),
        F.count_if(no_hit).alias("missing_collision_ratio"),
        F.count_if(_passes(meta, reachable, collision)).alias("pass_count"),
    )
    rate = F.when(F.col("valid") > 0, F.col("pass_count") / F.col("valid")).otherwise(0.0)
    fail = F.greatest(F.col("valid") - F.col("pass_count"), F.lit(0))
    return agg.withColumns({"fail_count": fail, "pass_rate": rate})


def passing_ids(meta: DataFrame, reachable: float = 0.95, collision: float = 0.05, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ids of the clips that pass the report's limits."""
    return meta.filter(_passes(meta, reachable, collision)).select(*keys)


def success_ratio(index: DataFrame, renders: DataFrame) -> DataFrame:
    """Rendered clips over indexed clips; an empty index gives NULL."""
    a = index.agg(F.count(F.lit(1)).alias("indexed"), F.lit(0).cast("bigint").alias("rendered"))
    b = renders.agg(F.lit(0).cast("bigint").alias("indexed"), F.count(F.lit(1)).alias("rendered"))
    both = a.unionByName(b).agg(F.sum("indexed").alias("indexed"), F.sum("rendered").alias("rendered"))
    return both.withColumn("success_ratio", F.try_divide(F.col("rendered").cast("double"), F.col("indexed")))


# ---------------------------------------------------------------- robust statistics


BINS = 2048


def safe_stats(df: DataFrame, col: str, by: Sequence[str] = (), q: float = 0.95) -> DataFrame:
    """n, mean, exact percentile (linear interpolation) and max of the finite values.

    Three scans, no sort of the values. The first takes counts and a sketch with a proven
    rank error, which brackets the two order statistics that matter. The second counts the
    values in ``BINS`` bins of the bracket and the two ends outside it; sums of at most
    that many counts say which bins hold the ranks. The third collects the distinct values
    of those bins, a few millionths of the group. If the bracket missed, a rank lies in an
    end, which is then what is collected: the result stays exact.
    """
    if not by:  # one group, by a key that no optimiser folds away
        whole = df.withColumn("_all", F.pmod(F.xxhash64(F.col(col).cast("double")), F.lit(1)))
        one = safe_stats(whole, col, ["_all"], q)
        n = F.coalesce(F.max("n"), F.lit(0).cast("bigint")).alias("n")
        return one.agg(n, *[F.max(c).alias(c) for c in ("mean", "p95", "max")])
    accuracy = 10000
    slack = 4.0 / accuracy
    by = list(by)
    data = df.select(*by, finite(F.col(col).cast("double")).alias("_v"))
    probes = F.array(F.lit(max(0.0, q - slack)), F.lit(min(1.0, q + slack)))
    base = data.groupBy(*by).agg(
        F.count("_v").alias("n"),
        F.avg("_v").alias("mean"),
        F.max("_v").alias("max"),
        F.percentile_approx("_v", probes, F.lit(accuracy)).alias("_p"),
    )
    facts = ["n", "mean", "max", "_lo", "_hi"]
    base = base.select(*by, "n", "mean", "max", F.col("_p")[0].alias("_lo"), F.col("_p")[1].alias("_hi"))
    v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
    inner = F.when(hi > lo, F.least(F.floor((v - lo) / (hi - lo) * BINS), F.lit(BINS - 1))).otherwise(0)
    place = F.when(v < lo, -1).when(v > hi, BINS).otherwise(inner).cast("int")

    counted = _attach(data, base, by, facts).groupBy(*by, place.alias("_bin"))
    counted = counted.agg(F.count("_v").alias("_c"), *[F.max(c).alias(c) for c in facts])
    bins = F.array_sort(F.collect_list(F.when(F.col("_bin").isNotNull(), F.struct("_bin", "_c"))))
    ranked = counted.groupBy(*by).agg(bins.alias("_bins"), *[F.max(c).alias(c) for c in facts])
    at = (F.col("n") - 1) * F.lit(float(q))
    ranked = ranked.withColumns({"_k0": F.floor(at), "_k1": F.ceil(at)})
    none = F.lit(None).cast("bigint")
    first = F.struct(F.lit(0).cast("bigint").alias("s"), none.alias("b0"), none.alias("s0"), none.alias("b1"))

    def step(done: Column, x: Column) -> Column:
        holds = lambda k: (F.col(k) >= done["s"]) & (F.col(k) < done["s"] + x["_c"])
        return F.struct(
            (done["s"] + x["_c"]).alias("s"),
            F.when(holds("_k0"), x["_bin"].cast("bigint")).otherwise(done["b0"]).alias("b0"),
            F.when(holds("_k0"), done["s"]).otherwise(done["s0"]).alias("s0"),
            F.when(holds("_k1"), x["_bin"].cast("bigint")).otherwise(done["b1"]).alias("b1"),
        )

    ranked = ranked.withColumn("_r", F.aggregate("_bins", first, step)).drop("_bins")
    facts += ["_k0", "_k1", "_r"]

    held = _attach(data, ranked, by, facts)
    empty = F.col("n") == 0  # such a group has no value to keep, but a row
    held = held.filter((place == F.col("_r.b0")) | (place == F.col("_r.b1")) | empty)
    known = held.groupBy(*by, "_v").agg(F.count("_v").alias("_c"), *[F.first(c).alias(c) for c in facts])
    values = F.array_sort(F.collect_list(F.when(F.col("_v").isNotNull(), F.struct("_v", "_c"))))
    out = known.groupBy(*by).agg(values.alias("_values"), *[F.first(c).alias(c) for c in facts])
    missing = F.lit(None).cast("double")
    begin = F.struct(F.coalesce("_r.s0", F.lit(0).cast("bigint")).alias("s"), missing.alias("a"), missing.alias("b"))

    def pick(done: Column, x: Column) -> Column:
        holds = lambda k: (F.col(k) >= done["s"]) & (F.col(k) < done["s"] + x["_c"])
        return F.struct(
            (done["s"] + x["_c"]).alias("s"),
            F.when(holds("_k0"), x["_v"]).otherwise(done["a"]).alias("a"),
            F.when(holds("_k1"), x["_v"]).otherwise(done["b"]).alias("b"),
        )

    out = out.withColumn("_ab", F.aggregate("_values", begin, pick))
    value = F.col("_ab.a") + (F.col("_ab.b") - F.col("_ab.a")) * (at - F.floor(at))
    return out.select(*by, F.coalesce("n", F.lit(0).cast("bigint")).alias("n"), "mean", value.alias("p95"), "max")


SALTS = 64


def _attach(df: DataFrame, small: DataFrame, by: Sequence[str], facts: Sequence[str], salt: str = "_v") -> DataFrame:
    """The facts of a row's group beside it.

    Rows of a group are salted by a value over ``SALTS`` tasks and the facts repeated, so
    neither this join nor an aggregate after it meets a whole group at once.
    """
    keys = [F.col(c).alias(f"_k_{c}") for c in by]
    copies = small.select(*keys, *facts, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_copy"))
    salted = df.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(salt), F.lit(SALTS)), F.lit(0)).cast("int"))
    on = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in by]
    return salted.join(copies, [F.col("_salt") == F.col("_copy"), *on]).drop("_salt", "_copy", *[f"_k_{c}" for c in by])


def stats_of(df: DataFrame, values: dict[str, Column], by: Sequence[str] = (), q: float = 0.95) -> DataFrame:
    """``safe_stats`` of several values at once: one row for each group and name, in the same three scans.

    A value that a group never has still gives its row, with n = 0.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("stat"), v.cast("double").alias("value")) for n, v in values.items()])
    long = df.select(*by, F.inline(pairs))
    return safe_stats(long, "value", [*by, "stat"], q)


def with_first(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = KEYS, prefix: str = "first_") -> DataFrame:
    """The values that columns have in the first frame of the clip, beside every frame."""
    first = F.min_by(F.struct(*cols), "frame_index").alias("_first")
    small = df.groupBy(*keys).agg(first).select(*keys, *[F.col("_first")[c].alias(prefix + c) for c in cols])
    return _attach(df, small, keys, [prefix + c for c in cols], "frame_index")


# ---------------------------------------------------------------- consistency


def pose_consistency(stored: DataFrame, recomputed: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per frame distance and angle between stored and recomputed 4x4 poses.

    Both sides carry ``m`` (rotation first as 9 values in ``r``, translation in
    ``t``). Frames run to the shorter sequence; both must be finite.
    """
    both = stored.join(
        recomputed.select(*keys, "frame_index", F.col("r").alias("_r2"), F.col("t").alias("_t2")), [*keys, "frame_index"]
    )
    known = F.col("r").isNotNull() & F.col("_r2").isNotNull() & F.col("t").isNotNull() & F.col("_t2").isNotNull()
    return (
        both.filter(known)
        .withColumns(
            {
                "translation_error": norm_diff(F.col("t"), F.col("_t2")),
                "rotation_error_deg": rot_err_deg(F.col("r"), F.col("_r2")),
            }
        )
        .drop("_r2", "_t2")
    )


def param_consistency(a: Column, b: Column) -> Column:
    """Largest absolute difference of two parameter vectors."""
    return F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))


def metric_audit(
    frames: DataFrame, metric_pos: str, metric_ori: str, true_pos: str, true_ori: str, reachable: str, by: Sequence[str] = ()
) -> DataFrame:
    """Reported against true errors of reachable frames.

    The two components are likely swapped when exchanging them brings both
    closer to the truth.
    """
    cols = [metric_pos, metric_ori, true_pos, true_ori]
    used = frames.filter(F.coalesce(F.col(reachable), F.lit(False)))
    for c in cols:
        used = used.filter(is_finite(F.col(c)))
    mp, mo, tp, to = (F.col(c) for c in cols)
    agg = used.groupBy(*by).agg(
        F.count(F.lit(1)).alias("used_frames"),
        F.avg(F.abs(mp - tp)).alias("direct_position_gap"),
        F.avg(F.abs(mo - tp)).alias("swapped_position_gap"),
        F.avg(F.abs(mo - to)).alias("direct_rotation_gap"),
        F.avg(F.abs(mp - to)).alias("swapped_rotation_gap"),
    )
    swapped = (F.col("swapped_position_gap") < F.col("direct_position_gap")) & (
        F.col("swapped_rotation_gap") < F.col("direct_rotation_gap")
    )
    return agg.withColumn("likely_swapped", swapped)
