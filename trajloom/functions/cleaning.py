"""Column functions that clean, pad and fit scalars and arrays.

NaN and infinities become NULL as early as possible: in Spark ``NaN = NaN`` and
NaN sorts above every number, so a stray NaN would slip past thresholds and
poison ``max`` and ``avg``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INF = float("inf")


def finite(c: Column) -> Column:
    """Finite value or NULL (NaN compares above infinity, so one test is enough)."""
    return F.when(F.abs(c) < F.lit(INF), c)


def safe_float(c: Column) -> Column:
    """Parse as double; anything unparseable or non-finite is NULL."""
    text = F.trim(c.cast("string"))
    # The JVM parser also takes a trailing type letter ("1.5d"), which is not a number here.
    return F.when(~text.rlike("[dDfF]$"), finite(c.cast("string").try_cast("double")))


def safe_int(c: Column, positive: bool = False) -> Column:
    """Parse as integer; ``positive`` also maps values <= 0 to NULL."""
    value = F.when(F.trim(c.cast("string")).rlike(r"^[+-]?\d+$"), F.trim(c.cast("string")).try_cast("bigint"))
    return F.when(value > 0, value) if positive else value


def truncate_int(c: Column, positive: bool = False) -> Column:
    """Integer part of a numeric column; non-finite is NULL."""
    value = finite(c.cast("double")).cast("bigint")
    return F.when(value > 0, value) if positive else value


def flat_vec(c: Column, dim: int) -> Column:
    """Flatten a matrix to ``dim`` values; a wrong size is NULL, a non-finite value a NULL element."""
    flat = F.flatten(c)
    return F.when(F.size(flat) == dim, F.transform(flat, finite))


def norm_vec(c: Column) -> Column:
    """Element-wise NULL for non-finite values; NULL when nothing finite is left."""
    clean = F.transform(c, finite)
    return F.when(F.exists(clean, lambda x: x.isNotNull()), clean)


def norm_seq(c: Column) -> Column:
    """Non-finite entries of a sequence become NULL; the length stays."""
    return F.transform(c, finite)


def pad_to_longest(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pad the array columns with NULL to the longest of them in each row."""
    longest = F.greatest(*[F.coalesce(F.size(F.col(c)), F.lit(0)) for c in cols], F.lit(0))

    def padded(name: str) -> Column:
        elem = df.schema[name].dataType.elementType
        empty = F.array().cast(T.ArrayType(elem))
        have = F.coalesce(F.col(name), empty)
        return F.concat(have, F.array_repeat(F.lit(None).cast(elem), longest - F.size(have)))

    return df.withColumns({c: padded(c) for c in cols})


def fit_vec(c: Column, dim: int) -> Column:
    """Exactly ``dim`` values: NULL is zeros, longer is cut, shorter is zero-padded."""
    have = F.coalesce(c, F.array().cast("array<double>"))
    return F.slice(F.concat(have, F.array_repeat(F.lit(0.0), dim)), 1, dim)


def clean_signal(c: Column) -> Column:
    """NaN and NULL to 0, +inf to 1, -inf to 0, then clip to [0, 1]."""
    return F.when(c.isNull() | F.isnan(c), 0.0).otherwise(F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def is_finite(c: Column) -> Column:
    """TRUE for a finite value; NULL and NaN are FALSE."""
    return F.coalesce(F.abs(c) < F.lit(INF), F.lit(False))


def fit_samples(c: Column, count: Column) -> Column:
    """Zero-pad or cut a sample sequence to ``count`` cleaned values."""
    have = F.coalesce(c, F.array().cast("array<double>"))
    fitted = F.slice(F.concat(have, F.array_repeat(F.lit(0.0), count)), F.lit(1), count)
    return F.transform(fitted, clean_signal)


def joint_names(c: Column, prefix: str) -> Column:
    """Replace blank names by ``prefix`` and the 1-based position; NULL is an empty list."""
    named = F.transform(
        c,
        lambda x, i: F.when(F.length(F.trim(x)) > 0, x).otherwise(
            F.concat(F.lit(prefix), (i + 1).cast("string"))
        ),
    )
    return F.coalesce(named, F.array().cast("array<string>"))


def gripper_targets(c: Column, closed: Sequence[float], opened: Sequence[float]) -> Column:
    """Opening ratio to one target per finger; a NULL ratio stays NULL."""
    if len(closed) != len(opened):
        raise ValueError("closed and opened must have the same length")
    ratio = clean_signal(c)
    return F.when(
        c.isNotNull(), F.array(*[F.lit(float(a)) + ratio * F.lit(float(b) - float(a)) for a, b in zip(closed, opened)])
    )


def clip_bounds(c: Column, lower: Sequence[float | None], upper: Sequence[float | None]) -> Column:
    """Clip every dimension to its bounds; a missing or infinite bound does not apply."""

    def one(i: int) -> Column:
        v = c[i]
        lo, hi = lower[i], upper[i]
        if lo is not None and abs(lo) < INF:
            v = F.greatest(v, F.lit(float(lo)))
        if hi is not None and abs(hi) < INF:
            v = F.least(v, F.lit(float(hi)))
        # greatest/least skip NULL, a missing value must stay missing
        return F.when(c[i].isNotNull(), v)

    return F.when(c.isNotNull(), F.array(*[one(i) for i in range(len(lower))]))


def first_nonempty(*cols: Column, default: str | None = None) -> Column:
    """First column that holds more than blanks, else the default."""
    picks = [F.when(F.length(F.trim(c.cast("string"))) > 0, F.trim(c.cast("string"))) for c in cols]
    return F.coalesce(*picks, F.lit(default))


def round_nested(df: DataFrame, digits: int | None) -> DataFrame:
    """Round every double at any depth, half to even; non-finite becomes NULL."""
    if digits is None or digits < 0:
        return df

    def walk(c: Column, t: T.DataType) -> Column:
        if isinstance(t, (T.DoubleType, T.FloatType)):
            # from 2**53 on a double is a whole number, which no rounding to digits changes
            return F.when(F.abs(c) < 2.0**53, F.bround(c, digits)).otherwise(finite(c)).cast(t)
        if isinstance(t, T.ArrayType):
            return F.transform(c, lambda x: walk(x, t.elementType))
        if isinstance(t, T.MapType):
            return F.transform_values(c, lambda _, v: walk(v, t.valueType))
        if isinstance(t, T.StructType):
            parts = F.struct(*[walk(c[f.name], f.dataType).alias(f.name) for f in t.fields])
            return F.when(c.isNotNull(), parts)
        return c

    return df.select(*[walk(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def add_fields(df: DataFrame, fields: dict) -> DataFrame:
    """Add or overwrite constant columns."""
    return df.withColumns({k: F.lit(v) for k, v in fields.items()})
