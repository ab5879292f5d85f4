"""User extension surface: named transforms and sources, step lists, conditional and isolated steps."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.blocks import KEYS, with_block
from ..session import reliable


class Registry:
    """Names to factories; aliases are further names."""

    def __init__(self, what: str) -> None:
        self.what = what
        self._items: dict[str, Callable] = {}

    def register(self, *names: str) -> Callable[[Callable], Callable]:
        if not names:
            raise ValueError(f"a {self.what} needs a name")

        def add(fn: Callable) -> Callable:
            for name in names:
                if name in self._items:
                    raise KeyError(f"{self.what} '{name}' is already registered, existing: {self.names()}")
                self._items[name] = fn
            return fn

        return add

    def names(self) -> str:
        return ", ".join(sorted(self._items))

    def get(self, name: str) -> Callable:
        if name not in self._items:
            raise KeyError(f"unknown {self.what} '{name}', available: {self.names()}")
        return self._items[name]


transforms = Registry("transform")  # (**params) -> (DataFrame -> DataFrame)
sources = Registry("source")  # (spark, **params) -> DataFrame


def build_steps(configs: Iterable[dict]) -> Callable[[DataFrame], DataFrame]:
    """One transform from an ordered config; ``enabled: false`` entries are skipped.

    Every step stamps its name into ``last_process``.
    """
    steps = []
    for cfg in configs:
        if not cfg.get("enabled", True):
            continue
        kind = cfg["type"]
        steps.append((cfg.get("name", kind), transforms.get(kind)(**cfg.get("params", {}))))

    def run(df: DataFrame) -> DataFrame:
        return reduce(lambda d, s: d.transform(s[1]).withColumn("last_process", F.lit(s[0])), steps, df)

    return run


def when_passed(
    df: DataFrame, flag: str, fn: Callable[[DataFrame], DataFrame], stale: str | None = None, out: str = "skipped"
) -> DataFrame:
    """Run ``fn`` only on rows whose flag is set; the others come back marked as skipped.

    The filter sits before ``fn``, so no skipped row reaches the expensive step.
    ``stale`` names the output key column of a skipped row, to be removed later.
    """
    ok = F.coalesce(F.col(flag), F.lit(False))
    done = fn(df.filter(ok)).withColumn(out, F.lit(False))
    rest = df.filter(~ok).withColumn(out, F.lit(True))
    if stale:
        done = done.withColumn("stale_output", F.lit(None).cast("string"))
        rest = rest.withColumn("stale_output", F.col(stale))
    return done.unionByName(rest, allowMissingColumns=True)


def isolate(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: T.StructType,
    process: str,
    unit: str | int,
    keys: Sequence[str] = KEYS,
) -> tuple[DataFrame, DataFrame]:
    """Run a pandas function per unit; a failing clip becomes an error row, the rest complete.

    The caller states the unit, as it decides what the function sees: ``"clip"`` gives it
    whole clips, each in one task and so in its memory, for functions that need the clip;
    a number of frames gives it blocks of that many, for functions that work frame by
    frame. Returns the rows of the clips that worked and one row per failed clip with
    ``error`` and ``last_process``; a clip fails as soon as one of its blocks does.
    """
    keys = list(keys)
    if unit != "clip" and not (isinstance(unit, int) and unit > 0):
        raise ValueError("the unit is 'clip' or a positive number of frames")
    marked = df.withColumn("_block", F.lit(0).cast("bigint")) if unit == "clip" else with_block(df, unit)
    # an error row has nothing but its keys
    full = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).add("error", T.StringType())
    names = [f.name for f in full.fields]
    absent = [k for k in keys if k not in names]
    if absent:
        raise ValueError(f"the result schema must contain the keys {absent}")

    def guarded(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        try:
            return fn(pdf.drop(columns="_block")).assign(error=None)[names]
        except Exception:  # noqa: BLE001 - any failure of a user function belongs to its clip
            row = dict.fromkeys(names)
            row.update(zip(keys, key[: len(keys)]), error=traceback.format_exc(limit=3))
            return pd.DataFrame([row], columns=names).astype(object)

    ran = reliable(marked.groupBy(*keys, "_block").applyInPandas(guarded, full))
    failed = ran.filter(F.col("error").isNotNull()).groupBy(*keys).agg(F.min("error").alias("error"))
    failed = failed.withColumn("last_process", F.lit(process))
    worked = ran.filter(F.col("error").isNull()).drop("error").join(failed.select(*keys), keys, "left_anti")
    return worked, failed
