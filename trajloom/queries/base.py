"""Registration of queries with their SQL check."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function under its name, with the SQL that must give the same rows."""

    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def given(fixture: str, body: str, recursive: bool = False) -> str:
    """SQL with the fixture's tables in front; a body starting with a comma adds more of them."""
    head = "with recursive " if recursive else "with "
    return head + fixture.strip() + body


def q6(c: Column) -> Column:
    """Six decimals, the same way in both engines (their rounding differs on ties)."""
    return F.floor(c * 1e6 + 0.5) / 1e6


def s6(expr: str) -> str:
    return f"floor(({expr}) * 1e6 + 0.5) / 1e6"


def spread(c: Column, names: Sequence[str]) -> list[Column]:
    """Array elements as quantised columns."""
    return [q6(c[i]).alias(n) for i, n in enumerate(names)]


def sql_spread(exprs: Sequence[str], names: Sequence[str]) -> str:
    return ", ".join(f"{s6(e)} as {n}" for e, n in zip(exprs, names))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder for files of a query, where checkpoints go."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
