"""Registered queries: every operator run over the given tables."""

from . import audit_queries, column_queries, geometry_queries, ledger_queries, quality_queries, series_queries  # noqa: F401
from .base import ORACLES, QUERIES  # noqa: F401
