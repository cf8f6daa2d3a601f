"""Registered queries over the given tables, each beside its SQL counterpart."""

from . import (  # noqa: F401  (importing registers them)
    bracket_queries, match_queries, model_queries, quality_queries, round_trips, source_queries,
    standing_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
