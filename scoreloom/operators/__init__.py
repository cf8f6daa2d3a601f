"""Generic keyed DataFrame operators."""

from .ranking import chronological, latest_per_key, ranked, top_k, top_k_per_key
from .reconcile import AlignmentError, ReconciliationError
from .reshape import match_sides, nest_rows, union_by_name
from .standings import ranked_standings

__all__ = [
    "AlignmentError", "ReconciliationError", "chronological", "latest_per_key", "match_sides",
    "nest_rows", "ranked", "ranked_standings", "top_k", "top_k_per_key", "union_by_name",
]
