"""All registered queries of this subpackage."""

from . import bpe, chat_format, collocations, fingerprints, line_dedup, near_dup, packing, quality_mil, sharding, suffix_dedup, topk_kdtree, warc, whitening  # noqa: F401  (importing registers them)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
