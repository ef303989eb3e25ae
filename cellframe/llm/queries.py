"""The registered queries of this package; none has a counterpart in SQL."""

from __future__ import annotations

from . import (  # noqa: F401
    conversation_repair, fm_decontaminate, line_dedup, ngram_jaccard, packing, quality_gam, quality_rules, rans_tokens, secrets, token_alignment,
    topk_search, toxicity, warc)
from .common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
