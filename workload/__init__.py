"""Registered queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from . import assembly, joins, tables
from . import file_jobs  # its SQL builds on the others
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "assembly", "file_jobs", "joins", "tables"]
