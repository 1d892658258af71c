"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from . import corpus_queries, dedup_queries, output_queries, selection_queries, text_queries  # noqa: F401
from .registry import EXPECTED, QUERIES

__all__ = ["EXPECTED", "QUERIES"]
