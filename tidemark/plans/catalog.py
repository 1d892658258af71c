"""All named queries."""

from . import (  # noqa: F401
    cohort_queries, encounter_queries, model_fact_queries, model_queries, score_queries)
from .registry import EXPECTED, QUERIES

__all__ = ["EXPECTED", "QUERIES"]
