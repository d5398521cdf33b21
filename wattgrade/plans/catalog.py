"""All registered queries."""

from __future__ import annotations

from wattgrade.plans import clean_queries, io_queries, model_queries, profile_queries, stats_queries  # noqa: F401
from wattgrade.plans.registry import QUERIES

__all__ = ["QUERIES"]
