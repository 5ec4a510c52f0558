"""All survey queries and their SQL."""

from __future__ import annotations

from fathom.plans import aggregate_queries, check_queries, cloud_queries, group_queries, reference_queries, role_queries, sequence_queries  # noqa: F401
from fathom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
