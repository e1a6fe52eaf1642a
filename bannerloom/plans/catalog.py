"""All registered queries."""

from bannerloom.plans import performance_queries, serving_queries, source_queries, streaming_queries, table_queries  # noqa: F401
from bannerloom.plans.registry import QUERIES

__all__ = ["QUERIES"]
