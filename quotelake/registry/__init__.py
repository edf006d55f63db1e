"""All registered queries and their oracles."""

from quotelake.registry import (  # noqa: F401
    aggregate_queries,
    comparison_queries,
    composite_queries,
    join_queries,
    reshape_queries,
    scalar_queries,
    source_queries,
    stream_queries,
    window_queries,
)
from quotelake.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
