"""All registered queries."""

from . import graph_queries, network_queries, post_queries, rollup_queries, stream_queries, text_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
