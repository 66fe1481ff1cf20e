"""Registered queries and the SQL each one is checked against."""

from . import (  # noqa: F401
    bar_queries, document_queries, function_queries, ingest_queries, model_queries, stat_queries, stream_queries, tick_queries,
    trade_queries,
)
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
