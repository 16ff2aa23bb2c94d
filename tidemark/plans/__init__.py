"""Named queries over the given tables."""

from . import (
    cache_queries,
    group_queries,
    log_queries,
    sink_queries,
    state_queries,
    timeout_queries,
    watermark_queries,
)
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "cache_queries",
    "group_queries",
    "log_queries",
    "sink_queries",
    "state_queries",
    "timeout_queries",
    "watermark_queries",
]
