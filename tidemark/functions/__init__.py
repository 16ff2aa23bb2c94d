"""Column functions; every one is built from Spark's own expressions."""

from .scalars import (
    batch_of_flag,
    entry_from_json,
    entry_json,
    event_time_ms,
    is_flag_name,
    parent_folder,
    parse_duration,
    same_name,
)

__all__ = [
    "batch_of_flag",
    "entry_from_json",
    "entry_json",
    "event_time_ms",
    "is_flag_name",
    "parent_folder",
    "parse_duration",
    "same_name",
]
