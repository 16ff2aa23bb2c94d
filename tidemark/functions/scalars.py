"""Scalar functions used by the sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed formats: durations are "[days.]hours:minutes:seconds", commit flags are
# "<batch>_<partition>_start" or "<batch>_<partition>_done".
DURATION = r"^(?:(\d+)\.)?(\d+):(\d+):(\d+)$"
FLAG_NAME = r"^(\d+)_(\d+)_(start|done)$"

# One log entry as JSON; the time is kept in epoch milliseconds.
ENTRY_SCHEMA = (
    "name string, cti_ms long, partitions int, is_snapshot boolean, is_ready boolean, path string"
)


def parse_duration(text: Column) -> Column:
    """"1.02:03:04" or "2:03:04" as a day-time interval; null for other text."""

    def part(group: int) -> Column:
        found = F.regexp_extract(text, DURATION, group)
        return F.when(found == "", F.lit(0)).otherwise(found.try_cast("int"))

    interval = F.make_dt_interval(part(1), part(2), part(3), part(4).cast("decimal(18,6)"))
    return F.when(text.rlike(DURATION), interval)


def duration_seconds(text: str) -> int:
    """The same format for a single setting on the driver."""
    match = re.match(DURATION, text)
    if match is None:
        raise ValueError(f"not a duration like 1.02:03:04 or 2:03:04: {text!r}")
    days, hours, minutes, seconds = (int(group or 0) for group in match.groups())
    return ((days * 24 + hours) * 60 + minutes) * 60 + seconds


def event_time_ms(time: Column) -> Column:
    """Event time in epoch milliseconds, the unit of watermarks."""
    return F.unix_millis(time.cast("timestamp"))


def is_flag_name(name: Column) -> Column:
    return name.rlike(FLAG_NAME)


def batch_of_flag(name: Column) -> Column:
    return F.split(name, "_").getItem(0).try_cast("long")


def parent_folder(path: Column) -> Column:
    """The path without its last part; the root and bare names give ''."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def same_name(left: Column, right: Column) -> Column:
    return F.lower(left) == F.lower(right)


def entry_json(*columns: str | Column) -> Column:
    """Pack the columns of a log entry into one JSON line."""
    fields = columns or [c.split()[0] for c in ENTRY_SCHEMA.split(", ")]
    return F.to_json(F.struct(*fields))


def entry_from_json(line: Column) -> Column:
    return F.from_json(line, ENTRY_SCHEMA, {"mode": "FAILFAST"})
