"""Grouped operators with state, for streams and for tables.

The function of a group is ``function(key, chunks, state)``: the key as a tuple,
the rows of this call as pandas chunks, and the state of the key.  It returns an
iterator of pandas frames.  Chunks arrive one after the other, so a large group
need not fit in memory; if its rows can be merged, put ``pre_aggregate`` in
front so that no task gets a large group at all.

A call costs about a millisecond, however few rows it has.  With ``merge``, which says how
rows of one key become one, the function is called for many keys at once instead, as
``function(keys, rows, states)`` with a row for each key; see ``KeyStates``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

GroupFunction = Callable[[tuple, Iterator[pd.DataFrame], Any], Iterator[pd.DataFrame]]

MODES = ("append", "update")
TIMEOUTS = {
    "none": GroupStateTimeout.NoTimeout,
    "event": GroupStateTimeout.EventTimeTimeout,
    "processing": GroupStateTimeout.ProcessingTimeTimeout,
}
MERGES = ("sum", "min", "max")
KEY_KINDS = ("bigint", "int", "smallint", "tinyint", "boolean", "string")
#: Whole numbers with nulls keep all their digits; other kinds of state are held as objects.
STATE_KINDS = {"bigint": "Int64", "int": "Int32", "smallint": "Int16", "tinyint": "Int8", "boolean": "boolean"}
#: Groups that keys are dealt to under ``merge``.  Not taken from the session: a stream must keep it over restarts.
BUCKETS = 256
FOLD_ROWS = 100_000
NEVER = -1


class TableState:
    """State of a group in a batch job: empty at first, gone after the call."""

    hasTimedOut = False

    def __init__(self) -> None:
        self._value: tuple | None = None

    @property
    def exists(self) -> bool:
        return self._value is not None

    @property
    def get(self) -> tuple:
        if self._value is None:
            raise ValueError("the state is not defined")
        return self._value

    @property
    def getOption(self) -> tuple | None:
        return self._value

    def update(self, value: tuple) -> None:
        self._value = tuple(value)

    def remove(self) -> None:
        self._value = None

    def setTimeoutTimestamp(self, *_: Any) -> None:
        """A table ends after one call, so a timeout never comes."""

    setTimeoutDuration = setTimeoutTimestamp

    def getCurrentWatermarkMs(self) -> int:
        return 0


class KeyStates:
    """The states of the keys of one call, in the order of its keys.

    Members are named as those of a group's state and mean the same, by key: ``exists`` is an
    array, ``get`` a frame of the state's columns, null where no state exists.  ``where``
    chooses keys.  All keys of a call have rows, or all have timed out.  A timeout lasts for
    one call only: it has to be set again.
    """

    def __init__(self, values: pd.DataFrame, exists: np.ndarray, timed_out: bool, watermark_ms: int | None):
        self.get = values
        self.exists = exists
        self.hasTimedOut = timed_out
        self.timeouts = np.full(len(values), NEVER, "int64")
        self._watermark_ms = watermark_ms

    def _chosen(self, where: Any) -> np.ndarray:
        return np.ones(len(self.exists), bool) if where is None else np.asarray(where, bool)

    def update(self, values: dict[str, Any], where: Any = None) -> None:
        chosen = self._chosen(where)
        if set(values) != set(self.get.columns):
            raise ValueError(f"a state has the columns {list(self.get.columns)}, not {list(values)}")
        kept = {name: old.mask(chosen, values[name]).astype(old.dtype) for name, old in self.get.items()}
        self.get = pd.DataFrame(kept)
        self.exists = self.exists | chosen

    def remove(self, where: Any = None) -> None:
        chosen = self._chosen(where)
        self.get = pd.DataFrame({name: old.mask(chosen, None).astype(old.dtype) for name, old in self.get.items()})
        self.exists = self.exists & ~chosen

    def setTimeoutTimestamp(self, ms: Any, where: Any = None) -> None:
        if self._watermark_ms is None:
            raise ValueError("timeouts in event time are off")
        chosen = self._chosen(where)
        set_to = np.broadcast_to(np.asarray(ms, "int64"), chosen.shape)[chosen]
        if (set_to <= 0).any() or (set_to < self._watermark_ms).any():
            raise ValueError(f"a timeout must be positive and not before the watermark, {self._watermark_ms}")
        self.timeouts[chosen] = set_to


def group_by_key(df: DataFrame, name: str, key: Column) -> GroupedData:
    """Append a computed key to every row and group by it."""
    return df.withColumn(name, key).groupBy(name)


def flat_map_groups(
    df: DataFrame,
    keys: list[str],
    function: GroupFunction,
    output: str,
    state: str,
    mode: str = "append",
    timeout: str = "none",
    merge: dict[str, str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Zero to many output rows per call, with state kept between micro-batches.

    On a table the function is called once per group, with an empty state.

    ``merge`` maps columns to ``sum``, ``min`` or ``max``, which make one row of a key's rows in a
    micro-batch.  Keys are then dealt by hash to ``buckets`` groups of the engine, and the function is called
    once for all keys of a bucket that have rows and once for those whose time is up, as
    ``function(keys, rows, states)``.  Each key has a state and a timeout of its own, as without ``merge``; the
    bucket holds them as arrays, one element a key, and is called by the engine at the earliest of its
    timeouts.  A call holds the keys of one bucket, and a bucket that has rows is written as a whole: give
    more buckets for very many keys.  A stream must keep their number.
    """
    if mode not in MODES:
        raise ValueError(f"the output mode must be one of {MODES}, not {mode!r}")
    if timeout not in TIMEOUTS:
        raise ValueError(f"timeout must be one of {sorted(TIMEOUTS)}, not {timeout!r}")
    if merge is not None:
        df, keys, function, state = _in_buckets(df, keys, function, state, timeout, merge, buckets)
    if df.isStreaming:
        groups = df.groupBy(*keys)
        return groups.applyInPandasWithState(function, output, state, mode, TIMEOUTS[timeout])

    def once(
        key: tuple[Any, ...], chunks: Iterator[pd.DataFrame]
    ) -> Iterator[pd.DataFrame]:
        yield from function(key, chunks, TableState())

    # The number is given so that the shuffle, the same one that the grouping
    # needs, is not put together by size: calls cost time, not bytes.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(partitions, *keys).groupBy(*keys).applyInPandas(once, output)


def _in_buckets(
    df: DataFrame, keys: list[str], function: Callable, state: str, timeout: str, merge: dict[str, str], buckets: int
) -> tuple[DataFrame, list[str], GroupFunction, str]:
    """What ``flat_map_groups`` needs so that a group is a bucket of keys."""
    if timeout == "processing":
        raise ValueError("keys that are merged have timeouts in event time only")
    if not merge or set(merge.values()) - set(MERGES):
        raise ValueError(f"rows are merged by {MERGES}, not by {merge!r}")
    kinds = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    for key in keys:
        if kinds[key] not in KEY_KINDS:
            raise ValueError(f"keys that are merged must be of {KEY_KINDS}; {key!r} is {kinds[key]!r}")
    fields = {field.name: field.dataType.simpleString() for field in StructType.fromDDL(state).fields}
    held = [*((key, kinds[key]) for key in keys), ("exists", "boolean"), *fields.items(), ("timeout_ms", "bigint")]
    if len({name.lower() for name, _ in held}) < len(held):
        raise ValueError(f"names come twice in {[name for name, _ in held]}")
    event = timeout == "event"

    def run(group_key: tuple, chunks: Iterator[pd.DataFrame], group: Any) -> Iterator[pd.DataFrame]:
        before = [list(column) for column in group.get] if group.exists else [[] for _ in held]
        index = {key: i for i, key in enumerate(zip(*before[: len(keys)]))}
        rows = _merged(chunks, keys, [flag == "1" for flag in group_key[1]], merge, index)
        fresh = len(index) - len(before[0])
        names = pd.DataFrame({key: pd.Series(column) for key, column in zip(keys, zip(*index))})
        exists = np.array(before[len(keys)] + [False] * fresh, bool)
        timeouts = np.array(before[-1] + [NEVER] * fresh, "int64")
        values = {
            name: pd.array(column + [None] * fresh, dtype=STATE_KINDS.get(kind, "object"))
            for (name, kind), column in zip(fields.items(), before[len(keys) + 1 : -1])
        }
        mark = group.getCurrentWatermarkMs() if event else None

        def called(at: np.ndarray, rows: pd.DataFrame, timed_out: bool) -> Iterator[pd.DataFrame]:
            part = KeyStates(pd.DataFrame({name: column[at] for name, column in values.items()}), exists[at], timed_out, mark)
            yield from function(names.iloc[at].reset_index(drop=True), rows.reset_index(drop=True), part)
            exists[at], timeouts[at] = part.exists, part.timeouts
            for name, column in values.items():
                column[at] = part.get[name].array

        if len(rows):
            yield from called(rows.index.to_numpy(), rows, False)
        # As in the engine, rows come first; a key that had some has a timeout that isn't up.
        up = np.flatnonzero((timeouts != NEVER) & (timeouts < mark)) if event else []
        if len(up):
            yield from called(up, rows.iloc[:0], True)

        kept = exists | (timeouts != NEVER)
        if kept.any():
            parts = [column.to_numpy(object, na_value=None) if kind in STATE_KINDS else np.asarray(column, object)
                     for kind, column in zip(fields.values(), values.values())]
            arrays = [list(compress(column, kept)) for column in zip(*index)]
            group.update((*arrays, exists[kept].tolist(), *(part[kept].tolist() for part in parts), timeouts[kept].tolist()))
            if (timeouts != NEVER).any():
                group.setTimeoutTimestamp(int(timeouts[timeouts != NEVER].min()))
        elif group.exists:
            group.remove()

    # Keys with nulls in the same places are together: a column has nulls only or none, so that
    # whole numbers keep all their digits.
    columns = [F.col(f"`{key}`") for key in keys]
    nulls = F.concat(*(column.isNull().cast("int").cast("string") for column in columns))
    dealt = df.withColumns({"__bucket": F.pmod(F.xxhash64(*columns), F.lit(buckets)), "__nulls": nulls})
    return dealt, ["__bucket", "__nulls"], run, ", ".join(f"`{name}` array<{kind}>" for name, kind in held)


def _merged(
    chunks: Iterator[pd.DataFrame], keys: list[str], nulls: list[bool], merge: dict[str, str], index: dict[tuple, int]
) -> pd.DataFrame:
    """One row for each key that has rows, by its place in ``index``; new keys are added there."""

    def folded(rows: pd.DataFrame) -> pd.DataFrame:
        groups = rows.groupby(level=0, sort=False)
        found = {c: groups[c].sum(min_count=1) if how == "sum" else groups[c].agg(how) for c, how in merge.items()}
        return pd.DataFrame(found)

    parts, size, bound = [], 0, FOLD_ROWS
    for chunk in chunks:
        values = [[None] * len(chunk) if null else chunk[key].tolist() for key, null in zip(keys, nulls)]
        places = np.fromiter((index.setdefault(key, len(index)) for key in zip(*values)), "int64", len(chunk))
        parts.append(folded(chunk[list(merge)].set_axis(places)))
        size += len(parts[-1])
        if size > bound:
            parts = [folded(pd.concat(parts))]
            size = len(parts[0])
            bound = max(FOLD_ROWS, 2 * size)
    if len(parts) == 1:
        return parts[0]
    return folded(pd.concat(parts)) if parts else pd.DataFrame(columns=list(merge))


def map_groups(
    df: DataFrame,
    keys: list[str],
    function: GroupFunction,
    output: str,
    state: str,
    timeout: str = "none",
) -> DataFrame:
    """Exactly one output row per call; always in update mode."""

    def one_row(key: tuple, chunks: Iterator[pd.DataFrame], group: Any) -> Iterator[pd.DataFrame]:
        rows = 0
        for frame in function(key, chunks, group):
            rows += len(frame)
            yield frame
        if rows != 1:
            raise ValueError(f"the function gave {rows} rows for key {key}, not one")

    return flat_map_groups(df, keys, one_row, output, state, "update", timeout)
