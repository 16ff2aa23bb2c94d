"""Grouping inside partitions, without a shuffle and without a sort."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import arrow_schema, plain_key, session_zone, to_frame

Update = Callable[[tuple, pd.DataFrame, Any], Any]
Finish = Callable[[tuple, Any], list[tuple]]
Merge = Callable[[tuple, tuple, tuple], tuple]
OUTPUT_ROWS = 10_000


def partition_local(
    df: DataFrame,
    keys: list[str],
    update: Update,
    finish: Finish,
    output: str,
    max_groups: int | None = None,
    chunk_rows: int = 200_000,
) -> DataFrame:
    """Fold the rows of each key as far as they meet in one partition.

    ``update(key, rows, state)`` takes a chunk of a key's rows and its state
    (``None`` at first) and returns the new state; ``finish(key, state)`` gives
    the rows to emit as tuples.  Besides the states only ``chunk_rows`` rows are
    held, never the rows of a group.  Nulls in a key are ``None`` and one group; whole
    numbers with nulls keep all their digits.

    A key that lies in several partitions yields one group in each.  With
    ``max_groups`` a partition also emits and forgets its states whenever it
    holds more keys, so memory stays bounded; give it if the outputs of one key
    can be merged afterwards.
    """
    schema, zone = arrow_schema(output), session_zone(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}

        def emitted() -> Iterator[pa.RecordBatch]:
            rows = [row for key, state in states.items() for row in finish(key, state)]
            states.clear()
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

        for chunk in _chunks((to_frame(batch, zone) for batch in batches), chunk_rows):
            for key, rows in chunk.groupby(keys, sort=False, dropna=False):
                key = plain_key(key)
                states[key] = update(key, rows, states.get(key))
            if max_groups is not None and len(states) > max_groups:
                yield from emitted()
        yield from emitted()

    return df.mapInArrow(run, output)


def fold_groups(
    df: DataFrame,
    keys: list[str],
    state: str,
    update: Update,
    merge: Merge,
    finish: Finish,
    output: str,
    held_groups: int = 100_000,
    chunk_rows: int = 200_000,
) -> DataFrame:
    """Fold the rows of each key: in the partitions first, then across them.

    ``update(key, rows, state)`` and ``finish(key, state)`` are those of
    ``partition_local``; a state is a tuple of the columns ``state``, and
    ``merge(key, a, b)`` joins two of them.  A task holds about ``held_groups`` states
    at a time and sends on what it has beyond that, so only states are shuffled, memory is bounded and
    the result doesn't depend on the bound.  After the shuffle equal keys follow each
    other and one state is held.  Nulls in a key are one group, and so are NaN and both zeros.
    """
    # pandas takes NaN for null and tells zeros apart by their bits: a column says which is NaN.
    floats = [key for key in keys if df.schema[key].dataType.typeName() in ("float", "double")]
    flags = [f"is_nan_{i}_{len(df.columns)}" for i in range(len(floats))]
    kept = df
    for key, flag in zip(floats, flags):
        kind = df.schema[key].dataType
        zero = F.col(f"`{key}`") + F.lit(0).cast(kind)
        kept = kept.withColumn(flag, F.isnan(f"`{key}`")).withColumn(key, F.when(~F.isnan(f"`{key}`"), zero))

    def own(key: tuple) -> tuple:
        """A key as it was in ``df``."""
        nan = {floats[i] for i in range(len(floats)) if key[len(keys) + i]}
        return tuple(float("nan") if name in nan else value for name, value in zip(keys, key))

    names, columns = [*keys, *flags], df.columns
    kinds = [f"`{name}` {kept.schema[name].dataType.simpleString()}" for name in names]
    partial = partition_local(
        kept,
        names,
        lambda key, rows, held: update(own(key), rows[columns], held),
        lambda key, held: [(*key, *held)],
        ", ".join([*kinds, state]),
        max_groups=held_groups,
        chunk_rows=chunk_rows,
    )
    by = [F.col(f"`{name}`") for name in names]
    schema, width = arrow_schema(output), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def written(rows: list[tuple]) -> pa.RecordBatch:
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        key, held, out = None, None, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if key == row[:width]:
                    held = merge(own(key), held, row[width:])
                    continue
                if key is not None:
                    out += finish(own(key), held)
                key, held = row[:width], row[width:]
                if len(out) >= OUTPUT_ROWS:
                    yield written(out)
                    out = []
        if key is not None:
            out += finish(own(key), held)
        if out:
            yield written(out)

    return partial.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, output)


def _chunks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    """Larger chunks, so that a key costs one call per chunk and not per batch."""
    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= rows:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if size:
        yield pd.concat(held, ignore_index=True)


def pre_aggregate(
    df: DataFrame,
    keys: list[str],
    aggregates: dict[str, tuple[str, str]],
    max_groups: int = 100_000,
) -> DataFrame:
    """Partial aggregation of a stream or table ahead of its shuffle.

    ``aggregates`` maps an output column to ``(input column, function)`` with
    the functions ``sum``, ``min``, ``max`` and ``count``.  Each task folds its
    rows batch by batch, so a key that holds a large share of all rows sends a
    few rows per task to the operator behind.  The result is partial: the same
    key comes once or more per partition, and the operator has to merge.
    """
    for source, function in aggregates.values():
        if function not in ("sum", "min", "max", "count"):
            raise ValueError(f"cannot merge partial results of {function!r} on {source!r}")
    kinds = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    types = {key: kinds[key] for key in keys}
    for name, (source, function) in aggregates.items():
        types[name] = _result_kind(kinds[source], function)
    names = [*keys, *aggregates]
    first = [(source, function) for source, function in aggregates.values()]
    again = [
        (name, "sum" if function == "count" else function)
        for name, (_, function) in aggregates.items()
    ]
    used = list(dict.fromkeys([*keys, *(source for source, _ in first)]))

    def fold(table: pa.Table, steps: list[tuple[str, str]]) -> pa.Table:
        grouped = table.group_by(keys, use_threads=False).aggregate(steps)
        picked = [grouped[key] for key in keys]
        picked += [_cast(grouped[f"{source}_{function}"], types[name]) for name, (source, function) in zip(aggregates, steps)]
        return pa.table(picked, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []
        rows = 0
        for batch in batches:
            parts.append(fold(pa.table(batch), first))
            rows += parts[-1].num_rows
            if rows > max_groups:
                parts = [fold(pa.concat_tables(parts), again)]
                rows = parts[0].num_rows
                if rows > max_groups // 2:
                    # Mostly different keys: holding on to them gains little.
                    yield from parts[0].combine_chunks().to_batches()
                    parts, rows = [], 0
        if parts:
            yield from fold(pa.concat_tables(parts), again).combine_chunks().to_batches()

    return df.select(*used).mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in types.items()))


def _cast(column: pa.ChunkedArray, kind: str) -> pa.ChunkedArray:
    """Arrow widens decimals to 38 digits; Spark expects the declared number."""
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)
    return column.cast(pa.decimal128(int(found[1]), int(found[2]))) if found else column


def _result_kind(kind: str, function: str) -> str:
    if function == "count":
        return "long"
    if function == "sum" and (found := re.fullmatch(r"decimal\((\d+),(\d+)\)", kind)):
        # As Spark widens a sum.
        return f"decimal({min(38, int(found[1]) + 10)},{found[2]})"
    if function == "sum":
        return {"tinyint": "long", "smallint": "long", "int": "long", "float": "double"}.get(kind, kind)
    return kind
