"""Arrow batches as pandas frames and back, without changing any value.

Spark's own conversion turns whole numbers with nulls into floating point, which loses
digits beyond 2^53.  Here such columns have pandas' nullable integer types.
"""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

_NULLABLE = {"int8": pd.Int8Dtype(), "int16": pd.Int16Dtype(), "int32": pd.Int32Dtype(), "int64": pd.Int64Dtype()}


def session_zone(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.session.timeZone")


def arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def to_frame(batch: pa.RecordBatch, zone: str) -> pd.DataFrame:
    """Times with a zone become local times of the session, as in Spark's pandas frames."""
    frame = batch.to_pandas()
    for field, column in zip(batch.schema, batch.columns):
        if pa.types.is_integer(field.type) and column.null_count:
            frame[field.name] = _NULLABLE[str(field.type)].__from_arrow__(column)
        if pa.types.is_timestamp(field.type) and field.type.tz:
            frame[field.name] = frame[field.name].dt.tz_convert(zone).dt.tz_localize(None)
    return frame


def to_batch(frame: pd.DataFrame, schema: pa.Schema, zone: str) -> pa.RecordBatch:
    """Columns go by name, or by position where the frame's names are others."""
    named = set(schema.names) <= set(frame.columns)
    arrays = []
    for i, field in enumerate(schema):
        column = frame[field.name] if named else frame.iloc[:, i]
        zoned = pa.types.is_timestamp(field.type) and field.type.tz
        if zoned and pd.api.types.is_datetime64_dtype(column.dtype):
            column = column.dt.tz_localize(zone)
        arrays.append(pa.array(column, from_pandas=True).cast(field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def plain_key(key: tuple) -> tuple:
    """A group's key with ``None`` for every kind of null, so that nulls of all chunks meet."""
    return tuple(None if pd.isna(part) else part for part in key)
