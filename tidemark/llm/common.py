"""Helpers that several of these operators share."""

from __future__ import annotations

from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

from tidemark.session import new_folder, settings

#: The bytes between words, wherever a contract says ``[^\x20\x09-\x0D]+``.
BLANKS = " \t\n\x0b\x0c\r"

#: Spark hands rows to Python in batches of at most this many bytes, so that a
#: batch of very long texts stays as small as one of short texts.
BATCH_BYTES = 8 << 20


def table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written under the shared folder and read again.

    Cuts the lineage: an executor that is lost later costs no more than reading
    the table again.  Rows go to Python in batches of bounded bytes meanwhile.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession):
    with settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}):
        yield


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Tables up to this many bytes of rows are broadcast.
BROADCAST_BYTES = 32 << 20


def row_bytes(rows: DataFrame) -> Column | int:
    """Bytes of a row: a number, or a column where the row has lists or texts."""
    fixed, wide = 8, []
    for field in rows.schema.fields:
        kind, value = field.dataType, F.col(f"`{field.name}`")
        if isinstance(kind, ArrayType):
            each = 8 * (len(kind.elementType.fields) if isinstance(kind.elementType, StructType) else 1)
            if kind.elementType.simpleString() in ("string", "binary"):
                wide.append(F.coalesce(F.aggregate(value, F.lit(0), lambda n, x: n + 8 + F.coalesce(F.octet_length(x), F.lit(0))), F.lit(0)))
            else:
                wide.append(F.coalesce(F.size(value) * each, F.lit(0)))
        elif isinstance(kind, (StringType, BinaryType)):
            wide.append(F.coalesce(F.octet_length(value), F.lit(0)))
        fixed += 8 * (len(kind.fields) if isinstance(kind, StructType) else 1)
    return reduce(lambda a, b: a + b, wide, F.lit(fixed)) if wide else fixed


def sized(rows: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``rows``, to be broadcast if they have at most ``most`` bytes; else joined by a shuffle.

    For stored tables, which are read for it: only their count if all columns have a fixed width.
    """
    width = row_bytes(rows)
    total = rows.count() * width if isinstance(width, int) else rows.agg(F.sum(width.cast("long"))).first()[0] or 0
    return F.broadcast(rows) if total <= most else rows


def row_key() -> Column:
    """Stands for a row (doc_id, text) where only some rows have to be found again."""
    return F.xxhash64("doc_id", "text")
