"""Exact substring dedup: bytes covered by a string that also starts elsewhere go.

The order of all suffixes is needed only through ``length`` bytes.  They are sorted by
content, most significant digits first: by the anchor of their first ``length`` bytes, then
by digests of ever finer groups; a group that is alone needs no further pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table
from tidemark.llm.repeats import Window, merged, mixed, numbered, repeated_windows, stretches, with_stretches

_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_units(text: str) -> np.ndarray:
    return _BYTES[np.frombuffer(text.encode(), dtype=np.uint8)]


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"


def remove_repeats(docs: DataFrame, length: int = 400, gram: int = 32) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): what stays once repeated bytes are gone.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same
    document or another, overlaps included.  Strings are judged on the input and never
    cross documents.  Null texts are empty; shorter texts stay whole; repeated rows
    repeat each other.  ``spans`` are the maximal removed runs.
    """
    w = Window(length, min(gram, length), (16, 1))
    rows = numbered(docs, F.xxhash64("doc_id", "text"))
    found = stretches(repeated_windows(rows, byte_units, w, earlier=False), by_first=False)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, lists in zip(batch["doc_id"].to_pylist(), batch["text"], batch["covered"]):
                data = text.as_py().encode()
                spans = []
                if lists.is_valid:
                    flat = lists.values
                    lo, hi = flat.field(0).to_numpy(), flat.field(1).to_numpy()
                    spans = merged(np.stack([lo, hi.astype(np.int64) + length], axis=1))
                digest, at = hashlib.sha256(), 0
                for start, stop in spans:
                    digest.update(data[at:start])
                    at = stop
                digest.update(data[at:])
                removed = sum(b - a for a, b in spans)
                out.append((doc_id, len(data), removed, len(spans), digest.hexdigest(), [{"start": a, "stop": b} for a, b in spans]))
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            kinds = [pa.int64()] * 4 + [pa.string(), span]
            columns = list(zip(*out)) or [()] * 6
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    with small_batches(docs.sparkSession):
        full = with_stretches(rows, found)
        return table(full.select("doc_id", "text", "covered").mapInArrow(cut, RESULT), "without-repeats")
