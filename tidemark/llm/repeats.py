"""Repeated windows of a fixed length: the search that two operators share.

A window is ``length`` units (bytes, or words) of one document.  All windows of all
documents would be too many to sort, so they are handled in groups:

1.  *Sampling by content.*  Of the k-grams in a window the one with the smallest hash
    (the leftmost of equal ones) is its anchor.  Equal windows have equal anchors at
    the same offset, so windows need to be compared only under an anchor of equal
    content.  Consecutive windows with the same anchor are one item.
2.  *Radix passes.*  An item is sorted by digests of its content.  The *core* is what all
    its windows share; an item whose core nobody else has holds no repeated window and
    is dropped.  The *span* is all that its windows cover; items with equal spans
    are repeated as a whole, and one of them goes on for the others.  What is left is
    cut by aligned ranges of the offset into finer items, down to single windows,
    for which core, span and window are the same: equal groups are exactly the
    repeated windows.

Digests of spans have 128 bits, those of cores 64: two cores with one digest only
cost a needless cut.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sized, table

CHUNK = 1 << 20  # units handled at once; a longer text is several pieces
U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)  # odd, so that they have inverses
_ROUNDS = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


class Window(NamedTuple):
    length: int  # units in a window
    gram: int  # units in the k-gram that makes an anchor
    cells: tuple[int, ...]  # offsets in a range, pass by pass; the last is 1


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(33))
    for c in _ROUNDS:
        h = h * U(c)
        h = h ^ (h >> U(29))
    return h


_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of the bases and of their inverses, made once in each worker."""
    if not _powers:
        for base in _BASES:
            both = (base, pow(base, -1, 1 << 64))
            _powers.append(tuple(np.multiply.accumulate(np.r_[U(1), np.full(CHUNK, U(b))]) for b in both))
    return _powers


class Digests:
    """Digests of any stretch of a sequence of 64-bit units, from running sums."""

    def __init__(self, units: np.ndarray):
        self.sums = []
        for lane, (up, _) in enumerate(powers()):
            values = units if not lane else mixed(units + U(_ROUNDS[0]))
            self.sums.append(np.r_[U(0), np.add.accumulate(values * up[: len(units)])])

    def of(self, start: np.ndarray, stop: np.ndarray, lane: int = 0) -> np.ndarray:
        sums, (_, down) = self.sums[lane], powers()[lane]
        return mixed((sums[stop] - sums[start]) * down[start])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def ramps(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, value): for each owner ``count`` values from ``first`` on."""
    owner = np.repeat(np.arange(len(count)), count)
    return owner, first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)


def runs(digests: Digests, begin: np.ndarray, size: np.ndarray, w: Window) -> tuple[np.ndarray, ...]:
    """Consecutive windows with one anchor: (piece, anchor, first and last start)."""
    n = int(begin[-1] + size[-1]) if len(begin) else 0
    piece, start = ramps(begin, np.maximum(size - w.length + 1, 0))
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    at = np.arange(n - w.gram + 1)
    low = U(CHUNK - 1)
    grams = (digests.of(at, at + w.gram) & ~low) | at.astype(np.uint64)
    anchor = (sliding_minimum(grams, w.length - w.gram + 1)[start] & low).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(start)] - 1
    return piece[first], anchor[first], start[first], start[last]


def keyed(digests: Digests, anchor, lo, hi, cell: int, w: Window) -> tuple[np.ndarray, ...]:
    """Items cut by ranges of ``cell`` offsets (0: not cut): owner, lo, hi, core, span twice.

    The core of a range is what all windows with an offset in it share, also those that
    this item doesn't have: another item may have them under the same anchor.
    """
    most = w.length - w.gram
    least, last = anchor - hi, anchor - lo  # offsets of the anchor in the windows
    if cell:
        owner, number = ramps(least // cell, last // cell - least // cell + 1)
        bottom, top = number * cell, np.minimum(number * cell + cell - 1, most)
    else:
        owner = number = np.arange(len(anchor))
        bottom, top = np.zeros_like(anchor), np.full_like(anchor, most)
        number = bottom
    a = anchor[owner]
    from_, to = np.maximum(least[owner], bottom), np.minimum(last[owner], top)
    core = mixed(digests.of(a - bottom, a - top + w.length) + number.astype(np.uint64))
    place = (from_ * (w.length + 1) + to).astype(np.uint64)
    spans = [mixed(digests.of(a - to, a - from_ + w.length, lane) ^ mixed(place + U(lane))) for lane in (0, 1)]
    return owner, a - to, a - from_, core, *spans


ITEMS = "key long, doc long, copies int, anchor int, lo int, hi int, core long, span1 long, span2 long"


def _batch(key, doc, copies, anchor, lo, hi, core, span1, span2) -> pa.RecordBatch:
    small = [pa.array(x.astype(np.int32)) for x in (copies, anchor, lo, hi)]
    codes = [pa.array(x.view(np.int64)) for x in (core, span1, span2)]
    names = [x.split()[0] for x in ITEMS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), *small, *codes], names=names)


def _pieces(batch: pa.RecordBatch, units_of: Callable, w: Window) -> Iterator[tuple]:
    """Texts of a batch, joined to chunks of at most CHUNK units:
    (units, begin, size, row, base), one entry per piece.  Pieces of a long text overlap by a
    window less one unit, so each window is in exactly one."""
    step = CHUNK // 2
    units, begin, size, rows, bases, total = [], [], [], [], [], 0
    for row, text in enumerate(batch["text"]):
        every = units_of(text.as_py())
        for base in range(0, max(len(every) - w.length + 1, 0), step):
            part = every[base : base + step + w.length - 1]
            if total + len(part) > CHUNK:
                yield np.concatenate(units), np.array(begin), np.array(size), np.array(rows), np.array(bases)
                units, begin, size, rows, bases, total = [], [], [], [], [], 0
            begin.append(total)
            units.append(part)
            size.append(len(part))
            rows.append(row)
            bases.append(base)
            total += len(part)
    if units:
        yield np.concatenate(units), np.array(begin), np.array(size), np.array(rows), np.array(bases)


def first_items(docs: DataFrame, units_of: Callable, w: Window) -> DataFrame:
    """The items of all documents (key, doc, copies, text): one per anchor and stretch."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, doc, copies = (batch[name].to_numpy() for name in ("key", "doc", "copies"))
            for units, begin, size, rows, bases in _pieces(batch, units_of, w):
                digests = Digests(units)
                piece, anchor, lo, hi = runs(digests, begin, size, w)
                _, lo, hi, *codes = keyed(digests, anchor, lo, hi, 0, w)
                row, shift = rows[piece], (bases - begin)[piece]
                yield _batch(key[row], doc[row], copies[row], anchor + shift, lo + shift, hi + shift, *codes)

    return docs.select("key", "doc", "copies", "text").mapInArrow(scan, ITEMS)


def finer_items(docs: DataFrame, left: DataFrame, units_of: Callable, cell: int, w: Window, most: int = 4_000_000) -> DataFrame:
    """The items ``left`` (stored), cut into ranges of ``cell`` offsets.

    They return to their texts as one list per document.  Up to ``most`` items (12 bytes each)
    the lists are broadcast and texts stay in place; beyond that both are shuffled.
    """
    lists = left.groupBy("key").agg(F.collect_list(F.struct("anchor", "lo", "hi")).alias("items"))
    if left.count() <= most:
        lists = F.broadcast(lists)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                units = units_of(batch["text"][i].as_py())
                flat = batch["items"][i].values
                anchor, lo, hi = (flat.field(j).to_numpy().astype(np.int64) for j in range(3))
                # items share pieces of the text, so that long texts are digested bit by bit
                part = lo // (CHUNK // 2)
                for p in np.unique(part):
                    here = part == p
                    base = int(p) * (CHUNK // 2)
                    digests = Digests(units[base : base + CHUNK - 1])
                    a = anchor[here] - base
                    owner, low, high, *codes = keyed(digests, a, lo[here] - base, hi[here] - base, cell, w)
                    ids = [np.full(len(owner), batch[name][i].as_py(), dtype=np.int64) for name in ("key", "doc", "copies")]
                    yield _batch(*ids, a[owner] + base, low + base, high + base, *codes)

    return docs.join(lists, "key").select("key", "doc", "copies", "text", "items").mapInArrow(scan, ITEMS)


def once(docs: DataFrame) -> DataFrame:
    """Rows (key, doc, text), one for each ``key``, with ``copies``: how many rows it stands for."""
    repeated = docs.groupBy("key").agg(F.count("*").cast("int").alias("copies")).where("copies > 1")
    repeated = table(repeated.withColumnRenamed("key", "__key"), "repeated-rows")
    docs = docs.select("key", "doc", "text")
    if repeated.isEmpty():
        return docs.withColumn("copies", F.lit(1))
    named = sized(repeated)
    single = docs.join(named, F.col("key") == F.col("__key"), "left_anti").withColumn("copies", F.lit(1))
    return single.union(docs.join(named, F.col("key") == F.col("__key")).drop("__key").dropDuplicates(["key"]))


COVERED = "key long, doc long, lo int, hi int, first long"


def repeated_windows(docs: DataFrame, units_of: Callable, w: Window, earlier: bool) -> DataFrame:
    """(key, doc, lo, hi, first): stretches of window starts that are repeated.

    ``docs`` has ``key`` (names the row), ``doc`` (its order) and ``text``.  With ``earlier`` a window
    counts if it also starts in a row with a smaller ``doc``; else if it also starts
    anywhere else, the same text included.  ``first`` is the smallest ``doc`` with that stretch.
    Groups are only ever counted and joined: a passage that a third of all documents
    have is pre-aggregated, and one of its items goes on.  Rows that are equal in id and text
    are searched once, as so many copies.
    """
    docs = once(docs)
    found = []
    items = table(first_items(docs, units_of, w), "items")
    for cell in [*w.cells, None]:
        counts = items.groupBy("core").agg(F.sum("copies").alias("n"), F.min("doc").alias("low"), F.max("doc").alias("high"))
        alive = table(counts.where("low != high" if earlier else "n > 1").select("core"), "cores")
        items = table(items.join(sized(alive), "core"), "alive")
        spans = ["core", "span1", "span2"]
        groups = table(
            items.groupBy(*spans).agg(
                F.sum("copies").alias("n"), F.min("doc").alias("first"), F.min(F.struct("key", "lo")).alias("one")
            ),
            "spans",
        )
        variety = groups.groupBy("core").agg(F.count("*").alias("kinds")).where("kinds > 1").select("core", F.lit(True).alias("more"))
        groups = groups.join(variety, "core", "left")
        judged = items.join(groups, spans)
        covered = F.col("first") < F.col("doc") if earlier else F.col("n") > 1
        goes_on = ~covered if earlier else (F.col("one") == F.struct("key", "lo"))
        judged = table(
            judged.select(
                "key", "doc", "anchor", "lo", "hi", "first", covered.alias("covered"),
                (goes_on & F.col("more").isNotNull()).alias("goes_on"),
            ).where("covered or goes_on"),
            "judged",
        )
        found.append(judged.where("covered").select("key", "doc", "lo", "hi", "first"))
        if cell is None:
            break
        left = table(judged.where("goes_on").select("key", "anchor", "lo", "hi"), "left")
        items = table(finer_items(docs, left, units_of, cell, w), "items")
    return reduce(DataFrame.union, found)


STRETCHES = "key long, covered array<struct<lo:int,hi:int,first:long>>"


def stretches(covered: DataFrame, by_first: bool) -> DataFrame:
    """One row per key with its covered window starts, neighbouring stretches joined; stored.

    With ``by_first`` only stretches with the same first document are joined, else ``first`` is 0.
    What is left of a document is few numbers, however long its repeats.
    """
    first = F.col("first") if by_first else F.lit(0).cast("long")
    lists = covered.select("key", F.struct("lo", "hi", first.alias("first")).alias("one")).groupBy("key").agg(
        F.collect_set("one").alias("every")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32()), ("first", pa.int64())]))
        for batch in batches:
            out = []
            for every in batch["every"]:
                lo, hi, owner = (every.values.field(i).to_numpy() for i in range(3))
                joined: list[dict] = []
                for i in np.lexsort((hi, lo, owner)).tolist():
                    last = joined[-1] if joined else None
                    if last and last["first"] == owner[i] and lo[i] <= last["hi"] + 1:
                        last["hi"] = max(last["hi"], int(hi[i]))
                    else:
                        joined.append({"lo": int(lo[i]), "hi": int(hi[i]), "first": int(owner[i])})
                out.append(joined)
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(out, kind)], names=["key", "covered"])

    return table(lists.mapInArrow(join, STRETCHES), "stretches")


def with_stretches(docs: DataFrame, found: DataFrame, most: int = 2_000_000) -> DataFrame:
    """``docs`` with the list ``covered`` of each row, null for none.

    Up to ``most`` stretches (16 bytes each) are broadcast and texts stay in place; beyond that
    both are shuffled.
    """
    total = found.agg(F.sum(F.size("covered"))).first()[0] or 0
    return docs.join(F.broadcast(found) if total <= most else found, "key", "left")


def numbered(docs: DataFrame, order: Column) -> DataFrame:
    """(doc_id, key, doc, text): what the search needs; nulls as empty texts."""
    return docs.select(
        "doc_id", F.xxhash64("doc_id", "text").alias("key"), order.alias("doc"), F.coalesce("text", F.lit("")).alias("text")
    )


def merged(covered: np.ndarray) -> list[tuple[int, int]]:
    """Sorted, joined [lo, hi) of rows (lo, hi)."""
    out: list[list[int]] = []
    for lo, hi in sorted(map(tuple, covered.tolist())):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(x) for x in out]
