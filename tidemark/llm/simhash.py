"""Near duplicates by SimHash, searched through tables of pivot distances.

Each fingerprint is described by its Hamming distances to many reference
fingerprints (pivots).  By the triangle inequality two fingerprints within r
bits differ by at most r in *every* coordinate; pairs beyond that are discarded
without looking at the fingerprints, survivors are verified.

So that pairs needn't be enumerated, some pivots have few bits: the origin and
one pivot for each pair of neighbouring bits.  The difference of the distances
to the origin and to such a pivot depends on two bits only.  Two flipped bits
therefore change at most two of those 32 differences: cut into four groups of eight,
two fingerprints within two bits agree on two whole groups at least.  The
groups' differences, two groups at a time, are the keys of an equality join.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.graph import components

RADIUS = 2
GROUPS = RADIUS + 2
FINGERPRINTS = "doc_id long, fp long"


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


#: Pivots over all bits, for the coordinates that discard pairs: spread by multiples of an odd number.
WIDE = [0] + [signed(0x9E3779B97F4A7C15 * i % 2**64) for i in range(1, 8)]
#: Pivots of two bits, for the keys.
NARROW = [signed(3 << (2 * i)) for i in range(32)]


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of the shingles of a text, as an unsigned number; 0 without words."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    n = max(1, len(found) - words + 1)
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):
        part = found[at : min(at + (1 << 14), n) + words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(words)))) if len(found) >= words else [b" ".join(found)]
        codes = b"".join([xxhash.xxh64_digest(x, seed) for x in shingles])
        bits = np.unpackbits(np.frombuffer(codes, dtype=np.uint8)).reshape(-1, 64)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * total > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp) of each row of ``docs``, stored; nulls count as empty."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), words) for x in batch["text"]], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    return table(docs.select("doc_id", "text").mapInArrow(each, FINGERPRINTS), "fingerprints")


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivot_table(fps: DataFrame) -> DataFrame:
    """Each fingerprint's coordinates ``c0..`` and one row for each of its keys."""
    fp = F.col("fp")
    coordinates = [distance(fp, F.lit(p)).cast("byte").alias(f"c{i}") for i, p in enumerate(WIDE)]
    origin = distance(fp, F.lit(0))
    size = len(NARROW) // GROUPS
    groups = []
    for g in range(GROUPS):
        # distance to the origin less that to the pivot: -2, 0 or 2
        digits = [(origin - distance(fp, F.lit(p)) + 2) / 2 for p in NARROW[g * size : (g + 1) * size]]
        groups.append(reduce(lambda code, d: code * 3 + d, digits).cast("long"))
    most = 3**size
    keys = [
        F.lit(n * most * most) + groups[g] * most + groups[h] for n, (g, h) in enumerate(combinations(range(GROUPS), 2))
    ]
    return fps.select("fp", *coordinates, F.explode(F.array(*keys)).alias("key"))


def links(fps: DataFrame, dense: int = 512) -> DataFrame:
    """(a, b): enough pairs of distinct fingerprints within two bits to connect all that are.

    Keys with up to ``dense`` members are joined: pivot coordinates discard, the Hamming
    distance verifies, every pair is returned.  A key with more (a large group of near
    copies) isn't joined pair by pair: each of its members names the 65 values
    within one bit of it, and members that name the same value - which two values
    do exactly if they lie within two bits - are linked to the smallest of them.  So
    no link between components is lost and the work is linear in the members.
    """
    keyed = table(pivot_table(fps), "pivots")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = keyed.join(sizes, "key")
    few = shared.where(F.col("members") <= dense).drop("members")
    a, b = few.alias("a"), few.alias("b")
    near = reduce(
        lambda x, y: x & y,
        [F.abs(F.col(f"a.c{i}") - F.col(f"b.c{i}")) <= RADIUS for i in range(len(WIDE))],
    )
    pairs = a.join(
        b,
        (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & near
        & (distance(F.col("a.fp"), F.col("b.fp")) <= RADIUS),
    ).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))
    crowded = shared.where(F.col("members") > dense).select("fp").distinct()
    around = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)))
    named = crowded.select("fp", F.explode(around).alias("value"))
    least = named.groupBy("value").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    hubs = named.join(least, "value").where("fp > a").select("a", F.col("fp").alias("b")).distinct()
    return pairs.union(hubs)


def near_duplicates(docs: DataFrame, words: int = 3, dense: int = 512) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id for each row of ``docs`` (doc_id, text).

    Fingerprints within two bits are linked; ``component_id`` is the smallest doc_id that
    can be reached.  Equal fingerprints are one node, however many documents have it.
    Texts without words have fingerprint zero and are linked like any other.  A null
    ``doc_id`` keeps its row; it is no component's id unless all its members are null.
    """
    each = fingerprints(docs, words)
    nodes = each.groupBy("fp").agg(F.min("doc_id").alias("first"))
    found = components(links(nodes.select("fp"), dense)).withColumnRenamed("node", "fp")
    members = table(
        nodes.join(found, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component")), "members"
    )
    smallest = members.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = members.join(smallest, "component").select("fp", "component_id")
    return each.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
