"""Connected components of a graph that lies in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b): the smallest node reachable.

    Alternates large-star and small-star steps until nothing changes; the number of
    rounds grows with the logarithm of the longest path, not with the path.  Each
    round is stored, so a lost executor never costs more than a round.  Minima are
    pre-aggregated; the joins back are plain ones that may be split.  Loops and
    repeated edges are allowed, nulls are not.
    """
    low, high = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    now = table(edges.select(low, high).where("low < high").distinct(), "edges")
    mark = _mark(now)
    while True:
        both = now.select(F.col("low").alias("u"), F.col("high").alias("v")).union(now.select("high", "low"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = (
            large.join(least, "high")
            .where("low > m")
            .select(F.col("m").alias("low"), F.col("low").alias("high"))
            .union(least.select("m", "high"))
            .distinct()
        )
        now, before = table(small, "edges"), mark
        mark = _mark(now)
        if mark == before:
            break
    roots = now.select("low").distinct()
    return now.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        roots.select("low", F.col("low").alias("component"))
    )


def _mark(edges: DataFrame) -> tuple:
    """Tells one set of edges from another: its size and two folds of its hashes."""
    code = F.xxhash64("low", "high")
    return tuple(edges.agg(F.count("*"), F.bit_xor(code), F.sum(F.pmod(code, F.lit(2**31 - 1)))).first())
