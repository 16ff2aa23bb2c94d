"""Line dedup: exact copies and lines within a few edits, in built-in functions only.

A segment-partition join finds the near ones.  A line is cut into threshold + 1
segments; a line within ``threshold`` edits has one of them unchanged, at a place that
its length and the segment's number confine.  Segments and those substrings are keys
(number, length of the indexed line, text); lines that meet on a key are verified by
a banded edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, sized, table

LEAST_CHARS = 20  # shorter lines are never compared by edits
THRESHOLD = 1


def lines_of(docs: DataFrame, least_chars: int) -> DataFrame:
    """One row per line that counts: row key, doc_id, number, text."""
    pieces = F.split(F.coalesce("text", F.lit("")), "\n")
    rows = docs.select(row_key().alias("key"), "doc_id", F.posexplode(pieces).alias("line_no", "line"))
    return rows.where(F.length("line") >= least_chars)


def place() -> Column:
    """Order of occurrences: by doc_id, nulls last, then line."""
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("line_no").alias("line_no")
    )


def codes() -> list[Column]:
    """Two independent hashes: 128 bits tell lines apart."""
    return [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("second"), F.col("line")).alias("h2")]


def with_segment_keys(lines: DataFrame, threshold: int) -> DataFrame:
    """``lines`` (line) with one row per key: code, and whether it is an own segment.

    A key is one of the line's own segments, or a substring by which it finds lines up to
    ``threshold`` characters shorter.  For segment i of a line shorter by d, a substring that
    is shifted by s needs at least ``|s|`` edits to its left and ``|s - d|`` to its right; the
    segment is the first unchanged one, so there are at least i edits to the left.  That
    leaves |s| <= i and |s - d| <= threshold - i.
    """
    parts = threshold + 1
    # lengths are computed once: in the keys they would be counted again for each
    sizes = lines.select("line", F.length("line").alias("size"))
    each = [F.expr(f"cast((size - {d}) div {parts} as int)").alias(f"base{d}") for d in range(parts)]
    each += [F.expr(f"cast({parts} - (size - {d}) % {parts} as int)").alias(f"plain{d}") for d in range(parts)]
    cut = sizes.select("line", "size", *each)
    rows = []
    for shorter in range(threshold + 1):
        base, plain = F.col(f"base{shorter}"), F.col(f"plain{shorter}")  # segments before the longer ones
        for i in range(parts):
            width = base + (F.lit(i) >= plain).cast("int")
            start = base * i + F.greatest(F.lit(0), F.lit(i) - plain)
            for shift in range(-i, i + 1):
                if abs(shift - shorter) > threshold - i:
                    continue
                at = start + shift
                part = F.substring("line", at + 1, width)
                # a substring that would leave the line is cut there, or moved: such keys only meet in vain
                code = F.xxhash64(F.lit(i), F.col("size") - shorter, part)
                rows.append(F.struct(code.alias("code"), F.lit(not shorter and not shift).alias("indexed")))
    return cut.select("line", F.explode(F.array(*rows)).alias("key")).select("line", "key.*")


def near_lines(lines: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(a, b): all pairs of different lines within ``threshold`` edits, each pair both ways.

    First, by hashes alone, the keys on which different lines meet, pre-aggregated so that
    a line in a third of all documents is one row per task.  Then only lines with
    such a key travel, once each.  A pair is verified where it meets, in the
    condition of the join: what leaves the join are true pairs, however many lines share
    a segment, and a key with many lines is split like any other skewed join.
    """
    keyed = with_segment_keys(lines, threshold)
    shared = (
        keyed.select("code", "indexed", F.xxhash64("line").alias("h"))
        .groupBy("code")
        .agg(F.min("h").alias("low"), F.max("h").alias("high"), F.max("indexed").alias("indexed"))
        .where("low != high and indexed")
        .select("code")
    )
    shared = table(shared, "segments")
    meeting = table(keyed.join(sized(shared), "code").distinct(), "meeting")
    a, b = meeting.where("indexed").alias("a"), meeting.alias("b")
    near = F.levenshtein(F.col("a.line"), F.col("b.line"), threshold) >= 1
    longer = F.length("a.line") <= F.length("b.line")
    pairs = a.join(b, (F.col("a.code") == F.col("b.code")) & longer & (F.col("a.line") != F.col("b.line")) & near)
    pairs = pairs.select(F.col("a.line").alias("a"), F.col("b.line").alias("b"))
    return pairs.union(pairs.select("b", "a")).distinct()


def dedup_lines(
    docs: DataFrame, threshold: int = THRESHOLD, least_chars: int = LEAST_CHARS, exact_chars: int | None = None
) -> DataFrame:
    """All columns of ``docs`` (doc_id, text, ...) with ``kept_text``, ``n_lines`` and ``n_removed``.

    A line of at least ``least_chars`` characters goes if an equal line, or one within
    ``threshold`` edits, stands earlier: in a smaller doc_id or above it in the same text.
    Shorter lines of at least ``exact_chars`` characters go if an equal line stands earlier;
    those below it stay, and all shorter ones if it isn't given.
    Lines are judged on the input, not on what is left.  Null
    doc_ids come last; rows with equal doc_id and line number are equally early, so repeated
    rows don't empty each other.  A null text is one empty line.  Lines end at
    line feeds.
    """
    lines = lines_of(docs, least_chars if exact_chars is None else min(exact_chars, least_chars))
    firsts = table(lines.groupBy(*codes()).agg(F.min(place()).alias("first"), F.count("*").alias("n")), "lines")
    near = table(near_lines(lines.where(F.length("line") >= least_chars), threshold), "near-lines")
    mine, other = ([F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("second"), F.col(x)).alias("h2")] for x in ("a", "b"))
    around = (
        near.select(F.struct(*mine).alias("a"), *other)
        .join(firsts, ["h1", "h2"])
        .groupBy("a")
        .agg(F.min("first").alias("near"))
        .select("a.*", "near")
    )
    marked = (
        firsts.join(around, ["h1", "h2"], "left")
        .where("n > 1 or near is not null")
        .select("h1", "h2", F.least("first", F.coalesce("near", "first")).alias("first"))
    )
    marked = table(marked, "marked-lines")
    gone = (
        lines.select("key", place().alias("place"), *codes())
        .join(sized(marked), ["h1", "h2"])
        .where("first < place")
        .groupBy("key")
        .agg(F.collect_set("place.line_no").alias("gone"))
    )
    gone = table(gone, "removed-lines")
    kept = docs.columns
    wide = docs.withColumn("__key", row_key()).withColumn("__lines", F.split(F.coalesce("text", F.lit("")), "\n"))
    wide = wide.join(sized(gone.select(F.col("key").alias("__key"), F.col("gone").alias("__gone"))), "__key", "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.coalesce("__gone", F.array().cast("array<int>")))
    wide = wide.withColumn("__left", F.when(F.col("__gone").isNotNull(), left))
    whole = F.array_join(F.transform("__left", lambda i: F.get("__lines", i)), "\n")
    return wide.select(
        *(F.col(f"`{c}`") for c in kept if c not in ("kept_text", "n_lines", "n_removed")),
        F.when(F.col("__left").isNull(), F.coalesce("text", F.lit(""))).otherwise(whole).alias("kept_text"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("__lines") - F.size("__left"), F.lit(0)).cast("long").alias("n_removed"),
    )
