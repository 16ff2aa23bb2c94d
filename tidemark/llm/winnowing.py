"""Document fingerprints by winnowing, in built-in functions only.

A text's tokens are its words, long ones in pieces of twelve characters.  Each token is hashed
once; the k-grams have the values of a rolling polynomial hash over those codes.  Of each
window of w hashes the smallest is kept, the rightmost of equal ones, with its position.  Two texts that share w + k - 1
tokens in a row therefore share a kept hash; nothing shorter than k tokens matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import partitions

TOKEN = r"[^\x20\x09-\x0D]{1,12}"
K, W = 3, 5
POSITION_BITS = 31  # of a kept value, as many as an array's places; the 31 bits above are the hash
_LAST = (1 << POSITION_BITS) - 1
PRIME = (1 << 31) - 1
BASE = 1_000_003


def with_marks(df: DataFrame, text: Column, name: str, k: int = K, w: int = W) -> DataFrame:
    """``df`` with the array ``name`` of kept values: hash, then the position counted down.

    The position is counted down so that of equal hashes the rightmost is the smallest
    value: one minimum finds both.  Fewer than k tokens are one gram, fewer than w
    grams one window, no tokens an empty array.
    """
    tokens, grams = f"__tokens_{name}", f"__grams_{name}"
    words = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    df = df.withColumn(tokens, F.transform(words, lambda x: F.pmod(F.xxhash64(x), F.lit(PRIME - 1)) + 1))
    size = F.size(tokens)

    def gram(x: Column, i: Column) -> Column:
        # The rolling hash H(i + 1) = (H(i) - c(i) B^(k-1)) B + c(i + k), from the codes of each place at
        # once: carrying H along would copy the array at every step.  Past the end a code is 0.
        codes = [x, *(F.coalesce(F.get(tokens, i + j), F.lit(0)) for j in range(1, k))]
        parts = [F.pmod(c * F.lit(pow(BASE, k - 1 - j, PRIME)), F.lit(PRIME)) for j, c in enumerate(codes)]
        code = F.pmod(sum(parts[1:], parts[0]), F.lit(PRIME)).cast("long")
        return F.shiftleft(code, POSITION_BITS) + (F.lit(_LAST) - i.cast("long"))

    whole = F.slice(F.transform(F.col(tokens), gram), F.lit(1), F.greatest(size - (k - 1), F.least(size, F.lit(1))))
    df = df.withColumn(grams, whole)
    many = F.size(grams)
    least = F.transform(
        F.col(grams), lambda x, i: F.least(x, *(F.get(grams, i + j) for j in range(1, w)))
    )
    kept = F.slice(least, F.lit(1), F.greatest(many - (w - 1), F.least(many, F.lit(1))))
    return df.withColumn(name, F.array_distinct(kept)).drop(tokens, grams)


def hashes(marks: str) -> Column:
    return F.transform(F.col(marks), lambda x: F.shiftright(x, POSITION_BITS))


def positions(marks: str) -> Column:
    return F.transform(F.col(marks), lambda x: F.lit(_LAST) - x.bitwiseAND(F.lit(_LAST)))


def as_text(marks: str) -> Column:
    """The kept hashes in order of position, in hexadecimal."""
    return F.array_join(F.transform(F.col(marks), lambda x: F.hex(F.shiftright(x, POSITION_BITS))), " ")


def with_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Share of kept hashes that two sets of marks have in common; 1 for two empty ones."""
    sets = df.withColumn("__a", F.array_distinct(hashes(a))).withColumn("__b", F.array_distinct(hashes(b)))
    sets = sets.withColumn("__both", F.size(F.array_intersect("__a", "__b")))
    every = F.size("__a") + F.size("__b") - F.col("__both")
    share = F.when(every == 0, 1.0).otherwise(F.col("__both") / every)
    return sets.withColumn(name, share.cast("double")).drop("__a", "__b", "__both")


def with_next(df: DataFrame, ranges: int) -> tuple[DataFrame, Window]:
    """``df`` (doc_id, text) in ranges of ascending doc_id, and the window in which ``lead``
    is the next row, across all ranges and from the last row to the first.

    The ranges start at doc_ids that exist, so a range's first row can be told from its
    doc_id alone: it is sent to the range before as well (``guest``), to stand behind its last
    row, and the very first row to the last range.  One shuffle deals all rows; none
    needs to meet the others in one task.  Nulls come first; rows with equal ids follow
    their texts.
    """
    ends = df.agg(
        F.min("doc_id"), F.count_if(F.col("doc_id").isNull()), F.expr(f"approx_percentile(doc_id, {_shares(ranges)}, 100000)")
    ).first()
    starts = sorted(set(ends[2] or []))
    id = F.col("doc_id")
    range_of = F.size(F.filter(F.lit(starts), lambda x: x <= id)) if starts else F.lit(0)
    range_of = F.when(id.isNull(), 0).otherwise(range_of)
    first = id.isNull() if ends[1] else id == F.lit(ends[0])
    own = F.struct(range_of.alias("range"), F.lit(False).alias("guest"), F.lit(False).alias("wrapped"))
    before = F.struct((range_of - 1).alias("range"), F.lit(True).alias("guest"), F.lit(False).alias("wrapped"))
    around = F.struct(F.lit(len(starts)).alias("range"), F.lit(True).alias("guest"), F.lit(True).alias("wrapped"))
    places = F.array_compact(
        F.array(own, F.when(id.isin(starts) & (range_of > 0), before) if starts else F.lit(None).cast(_PLACE), F.when(first, around))
    )
    dealt = df.withColumn("__place", F.explode(places)).select("*", "__place.*").drop("__place")
    return dealt, Window.partitionBy("range").orderBy("wrapped", F.col("doc_id").asc_nulls_first(), "text")


_PLACE = "struct<range:int,guest:boolean,wrapped:boolean>"


def _shares(ranges: int) -> str:
    return "array(" + ", ".join(f"{i / ranges:.6f}" for i in range(1, max(2, ranges))) + ")"


def fingerprint_documents(docs: DataFrame, k: int = K, w: int = W, ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness.

    The edited text has the last half of the code points replaced by as many from the start of
    the next document (ascending doc_id, the first after the last).  A null text is empty.
    Repeated rows are each other's next.  ``marks`` and ``edited_marks`` hold hashes with positions.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    dealt, order = with_next(rows, ranges or partitions(docs.sparkSession))
    dealt = dealt.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    following = F.lead("text").over(order)
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("__next", F.lit(1), half)
    )
    full = dealt.withColumn("__next", following).withColumn("edited", edited).drop("__next")
    full = with_marks(full, F.col("text"), "marks", k, w).withColumn("__next_marks", F.lead("marks").over(order))
    own = full.where(~F.col("guest"))
    own = with_marks(own, F.col("edited"), "edited_marks", k, w)
    own = with_likeness(own, "marks", "edited_marks", "near_edited")
    own = with_likeness(own, "marks", "__next_marks", "near_next")
    return own.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        "marks",
        "edited_marks",
        "near_edited",
        "near_next",
    )
