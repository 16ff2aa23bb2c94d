"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its
result is stored before the next one reads it.  All but the last return the columns of
``docs``.  Decisions travel as keys of rejected rows, texts stay where they are
as long as those keys are few enough to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, lines, packing, simhash, toxicity
from tidemark.llm.common import documents, row_key, sized, table
from tidemark.llm.queries import tokenizer_path

ORACLE_SQL = None  # SQL has no fingerprints of bits, learned scores or packing: see tests/llm


def without(docs: DataFrame, rejected: DataFrame, key: Column) -> DataFrame:
    """``docs`` but for the rows whose ``key`` is in the stored column ``rejected.key``."""
    named = rejected.select(F.col("key").alias("__rejected"))
    return docs.join(sized(named), key == F.col("__rejected"), "left_anti")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned score rejects go; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.learn(docs, labels)
    scored = toxicity.score_toxicity(docs.select(row_key().alias("doc_id"), "text"), model)
    rejected = table(scored.where("predicted = 1").select(F.col("doc_id").alias("key")).distinct(), "toxic")
    return without(docs, rejected, row_key())


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in an earlier place go; every document stays.

    Lines of 20 characters or more are compared within two edits, all shorter ones but
    empty ones exactly.
    """
    found = lines.dedup_lines(docs, threshold=2, exact_chars=1)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    kind = dict(docs.dtypes)
    return found.select(*(changed[c].cast(kind[c]).alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays: that with the smallest id, nulls last.

    Groups are those of the SimHash operator: shingles of three words, links at two bits or
    fewer.  Rows are judged by id and text, so one of several texts under one id can go
    without the others.  Rows that are equal in both share a key, and one of them stays.
    """
    found = simhash.near_duplicates(docs.select(row_key().alias("doc_id"), "text"))
    groups = found.select(F.col("doc_id").alias("key"), "component_id").dropDuplicates(["key"])
    rows = docs.groupBy(row_key().alias("key")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    members = table(rows.join(groups, "key"), "members")
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")
    firsts = members.groupBy("component_id").agg(F.min(place)["key"].alias("first"), F.count("*").alias("n"))
    firsts = table(firsts.where("n > 1").select("component_id", "first"), "firsts")
    rejected = members.join(sized(firsts), "component_id").where("key != first").select("key")
    kept = without(docs, table(rejected, "near-duplicates"), row_key())
    repeated = table(members.where("copies > 1").select("key"), "repeated")
    again = kept.join(sized(repeated.select(F.col("key").alias("__again"))), row_key() == F.col("__again"), "left_semi")
    one = again.withColumn("__key", row_key()).dropDuplicates(["__key"]).drop("__key")
    return without(kept, repeated, row_key()).union(one)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, decontamination.held_items(docs, benchmark).select("key"), row_key())


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near duplicates", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = table(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
