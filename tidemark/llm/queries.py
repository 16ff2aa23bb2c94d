"""The named queries of these operators, and SQL for the same rows where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    collocations,
    decontamination,
    licenses,
    lines,
    maintext,
    merkle,
    packing,
    phrases,
    simhash,
    suffixes,
    toxicity,
    warc,
    winnowing,
)
from tidemark.llm.common import documents



def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints link at two bits or fewer."""
    return simhash.near_duplicates(documents(spark, sf_dir))


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token pieces in sequences of at most 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path())


@query
def op3_suffix_radix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without bytes that a 400-byte string elsewhere repeats."""
    return suffixes.remove_repeats(documents(spark, sf_dir)).drop("spans")


@query
def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each text and of its edited text, the tokens they stand at, and their likeness."""
    found = winnowing.fingerprint_documents(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        winnowing.as_text("marks").alias("fingerprint"),
        winnowing.as_text("edited_marks").alias("edited_fingerprint"),
        winnowing.positions("marks").alias("positions"),
        winnowing.positions("edited_marks").alias("edited_positions"),
        "near_edited",
        "near_next",
    )


@query
def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document, learned from labels outside the held-out quarter."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.toxic_documents(documents(spark, sf_dir), labels)


@query
def op6_line_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without lines that stand in an earlier place: within two edits, short ones as they are."""
    found = lines.dedup_lines(documents(spark, sf_dir), threshold=2, exact_chars=1)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op7_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document without passages of 50 words that an earlier document has."""
    return phrases.remove_passages(documents(spark, sf_dir)).drop("kept_text")


@query
def op8_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, also with other numbers, names and units."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.decontaminate(documents(spark, sf_dir), benchmark)


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases, notices and texts in each document."""
    return licenses.scan_licenses(documents(spark, sf_dir))


@query
def op10_warc_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page's capture, from archives written and read back, in index order."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return warc.capture_history(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured"
    )


@query
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of each page, without menus, adverts and the like."""
    return maintext.extract_main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's leaf, proof and root, and whether its text still gives that root."""
    return merkle.verify_documents(documents(spark, sf_dir))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of two to five words in each language."""
    return collocations.collocations(documents(spark, sf_dir))


ORACLES["op10_warc_history"] = r"""
with p as (
    select page_id, url, coalesce(html, '') as html from pages
), d as (
    select page_id, url, octet_length(encode(html)) as payload_bytes, sha1(html) as payload_digest,
        max(page_id) over (partition by html) as newest
    from p
), k as (
    select *, case when payload_bytes >= 1000 and newest is not null and page_id is distinct from newest
            then newest end as refers_to,
        regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) as host,
        regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*([^#]*)', 1) as rest
    from d
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
    case when refers_to is null then 'response' else 'revisit' end as record_type, refers_to,
    array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^www\d*\.', ''), '.')), ',')
        || ')' || case when rest = '' then '/' else lower(rest) end as url_key,
    strftime(make_timestamp((page_id % 1000000000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as captured
from k
"""

ORACLES["op6_line_edit_join"] = r"""
with d as (
    select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents
), l as (
    select doc_id, unnest(range(len(parts))) as n, unnest(parts) as line from d
), f as (
    select line, length(line) as size, min((doc_id, n)) as first from l where line != '' group by line
), long as (
    select line, size from f where size >= 20
), own as (
    select line, size, i, substring(line, size * i // 3 + 1, size * (i + 1) // 3 - size * i // 3) as part
    from long, (values (0), (1), (2)) as t(i)
), probes as (
    -- two edits leave one third of the shorter line as it is; the first such third i stands s places
    -- further in a line that is d longer, with i edits or more ahead of it
    select line, size - d as size, i, s
    from long, (values (0, 0, 0), (1, 0, 0), (2, 0, 0), (0, 1, -1), (0, 1, 0), (0, 1, 1), (1, 1, 0), (1, 1, 1),
        (2, 1, 1), (0, 2, 0), (1, 2, 1), (2, 2, 2)) as t(d, i, s)
    where size - d >= 20
), keys as (
    select line, size, i, substring(line, size * i // 3 + 1 + s, size * (i + 1) // 3 - size * i // 3) as part from probes
), pairs as (
    select distinct own.line as a, keys.line as b
    from own join keys on keys.size = own.size and keys.i = own.i and keys.part = own.part and own.line != keys.line
), near as (
    select a, b from pairs where levenshtein(a, b) <= 2
), around as (
    select a, b from near union select b, a from near
), earliest as (
    select f.line, least(f.first, min(g.first)) as first
    from f left join around on around.a = f.line left join f g on g.line = around.b group by f.line, f.first
), kept as (
    select l.doc_id, l.n, l.line, e.first is not null and e.first < (l.doc_id, l.n) as gone
    from l left join earliest e on e.line = l.line
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_removed,
    sha256(coalesce(string_agg(line, chr(10) order by n) filter (not gone), '')) as kept_sha256
from kept group by doc_id
"""
