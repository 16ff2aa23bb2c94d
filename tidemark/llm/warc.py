"""WARC archives with revisit records, and a merged index of their captures."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import partitions, small_batches, table
from tidemark.session import new_folder

#: Fixed by the format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "url_key string, captured string, page_id long, url string, record_type string, "
    "payload_digest string, payload_bytes long, refers_to long, archive string, "
    "offset long, length long"
)

#: Compressed bytes that are unpacked at a time: gzip can blow them up a thousandfold.
STEP = 64 << 10


def capture_decisions(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """For each page: bytes, digest, and the page that it revisits, if any.

    Of pages with equal payloads of at least ``least_bytes`` the one with the
    largest ``page_id`` is the response.  Digests are pre-aggregated before the
    shuffle and joined back, so a payload that a third of all pages share is a
    join that adaptive execution may split, never one task's group.  A null
    payload is an empty one.  Pages with equal ids and payloads share a row; a
    page without an id revisits a page with the same payload that has one.
    """
    body = F.coalesce(F.col("html"), F.lit(""))
    pages = pages.select(
        "page_id",
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha1(body).alias("payload_digest"),
    ).distinct()
    large = F.col("payload_bytes") >= least_bytes
    kept = (
        pages.where(large).groupBy("payload_digest").agg(F.max("page_id").alias("kept"), F.count("*").alias("n"))
    ).where("n > 1")
    revisits = large & F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return pages.join(kept, "payload_digest", "left").select(
        "page_id", "payload_bytes", "payload_digest", F.when(revisits, F.col("kept")).alias("refers_to")
    )


def write_archives(pages: DataFrame, path: str, file_bytes: int = 16 << 20, least_bytes: int = 1000) -> DataFrame:
    """Write one WARC record per row of ``pages`` (page_id, url, html) under ``path``.

    The archives are text files with CRLF, compressed with gzip as a whole, written by
    Spark's own committer, so a task that is repeated leaves no second copy.
    ``file_bytes`` bounds the payload of a file for pages of average size; the join deals
    pages by hash, so large ones spread over all files.
    Returns the decisions.
    """
    decisions = table(capture_decisions(pages, least_bytes), "warc-decisions")
    size = decisions.agg(F.avg("payload_bytes")).first()[0] or 0.0
    body = F.coalesce(F.col("html"), F.lit(""))
    rows = (
        pages.select("page_id", "url", body.alias("html"), F.sha1(body).alias("sha"))
        .alias("p")
        .join(
            decisions.alias("d"),
            F.col("p.page_id").eqNullSafe(F.col("d.page_id")) & (F.col("p.sha") == F.col("d.payload_digest")),
        )
        .select("p.page_id", "url", "html", "d.payload_bytes", "d.payload_digest", "d.refers_to")
    )
    rows.select(record_text().alias("value")).write.option("lineSep", "\r\n").option(
        "maxRecordsPerFile", max(1, min(10_000, int(file_bytes / max(size, 1.0))))
    ).option("compression", "gzip").text(path)
    return decisions


def record_text():
    """One record up to the last line break, which the writer adds."""
    again = F.col("refers_to").isNotNull()
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("null"))
    seconds = F.coalesce(F.pmod("page_id", F.lit(10**9)), F.lit(0))
    date = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    payload = F.when(again, F.lit("")).otherwise(F.col("html"))
    uri = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\r\n]+", " ")
    return F.concat_ws(
        "\r\n",
        F.lit(VERSION),
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page, F.lit(">")),
        F.concat(F.lit("WARC-Date: "), date),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("payload_digest")),
        F.concat(F.lit("WARC-Payload-Length: "), F.col("payload_bytes").cast("string")),
        F.when(again, F.concat(F.lit("WARC-Profile: " + PROFILE + "\r\nWARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.octet_length(payload).cast("string")),
        F.lit(""),
        payload,
        F.lit(""),
    )


class Unpacked:
    """The bytes of a gzip archive of one or many members, unpacked as they are asked for."""

    def __init__(self, content: bytes):
        self._packed, self._at = memoryview(content), 0
        self._gzip = zlib.decompressobj(47)
        self.held = bytearray()  # unpacked and not yet taken

    def more(self) -> bool:
        part = self._packed[self._at : self._at + STEP]
        self._at += len(part)
        going_on = len(part) > 0
        while part:
            self.held += self._gzip.decompress(part)
            part = b""
            if self._gzip.eof:
                part, self._gzip = self._gzip.unused_data, zlib.decompressobj(47)
        return going_on

    def has(self, size: int) -> bool:
        while len(self.held) < size and self.more():
            pass
        return len(self.held) >= size

    def find(self, mark: bytes) -> int:
        while (place := self.held.find(mark)) < 0 and self.more():
            pass
        return place


def records(content: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """Headers, payload, offset and length (both unpacked) of each record of one archive.

    One record at a time is held unpacked, whatever the archive's size.
    """
    archive, at = Unpacked(content), 0
    while archive.has(1):
        end = archive.find(b"\r\n\r\n")
        lines = bytes(archive.held[: max(end, 0)]).decode().split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no WARC record at {at}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = end + 4
        stop = start + int(headers["Content-Length"])
        if not archive.has(stop + 4) or archive.held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} is cut off")
        yield headers, bytes(archive.held[start:stop]), at, stop + 4
        del archive.held[: stop + 4]
        at += stop + 4


def url_key(url: str) -> str:
    """Host turned around, then the path; scheme, ``www.``, port and fragment go."""
    found = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)([^#]*)", url.strip(), re.I)
    host, rest = found.groups() if found else ("", url.split("#")[0])
    host = re.sub(r"^www\d*\.", "", host.rpartition("@")[2].split(":")[0].lower())
    return ",".join(reversed(host.split("."))) + ")" + (rest.lower() or "/")


def _index_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = _arrow_index()
    for batch in batches:
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            rows = []
            for headers, payload, offset, length in records(content.as_py()):
                kind = headers["WARC-Type"]
                digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(headers["WARC-Payload-Length"])
                if kind == "response":
                    size, found = len(payload), hashlib.sha1(payload).hexdigest()
                    if found != digest:
                        raise ValueError(f"{path}: the payload at {offset} doesn't have its digest")
                page = headers["WARC-Record-ID"][10:-1]
                refers = headers.get("WARC-Refers-To")
                url = headers["WARC-Target-URI"]
                rows.append((
                    url_key(url), headers["WARC-Date"], None if page == "null" else int(page), url, kind,
                    digest, size, refers and int(refers[10:-1]), path, offset, length,
                ))
            rows.sort(key=_order)  # a run: the captures of one archive, in order
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema)


def _arrow_index() -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in INDEX.split(", "))])


def _order(row: tuple) -> tuple:
    return row[0], row[1], row[2] is not None, row[2] or 0, row[8], row[9]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The captures of all archives under ``path``; each archive is one sorted run.

    Payloads are read back and their digests computed anew; a record that is cut
    off or altered is an error.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    with small_batches(spark):
        return table(files.mapInArrow(_index_of, INDEX), "warc-index")


class LoserTree:
    """Merge of k sorted lists: each inner node keeps the loser of its match."""

    def __init__(self, runs: list[list], key):
        self.runs, self.key, self.size = runs, key, max(1, len(runs))
        self.at = [0] * self.size
        self.heads = [self._head(i) for i in range(self.size)]
        self.losers = [0] * self.size
        winners = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self._before(a, b) else (b, a)
        self.best = winners[1] if self.size > 1 else 0

    def _head(self, i: int):
        run = self.runs[i] if i < len(self.runs) else []
        return self.key(run[self.at[i]]) if self.at[i] < len(run) else None

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or (x is not None and (x, a) <= (y, b))

    def __iter__(self):
        while self.heads[self.best] is not None:
            i = self.best
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.heads[i] = self._head(i)
            node = (i + self.size) // 2
            while node:
                if not self._before(i, self.losers[node]):
                    i, self.losers[node] = self.losers[node], i
                node //= 2
            self.best = i


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come run by run, each run in order; they leave as one sorted run."""
    schema = _arrow_index()
    runs, last = [], None
    for batch in batches:
        for row in zip(*(batch[name].to_pylist() for name in schema.names)):
            if row[8] != last:
                runs.append([])
                last = row[8]
            runs[-1].append(row)
    chunk = []
    for row in LoserTree(runs, _order):
        chunk.append(row)
        if len(chunk) == 4096:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in chunk], schema)
            chunk = []
    if chunk:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, x)) for x in chunk], schema)


def merge_index(runs: DataFrame, range_rows: int = 100_000) -> DataFrame:
    """All captures in order of URL key and time, as one globally ordered index.

    The key space is cut into ranges of about ``range_rows`` captures (that bounds
    a task's memory); in each range the parts of the sorted runs meet and a loser
    tree merges them.  Ranges are cut by key, time *and* page, so the captures of
    a URL with a third of all rows spread over many ranges.  ``place`` rises along the
    whole index.
    """
    rows = runs.count()
    ranges = max(1, -(-rows // range_rows), min(partitions(runs.sparkSession), rows // 1000))
    return (
        runs.repartitionByRange(ranges, "url_key", "captured", "page_id", "archive", "offset")
        .sortWithinPartitions("archive", "url_key", "captured", "page_id", "offset")
        .mapInArrow(_merge, INDEX)
        .withColumn("place", F.monotonically_increasing_id())
    )


def capture_history(pages: DataFrame, least_bytes: int = 1000, path: str | None = None) -> DataFrame:
    """Write ``pages`` to archives, read them back, and return the merged index."""
    spark = pages.sparkSession
    path = path or new_folder(spark, "warc")
    write_archives(pages, path, least_bytes=least_bytes)
    return merge_index(read_archives(spark, path))


def captured_at(page_id: int) -> str:
    """The date that ``record_text`` gives a page."""
    start = datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (start + timedelta(seconds=page_id % 10**9)).strftime("%Y-%m-%dT%H:%M:%SZ")
