import gzip
import hashlib
import random

import pytest

from tidemark.llm.warc import STEP, VERSION, LoserTree, Unpacked, capture_history, captured_at, records, url_key, write_archives

LONG = "<html>é" + "x" * 1200


def brute(rows):
    out = []
    for page, _, html, *_ in rows:
        payload = (html or "").encode()
        same = [p for p, _, h, *_ in rows if (h or "") == (html or "") and p is not None]
        newest = max(same, default=None)
        again = len(payload) >= 1000 and newest is not None and page != newest
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", newest if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = [
        (1, "https://www.A.example.com:80/x?b#c", LONG, "t"),
        (2, "http://b.example.org", LONG, "t"),
        (9, "http://b.example.org/", LONG, None),
        (9, "http://b.example.org/", LONG, None),
        (3, None, None, None),
        (4, "", "", ""),
        (5, "x\r\ny", "\r\n\r\nWARC/1.1\r\n" + "z" * 2000, ""),
        (None, "http://n.example.org/", LONG, ""),
        (6, "http://big.example.org/", "w" * 3_000_000, ""),
        (7, "http://small.example.org/", "s", ""),
        (8, "http://small.example.org/", "s", ""),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string")
    got = capture_history(pages).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == brute(rows)
    ordered = sorted(got, key=lambda r: r.place)
    keys = [(r.url_key, r.captured, r.page_id is not None, r.page_id or 0) for r in ordered]
    assert keys == sorted(keys)
    assert captured_at(9) in {r.captured for r in got if r.page_id == 9}


def test_empty_table(spark):
    assert capture_history(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_archives_are_valid_records(spark, folder):
    pages = spark.createDataFrame([(i, f"http://h{i}.example.org/", f"p{i}") for i in range(20)], "page_id long, url string, html string")
    write_archives(pages.coalesce(1), f"{folder}/a", file_bytes=20)
    files = spark.read.format("binaryFile").load(f"{folder}/a").collect()
    assert len(files) == 2 * 20 / 20 or len(files) > 1
    found = [payload for f in files for _, payload, _, _ in records(bytes(f.content))]
    assert sorted(found) == sorted(f"p{i}".encode() for i in range(20))


def record(payload):
    return f"{VERSION}\r\nContent-Length: {len(payload)}\r\nX:\r\n\r\n".encode() + payload + b"\r\n\r\n"


def test_records_are_unpacked_one_at_a_time():
    dice = random.Random(1)
    payloads = [b"", dice.randbytes(5 * STEP), b"\r\n\r\n" + VERSION.encode(), dice.randbytes(3 * STEP)] * 3
    parts = [record(p) for p in payloads]
    for packed in (gzip.compress(b"".join(parts)), b"".join(map(gzip.compress, parts))):
        found = list(records(packed))
        assert [payload for _, payload, _, _ in found] == payloads
        assert [length for *_, length in found] == [len(p) for p in parts]
        assert [offset for _, _, offset, _ in found] == [sum(map(len, parts[:i])) for i in range(len(parts))]
        archive = Unpacked(packed)
        assert archive.has(1) and len(archive.held) < 8 * STEP
        for cut in (len(packed) // 2, len(packed) - 20):
            with pytest.raises(ValueError):
                list(records(packed[:cut]))
    assert list(records(b"")) == [] and list(records(gzip.compress(b""))) == []
    with pytest.raises(ValueError, match="no WARC record"):
        list(records(gzip.compress(b"anything else")))


@pytest.mark.parametrize("k", [0, 1, 2, 3, 7, 8])
def test_loser_tree_merges(k):
    dice = random.Random(k)
    runs = [sorted(dice.randrange(30) for _ in range(dice.randrange(20))) for _ in range(k)]
    assert list(LoserTree(runs, lambda x: x)) == sorted(x for run in runs for x in run)


def test_url_key():
    assert url_key("https://www.A.example.com:80/X?b#c") == "com,example,a)/x?b"
    assert url_key("http://b.example.org") == "org,example,b)/"
    assert url_key("") == ")/"
