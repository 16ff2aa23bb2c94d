import hashlib
import random
import re

import pytest
import xxhash

from tidemark.llm.winnowing import BASE, K, PRIME, W, as_text, fingerprint_documents, hashes, positions


def rolled(tokens):
    """Hashes of all k-grams, each from the one before; fewer than k tokens are one gram."""
    codes = [xxhash.xxh64_intdigest(t.encode(), 42) for t in tokens]
    codes = [(c - (c >> 63 << 64)) % (PRIME - 1) + 1 for c in codes]
    first = codes[:K] + [0] * (K - len(codes))
    out = [sum(c * BASE ** (K - 1 - j) for j, c in enumerate(first)) % PRIME]
    for gone, come in zip(codes, codes[K:]):
        out.append(((out[-1] - gone * BASE ** (K - 1)) * BASE + come) % PRIME)
    return out


def brute_marks(text):
    tokens = re.findall(r"[^\x20\x09-\x0D]{1,12}", text)
    if not tokens:
        return []
    grams = rolled(tokens)
    kept = []
    for i in range(max(1, len(grams) - W + 1)):
        part = grams[i : i + W]
        best = max(j for j, h in enumerate(part) if h == min(part)) + i
        if best not in kept:
            kept.append(best)
    return [(grams[i], i) for i in kept]


def likeness(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_equals_brute_force(spark, ranges):
    dice = random.Random(ranges)
    words = ["a", "bé", "日本語" * 7, "x" * 40, "the", "of", "z.", "q"]
    texts = [None, "", " \n", "one", "one two"] + [
        dice.choice([" ", "\n", "  "]).join(dice.choice(words) for _ in range(dice.choice([1, 2, 5, 9, 80]))) for _ in range(30)
    ]
    texts += ["a a a a a a a a a a", "tok " * 20000]
    rows = [(3 * i - 5, t, "m") for i, t in enumerate(texts)] + [(1, texts[2], "m"), (4, "again", "m"), (4, "again", "m")]
    got = fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string, marks string"), ranges=ranges)
    got = got.select("*", as_text("marks").alias("fp"), hashes("marks").alias("h"), positions("marks").alias("p")).collect()
    order = sorted((d, t or "") for d, t, _ in rows)
    want = []
    for i, (doc_id, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        marks = brute_marks(text)
        want.append((
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), marks, " ".join(f"{h:X}" for h, _ in marks),
            likeness(marks, brute_marks(edited)), likeness(marks, brute_marks(after)),
        ))
    have = [(r.doc_id, r.n_chars, r.edited_sha256, list(zip(r.h, r.p)), r.fp, r.near_edited, r.near_next) for r in got]
    assert sorted(have) == sorted(want)


def test_small_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fingerprint_documents(empty).count() == 0
    (row,) = fingerprint_documents(spark.createDataFrame([(9, "a b c d")], "doc_id long, text string")).collect()
    assert row.near_next == 1.0
    nulls = fingerprint_documents(spark.createDataFrame([(None, "a"), (1, "b"), (None, "c")], "doc_id long, text string"))
    assert nulls.count() == 3
