import hashlib
import random

import pytest

import tidemark.llm.repeats as repeats
from tidemark.llm.suffixes import remove_repeats


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = {}
    for n, data in enumerate(texts):
        for i in range(len(data) - length + 1):
            seen.setdefault(data[i : i + length], []).append((n, i))
    out = []
    for (doc_id, _), data in zip(rows, texts):
        gone = [False] * len(data)
        for i in range(len(data) - length + 1):
            if len(seen[data[i : i + length]]) > 1:
                gone[i : i + length] = [True] * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((str(doc_id), len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def texts(seed):
    dice = random.Random(seed)
    make = lambda n: "".join(dice.choice("abcdé \n") for _ in range(n))
    shared = [make(dice.randrange(20, 160)) for _ in range(12)]
    made = [None, "", "a" * 39, "a" * 40, "a" * 41, "ab" * 60, "b" * 300, make(400) * 2]
    for _ in range(50):
        made.append("".join(dice.choice([make(dice.randrange(1, 60)), dice.choice(shared)]) for _ in range(dice.randrange(1, 6))))
    for _ in range(15):
        base = dice.choice(made[8:58])
        i = dice.randrange(len(base) + 1)
        made.append(base[:i] + dice.choice(["", "x", "yz"]) + base[i + dice.randrange(2) :])
    return made + [made[10], made[11], made[11]]


@pytest.mark.parametrize("length, gram", [(40, 8), (24, 24)])
def test_equals_brute_force(spark, length, gram):
    rows = [(5 * i, t) for i, t in enumerate(texts(length))] + [(None, "z" * 80), (5, None), (45, texts(length)[9])]
    frame = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, doc int, key string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(frame, length, gram).collect())
    assert got == brute(rows, length)


def test_long_texts_in_pieces(spark, monkeypatch):
    assert repeats.CHUNK == 1 << 20
    dice = random.Random(1)
    long = "".join(dice.choice("abcdefgh") for _ in range(1_300_000))
    rows = [(1, long), (2, "x" + long[520_000:530_000] + "y"), (3, long[:500])]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (10_500, 2), 2: (10_000, 1), 3: (500, 1)}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_are_counted_not_multiplied(spark, monkeypatch):
    sizes = {}
    kept = repeats.table

    def counted(df, label):
        out = kept(df, label)
        sizes.setdefault(label, []).append(out.count())
        return out

    monkeypatch.setattr(repeats, "table", counted)
    dice = random.Random(2)
    text = "".join(dice.choice("abcdefgh ") for _ in range(900))
    other = text[:500] + "x" + text[500:]
    seen = []
    for n in (3, 1000):
        sizes.clear()
        rows = [(None, text)] * n + [(1, other), (2, text[100:]), (3, "c" * 100)]
        got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        few = [(None, text)] * 3 + rows[n:]
        assert {(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == set(brute(few, 400))
        assert len(got) == n + 3
        seen.append((sum(sizes["items"]), sum(sizes["judged"])))
    assert seen[0] == seen[1]
