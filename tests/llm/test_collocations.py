import random
import re
from collections import Counter

import numpy as np
import pytest

import tidemark.llm.collocations as C
from tidemark.llm.collocations import collocations


def brute(rows, longest, least, top, share=100):
    total, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\n-\r]", folded):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        chosen = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in chosen.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p) and 100 * a >= share * chosen[p[i:j]]:
                        gone.add(p[i:j])
        found = []
        for p, a in chosen.items():
            if p not in gone:
                cuts = [(1000 * a * total[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def got_of(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for _, t in frame.dtypes} == {"string", "bigint"}
    return sorted(tuple(r) for r in frame.collect())


def some_rows(seed):
    dice = random.Random(seed)
    words = ["the", "The", "cat", "sat", "on", "mat", "É", "éa", "x\x00y", "a", "b"]
    fixed = ["new york city hall", "the cat sat on the mat", "a b a b a b", "in spite of", "\tas well\tas"]
    rows = [(None, None), ("en", None), (None, ""), ("en", " . , "), ("", "a b"), ("und", "in spite of")]
    for _ in range(60):
        parts = [dice.choice(fixed) if dice.random() < 0.4 else dice.choice(words) for _ in range(dice.randrange(1, 30))]
        text = "".join(p + dice.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\r\n", "\x0b"]) for p in parts)
        rows.append((dice.choice(["en", "en", "en", "de", None]), text))
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(i, *r, "p", 1, 2) for i, r in enumerate(rows)], "doc_id long, lang string, text string, phrase string, n int, code int")


@pytest.mark.parametrize("longest, least, top, share, bits", [(5, 3, 2000, 100, 24), (5, 2, 7, 100, 15), (3, 4, 2000, 60, 24), (2, 2, None, 100, 24)])
def test_equals_brute_force(spark, longest, least, top, share, bits):
    rows = some_rows(longest + least)
    got = got_of(collocations(frame_of(spark, rows), longest, least, top, share, bits))
    assert got == brute(rows, longest, least, top, share) and len(got) > 5


def test_small_chunks_hot_prefixes_and_a_full_filter(spark, monkeypatch):
    """Every batch is counted by itself, all prefixes are cut into slices, every bit of the filter is set."""
    monkeypatch.setattr(C, "HOT_SHARE", 10**6)
    monkeypatch.setattr(C, "filter_of", lambda phrases, bits: b"\xff" * 4096)
    monkeypatch.setattr(C, "likely_phrases", lambda texts, size, shorter, least, bits: b"\xff" * 4096)
    rows = some_rows(1)
    assert got_of(collocations(frame_of(spark, rows).repartition(5), least=3, chunk=1)) == brute(rows, 5, 3, 2000)


def test_production_parameters_long_and_repeated_texts(spark):
    long = "one two three, " * 60_000 + "x" * 100_000
    rows = [("en", long)] + [("en", "to be or not to be")] * 150 + [("fr", "a b c")] * 99 + [("fr", "a b d")]
    assert got_of(collocations(frame_of(spark, rows))) == brute(rows, 5, 100, 2000)


def test_empty_table(spark):
    assert got_of(collocations(frame_of(spark, []))) == []


def test_runs_only():
    a = np.array([0, 5, 0, 0, 6, 7, 0, 8, 0, 9, 9, 9, 0, 0], dtype=np.uint64)
    assert C.runs_only(a).tolist() == [6, 7, 0, 9, 9, 9, 0]
    assert C.runs_only(np.zeros(2, dtype=np.uint64)).tolist() == []


def test_filter_has_what_was_added(spark):
    dice = np.random.default_rng(0)
    rows = dice.integers(-(2**63), 2**63, (500, 3))
    frame = spark.createDataFrame([(r.tolist(),) for r in rows], "phrase array<long>")
    known = C.Filter(C.filter_of(frame, 18))
    columns = [np.ascontiguousarray(rows[:, i]) for i in range(3)]
    assert known.has(C.phrase_hash(columns)).all()
    assert known.has(C.phrase_hash([c + 1 for c in columns])).mean() < 0.02


def test_likely_phrases_miss_none(spark):
    dice = np.random.default_rng(1)
    codes = np.r_[0, dice.integers(1, 40, 5000), 0]
    frame = spark.createDataFrame([(lang, part.tolist()) for lang in ("a", "b") for part in np.split(codes, [2000, 2500])], "lang string, codes array<long>")
    counted = Counter()
    for part in np.split(codes, [2000, 2500]):
        counted.update(zip(part[:-1].tolist(), part[1:].tolist()))
    likely = C.Filter(C.likely_phrases(frame.repartition(3), 2, None, 10, 16))
    pairs = np.array([p for p, n in counted.items() if 0 not in p], dtype=np.int64)
    often = np.array([2 * n >= 10 for p, n in counted.items() if 0 not in p])
    has = likely.has(C.phrase_hash([np.ascontiguousarray(pairs[:, i]) for i in (0, 1)]))
    assert has[often].all() and 10 < often.sum() < len(often) and has[~often].mean() < 0.1


def test_stripes_merge_elementwise(spark):
    dice = random.Random(9)
    counted, rows = Counter(), []
    for _ in range(400):
        lang, prefix = dice.choice("ab"), [dice.randrange(4), dice.randrange(-3, 3)]
        entries = {dice.randrange(20): dice.randrange(1, 5) for _ in range(dice.randrange(1, 9))}
        rows.append((lang, prefix, 0, sorted(entries), [entries[x] for x in sorted(entries)]))
        for x, n in entries.items():
            counted[lang, *prefix, x] += n
    frame = spark.createDataFrame(rows, C.STRIPES).repartition(5)
    got = {(r.lang, *r.prefix, r.next): r.n for r in C.merged(frame, 10).collect()}
    assert got == {k: n for k, n in counted.items() if n >= 10} and len(got) > 20
    assert C.merged(frame.limit(0), 10).count() == 0
