import hashlib
import random
import re

import pytest

from tidemark.llm.phrases import phrases_of, remove_passages


def brute(rows, length):
    def order(doc_id):
        return (doc_id is None, doc_id or 0)

    every = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (doc_id, _), words in zip(rows, every):
        for i in range(len(words) - length + 1):
            phrase = tuple(words[i : i + length])
            first[phrase] = min(first.get(phrase, order(doc_id)), order(doc_id))
    out = []
    for (doc_id, _), words in zip(rows, every):
        gone = set()
        for i in range(len(words) - length + 1):
            if first[tuple(words[i : i + length])] < order(doc_id):
                gone.update(range(i, i + length))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((str(doc_id), len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


@pytest.mark.parametrize("length, gram, block", [(10, 3, 500_000), (6, 6, 50)])
def test_equals_brute_force(spark, length, gram, block):
    dice = random.Random(length)
    make = lambda n: [dice.choice(["a", "b", "É", "c,", "d"]) for _ in range(n)]
    shared = [make(dice.randrange(length - 2, 5 * length)) for _ in range(10)]
    texts = [None, "", " \n", " ".join(["a"] * (3 * length))]
    for _ in range(50):
        words = [x for _ in range(dice.randrange(1, 5)) for x in dice.choice([make(dice.randrange(1, 15)), dice.choice(shared)])]
        texts.append(dice.choice([" ", "\n", "\t  "]).join(words))
    for _ in range(12):
        words = dice.choice(texts[4:54]).split()
        words[dice.randrange(len(words))] = "edited"
        texts.append(" ".join(words))
    texts += [texts[8], texts[9], " ".join(["a"] * (2 * length))]
    rows = [(3 * i - 9, t) for i, t in enumerate(texts)]
    dice.shuffle(rows)
    rows += [(None, texts[8]), (None, texts[9]), (9, texts[20]), (9, texts[20])]
    frame = spark.createDataFrame([(i, t, 0, "c") for i, t in rows], "doc_id long, text string, doc int, covered string")
    got = remove_passages(frame, length, gram, block).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in got) == brute(rows, length)


def test_long_texts_and_an_empty_table(spark):
    words = [str(i) for i in range(30_000)]
    rows = [(2, " ".join(words)), (1, " ".join(words[7_000:9_000])), (3, " ".join(words[:49]))]
    got = {r.doc_id: r.n_removed for r in remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 2000, 3: 0}
    assert remove_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_phrases_cover_a_stretch():
    assert phrases_of([(3, 3, 1)], 5) == [(3, 1)]
    assert phrases_of([(3, 9, 1), (10, 14, 1), (15, 15, 0)], 5) == [(3, 1), (8, 1), (13, 1), (14, 1), (15, 0)]


def test_many_equal_rows(spark):
    dice = random.Random(4)
    words = [dice.choice(["a", "b", "c", "d"]) for _ in range(90)]
    rows = [(5, " ".join(words))] * 400 + [(None, " ".join(words[:70]))] * 300 + [(7, " ".join(words[10:]))]
    got = {(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(brute(rows[398:402] + rows[-1:], 50))
