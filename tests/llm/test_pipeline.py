import random

import corpus_pipeline as P

from tidemark.llm.common import table
from test_lines import within
from test_simhash import plain_components, plain_fingerprint


def staged_lines(rows):
    """(id, text) after the line stage: exact copies of any line, two edits from 20 characters on."""
    every = [((i is None, i or 0, n), x) for i, t in rows for n, x in enumerate((t or "").split("\n"))]
    first = {}
    for at, x in every:
        first[x] = min(first.get(x, at), at)

    def near(x, y):
        return x == y or (min(len(x), len(y)) >= 20 and abs(len(x) - len(y)) <= 2 and within(x, y, 2))

    earliest = {x: min(first[y] for y in first if near(x, y)) for x in first}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for n, x in enumerate(lines) if not x or earliest[x] >= (i is None, i or 0, n)]
        out.append((str(i), "\n".join(left)))
    return out


def tables(spark, folder):
    dice = random.Random(11)
    vocabulary = [f"word{i}" for i in range(400)]
    item = " ".join(f"ask{i}" for i in range(20))
    docs, labels = [], []
    for i in range(300):
        words = [dice.choice(vocabulary) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            words[5:5] = ["insultone", "insulttwo", "insultthree"]
        docs.append((i, " ".join(words[:30]) + "\n" + " ".join(words[30:])))
        labels.append((i, int(toxic)))
    docs += [(400, docs[1][1]), (401, docs[1][1] + "\nend"), (402, docs[2][1]), (500, "intro " + item + " outro"), (501, None), (502, ""), (None, "alone without id but long enough"), (3, docs[3][1])]
    rows = [(i, t, "en", "s", len(t or ""), 1) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_stages_equal_brute_force(spark, folder):
    docs = tables(spark, folder)
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    columns = frame.columns
    assert [name for name, _ in P.STAGES][0] == "toxicity" and len(P.STAGES) == 5

    clean = table(P.toxicity_stage(spark, frame, folder), "clean")
    assert clean.columns == columns
    got = sorted((str(r.doc_id), r.text or "") for r in clean.collect())
    assert got == sorted((str(i), t or "") for i, t in docs if "insult" not in (t or ""))

    left = [(r.doc_id, r.text) for r in clean.collect()]
    lined = table(P.line_stage(spark, clean, folder), "lined")
    assert lined.columns == columns
    rows = lined.collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == sorted(staged_lines(left))
    assert all(r.n_chars == len(r.text) for r in rows)

    single = table(P.near_duplicate_stage(spark, lined, folder), "single")
    kept = single.collect()
    assert single.columns == columns
    codes = [plain_fingerprint(r.text) for r in rows]
    groups = plain_components(codes, lambda a, b: bin(a ^ b).count("1") <= 2)
    assert len(kept) == len(set(groups))
    assert {plain_fingerprint(r.text) for r in kept} <= set(codes)

    free = table(P.benchmark_stage(spark, single, folder), "free")
    assert {r.doc_id for r in kept} - {r.doc_id for r in free.collect()} == {500}

    packed = P.packing_stage(spark, free, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in free.collect()}
    assert max(r.offset + r.length for r in packed) <= 2048


def test_stages_take_an_empty_table(spark, folder):
    tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0


def test_line_stage_compares_short_lines_and_two_edits(spark, folder):
    long = "a line of more than twenty characters"
    frame = spark.createDataFrame([(1, f"Les.\n{long}"), (2, f"Les.\nLet.\n{long}!?")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in P.line_stage(spark, frame, folder).collect()}
    assert got == {1: f"Les.\n{long}", 2: "Let."}


def test_near_duplicate_stage_decides_by_row(spark):
    dice = random.Random(3)
    def prose(n):
        return " ".join(f"w{dice.randrange(500)}" for _ in range(n))
    a, b, c = prose(400), prose(50), prose(60)
    near = a.rsplit(" ", 1)[0] + " other"  # one shingle of about 400: at most two bits, or the test's texts are chosen anew
    assert 0 < bin(plain_fingerprint(a) ^ plain_fingerprint(near)).count("1") <= 2
    rows = [(5, a), (3, near), (3, b), (None, a), (None, b), (9, c), (9, c), (9, c), (None, None), (2, ""), (None, c)]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, key int, component_id string")
    kept = P.near_duplicate_stage(spark, frame, "")
    assert kept.columns == frame.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(3, near), (3, b), (9, c), (2, "")])
