import random
import re

import pytest
import xxhash

from tidemark.llm.graph import components
from tidemark.llm.simhash import fingerprint, links, near_duplicates, signed


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    codes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def plain_components(values, linked):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def texts():
    dice = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "İx", " y"]
    made = [None, "", " \n", "One", "one", "One two", "a b c", "A  B\tC", "a\x0bb c d"]
    for _ in range(40):
        made.append(" ".join(dice.choice(vocabulary) for _ in range(dice.choice([3, 8, 60]))))
    for _ in range(60):
        words = dice.choice(made[9:49]).split(" ")
        words[dice.randrange(len(words))] = dice.choice(vocabulary)
        made.append(" ".join(words))
    return made + ["x y z " * 30000, made[20], made[20]]


def test_fingerprints_equal_the_plain_ones():
    for text in texts():
        assert fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("dense", [512, 2, 0])
def test_components_equal_all_pairs(spark, dense):
    every = texts()
    rows = [(3 * i + 5, t, "z") for i, t in enumerate(every)] + [(5, None, "z"), (None, every[20], "z")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string"), dense=dense).collect()
    codes = [plain_fingerprint(t) for _, t, _ in rows]
    roots = plain_components(codes, lambda a, b: bin(a ^ b).count("1") <= 2)
    least = {}
    for (doc_id, _, _), root in zip(rows, roots):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    want = sorted((str(d), f"{c:016x}", least.get(r)) for (d, _, _), c, r in zip(rows, codes, roots))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want


def test_links_find_all_near_pairs(spark):
    dice = random.Random(4)
    codes = {dice.getrandbits(64) for _ in range(50)}
    for code in list(codes):
        for flips in (1, 2, 2, 3, 4):
            x = code
            for b in dice.sample(range(64), flips):
                x ^= 1 << b
            codes.add(x)
    frame = spark.createDataFrame([(signed(c),) for c in codes], "fp long")
    got = {tuple(r) for r in links(frame).collect()}
    order = sorted(signed(c) for c in codes)
    want = {(a, b) for i, a in enumerate(order) for b in order[i + 1 :] if bin((a ^ b) % 2**64).count("1") <= 2}
    assert got == want


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100), (200, 201), (201, 200), (7, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 300: 0, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
