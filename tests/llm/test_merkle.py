import hashlib
import random
import zlib

import pytest

from tidemark.llm import merkle
from tidemark.llm.merkle import build, prove, verify_documents


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*fields):
    return sha("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields))


def climb(nodes, at):
    """(last node, siblings of the node ``at`` level by level)."""
    siblings = []
    while len(nodes) > 1:
        run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
        siblings.append((at % 3, run[: at % 3] + run[at % 3 + 1 :]))
        nodes, at = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)], at // 3
    return nodes[0], siblings


def brute(rows):
    """The contract, row by row; ``rows`` are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(*row), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
    tops = [climb([x[2] for x in groups[name]], 0)[0] for name in names]
    root = climb(tops, 0)[0] if tops else None
    out = []
    for g, name in enumerate(names):
        leaves = [x[2] for x in groups[name]]
        for i, (_, _, leaf, row) in enumerate(groups[name]):
            siblings = climb(leaves, i)[1] + climb(tops, g)[1]
            claim = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                claim = leaf_of(*row[:4], row[4].replace("\n", ""))
            for place, others in siblings:
                claim = sha("".join(others[:place]) + claim + "".join(others[place:]))
            out.append((str(row[0]), leaf, tops[g], root, sha("".join(x for _, s in siblings for x in s)), claim, claim == root))
    return sorted(out)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, block long, digest string, named int"


def frame_of(spark, rows):
    return spark.createDataFrame([(*row, 5, "x", 1) for row in rows], SCHEMA)


def some_rows(n, seed):
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        source = dice.choice(["hot", "hot", "hot", "z", "é", "a b", "", None])
        text = dice.choice([None, "", "one\ntwo", "plain", "é\n" * dice.randrange(5), "x" * dice.randrange(2000)])
        rows.append((10 * i + dice.randrange(9), source, dice.choice(["en", None]), dice.choice([None, i]), text))
    return rows


def got_of(frame):
    assert frame.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(tuple([str(r.doc_id), *tuple(r)[1:]]) for r in frame.collect())


@pytest.mark.parametrize("n", [1, 2, 3, 4, 40])
def test_documents_equal_brute_force(spark, n):
    rows = some_rows(n, n)
    assert got_of(verify_documents(frame_of(spark, rows))) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = some_rows(30, 3) + [(None, "hot", "en", 1, "a\nb"), (None, "hot", "en", 1, "a\nb"), (None, None, None, None, None)]
    rows += [(7, "hot", "en", 3, t) for t in ("a", "b", "a", None, "x\ny")] + [(2**60 + 1, "hot", None, None, "big\nid")] * 5
    rows += [(1, "long", "en", 1, "line\n" * 200_000)]
    assert got_of(verify_documents(frame_of(spark, rows))) == brute(rows)


def test_several_layers_of_superblocks(spark):
    """Superblocks of nine: 700 leaves of one group are three layers, and 60 groups are two."""
    dice = random.Random(1)
    rows = [(i, "hot" if i < 700 else f"s{dice.randrange(60)}", "en", i, f"text {i}\n" * (i % 3)) for i in range(1000)]
    tree = build(frame_of(spark, rows), depth=2)
    assert len(tree.layers) == 4 and len(tree.group_layers) == 3
    want = {r[0]: r for r in brute(rows)}
    got = prove(tree, depth=2, with_paths=True).collect()
    assert len(got) == 1000
    for r in got:
        assert (r.digest, r.top, tree.root, r.proof_sha256) == want[str(r.id)][1:5] and r.verified
        assert merkle.folded(r.digest, r.places, r.siblings) == tree.root == r.folded_root
        assert sha("".join(r.siblings)) == r.proof_sha256


def test_many_equal_rows_are_dealt_out(spark):
    rows = [(None, None, "en", 1, "same")] * 3000 + [(1, "b", "en", 1, "other\n")]
    frame = frame_of(spark, rows).repartition(8)
    tree = build(frame)
    assert tree.leaves.groupBy("named", "group").count().count() == 2
    assert sorted(r.place for r in tree.leaves.where("not named").select("place").collect()) == list(range(3000))
    assert got_of(verify_documents(frame)) == brute(rows)


def test_empty_table(spark):
    assert build(frame_of(spark, [])).root is None
    assert got_of(verify_documents(frame_of(spark, []))) == []
