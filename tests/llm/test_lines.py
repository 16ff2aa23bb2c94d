import random

import pytest

from tidemark.llm.lines import dedup_lines, near_lines


def edits(a, b):
    if a == b:
        return 0
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def within(a, b, n):
    """Whether n edits turn a into b: after the common start, each kind of edit is tried."""
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    if not a or not b or not n:
        return len(a) + len(b) <= n
    return within(a[1:], b[1:], n - 1) or within(a[1:], b, n - 1) or within(a, b[1:], n - 1)


def changed(dice, line, n):
    for _ in range(n):
        i = dice.randrange(len(line) + 1)
        kind = dice.randrange(3)
        line = line[:i] + (dice.choice("abcé ") if kind else "") + line[i + (kind != 1) :]
    return line


def some_lines(seed, size=12, n=40):
    dice = random.Random(seed)
    lines = ["".join(dice.choice("abé ") for _ in range(dice.randrange(size, 3 * size))) for _ in range(n)]
    lines += [changed(dice, dice.choice(lines[:n]), dice.randrange(1, 5)) for _ in range(3 * n)]
    return [x for x in lines if len(x) >= size]


@pytest.mark.parametrize("threshold", [0, 1, 2, 3])
def test_all_near_pairs_are_found(spark, threshold):
    lines = some_lines(threshold)
    got = {tuple(r) for r in near_lines(spark.createDataFrame([(x,) for x in lines], "line string"), threshold).collect()}
    every = set(lines)
    assert got == {(a, b) for a in every for b in every if a != b and edits(a, b) <= threshold}


def test_within_agrees_with_the_distance():
    dice = random.Random(0)
    for _ in range(500):
        a, b = ("".join(dice.choice("ab") for _ in range(dice.randrange(7))) for _ in range(2))
        assert all(within(a, b, n) == (edits(a, b) <= n) for n in range(4))


def brute(rows, threshold, least):
    at = []
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if len(line) >= least:
                at.append(((doc_id is None, doc_id or 0, n), line))
    out = []
    for doc_id, text in rows:
        kept, lines = [], (text or "").split("\n")
        for n, line in enumerate(lines):
            here = (doc_id is None, doc_id or 0, n)
            if len(line) < least or not any(p < here and within(x, line, threshold) for p, x in at):
                kept.append(line)
        out.append((str(doc_id), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


@pytest.mark.parametrize("threshold", [1, 2])
def test_documents_equal_brute_force(spark, threshold):
    dice = random.Random(5)
    lines = some_lines(8, n=25) + ["", "short", "}", "same long line here"] * 8
    rows = [(7 * i, "\n".join(dice.choice(lines) for _ in range(dice.randrange(1, 7)))) for i in range(25)]
    rows += [(3, None), (4, ""), (None, lines[0]), (None, lines[0]), (7, rows[1][1]), (7, rows[1][1]), (9, "x" * 40000 + "\n" + "x" * 40000)]
    frame = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, key int, line string")
    out = dedup_lines(frame, threshold, 12)
    assert out.columns == ["doc_id", "text", "key", "line", "kept_text", "n_lines", "n_removed"]
    got = sorted((str(r.doc_id), r.kept_text, r.n_lines, r.n_removed) for r in out.collect())
    assert got == brute(rows, threshold, 12)


def test_empty_table(spark):
    assert dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_lines_go_if_they_are_equal(spark):
    long = "a line of more than twenty characters"
    rows = [(1, f"Les.\n\n}}\n{long}"), (2, f"Les.\n\n}}\nLet.\n{long}s"), (3, f"\nLes.\nLet.\n{long}!?"), (4, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in dedup_lines(frame, 2, exact_chars=1).collect()}
    assert got == {1: rows[0][1], 2: "\nLet.", 3: "", 4: ""}
