import random

import regex
from tidemark.llm.decontamination import UNITS, decontaminate, raw_tokens, template_tokens
from pyspark.sql import functions as F

ITEM = "If the train from Berlin leaves at 9 and runs 120 km to see Hamburg then when does Anna meet the train from Berlin"
SECOND = "Every other word of this second question is entirely plain and has no slot at all"
TOKENS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


def check(spark, docs, items, **options):
    frame = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, cover double")
    asked = spark.createDataFrame(items, "item_id long, text string")
    return {r.doc_id: r for r in decontaminate(frame, asked, **options).collect()}


def test_parameters_may_change_consistently(spark):
    other = ITEM.replace("Berlin", "Rome").replace("Anna", "Paul").replace("120", "77.5").replace("9", "10").replace("km", "miles").replace("Hamburg", "Milan")
    broken = ITEM.replace("from Berlin leaves", "from Rome leaves")  # Berlin would be two places
    docs = [
        (0, None), (1, ""), (2, "x " * 9000 + ITEM + " y" * 9000), (3, "So " + other + " okay"), (4, broken),
        (5, "nothing of that kind here at all, just some words that go on"), (6, SECOND.upper().lower()),
        (7, SECOND.replace("question", "exercise")), (8, ITEM + ". " + SECOND),
    ]
    got = check(spark, docs, [(1, ITEM), (2, SECOND), (9, ITEM), (None, None), (3, ""), (4, "...")])
    assert {i for i, r in got.items() if r.contaminated} == {2, 3, 6, 7, 8}
    assert [got[i].item_id for i in (2, 3, 6, 7)] == [1, 1, 2, 2]
    assert got[8].n_items == 2 and got[8].item_id == 1
    assert got[0].cover == got[5].cover == 0.0


def test_every_run_of_eight_is_met(spark):
    words = TOKENS.split()
    docs = []
    for lead in range(9):
        for start in range(9):
            docs.append((100 * lead + start, " ".join(["pad"] * lead + words[start : start + 8] + ["end"])))
    docs.append((5000, " ".join(words[:7] + ["x"] + words[8:15])))
    got = check(spark, docs, [(1, TOKENS)])
    assert {i for i, r in got.items() if not r.contaminated} == {5000}
    assert {r.cover for i, r in got.items() if i < 5000} == {0.5}


def test_short_items(spark):
    docs = [(i, " ".join(["pad"] * i + ["alpha", "beta", "gamma"])) for i in range(6)] + [(9, "alpha beta"), (10, "beta gamma alpha")]
    got = check(spark, docs, [(1, "Alpha beta gamma")])
    assert {i for i, r in got.items() if r.contaminated} == set(range(6))


def test_edited_passage_is_covered_from_several_shifts(spark):
    words = SECOND.lower().split() + TOKENS.split()
    text = " ".join(words[:10] + ["inserted"] + words[10:20] + ["twice", "again"] + words[20:])
    got = check(spark, [(1, text)], [(7, " ".join(words))])
    assert got[1].contaminated and got[1].cover > 0.9


def test_tokens_stay_aligned(spark):
    texts = ["5kg of Zinc, and 3 km. Then İstanbul", "#p  x", "1,000.5 m m", "ÉCOLE Äb c", "a B2c 3D x5"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in frame.select(raw_tokens(F.col("text")).alias("a"), template_tokens(F.col("text")).alias("b")).collect():
        assert len(r.a) == len(r.b)


def test_empty_tables_and_the_shuffled_join(spark):
    docs = spark.createDataFrame([(1, ITEM), (1, ITEM), (None, ITEM)], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, none).where("contaminated").count() == 0
    assert decontaminate(docs.limit(0), none).count() == 0
    assert decontaminate(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string")).where("contaminated").count() == 3


def test_a_periodic_item_is_read_at_its_own_place(spark):
    item = " ".join(f"ask{i}" for i in range(20))
    got = check(spark, [(1, "intro " + item + " outro"), (2, "intro ask1 outro")], [(7, item)])
    assert got[1].contaminated and got[1].cover == 1.0 and not got[2].contaminated


def test_names_at_sentence_starts_and_coinciding_numbers(spark):
    item = "Anna has 12 pears. Anna buys 3 more. Anna eats 5. How many pears are left?"
    ben = item.replace("Anna", "Ben")
    docs = [
        (1, ben), (2, "pad " + ben.replace("12", "4").replace("3", "4")), (3, ITEM.lower()), (4, item.replace("Anna buys", "Carl buys").replace("Anna eats", "Dora eats")),
        (5, ITEM.replace("9", "120")), (6, "WHO HAS PEARS AND WHO BUYS MORE OF THEM IS NOT KNOWN HERE AT ALL"),
    ]
    got = check(spark, docs, [(1, item), (2, ITEM)])
    assert {i: r.item_id for i, r in got.items() if r.contaminated} == {1: 1, 2: 1, 3: 2, 5: 2}


def parse(text):
    """(lower-case word, kind) of each token, read with a pattern of its own."""
    out, last_number = [], False
    for m in regex.finditer(r"[0-9]+(?:[.,][0-9]+)*|\p{L}[\p{L}\p{M}]*", text or ""):
        word, before = m.group(), text[max(0, m.start() - 2) : m.start()]
        if word[0].isdigit():
            kind = "number"
        elif regex.match(r"\p{Lu}", word) and regex.fullmatch(r"[\p{Ll},;] ", before):
            kind = "name"
        elif last_number and word in UNITS:
            kind = "unit"
        else:
            kind = "capital" if word[0].isupper() else "word"
        last_number = kind == "number"
        out.append((word.lower(), kind))
    return out


def long_runs(text, least):
    kept = list("0" * len(text))
    for m in regex.finditer("1+", text):
        if len(m.group()) >= least:
            kept[m.start() : m.end()] = m.group()
    return "".join(kept)


def brute(docs, items, least_cover=0.5):
    """Every item laid over every document at every shift."""
    asked = {}
    for item_id, text in items:
        if text is not None:
            asked[text] = min(asked.get(text, item_id), item_id)
    out = {}
    for doc_id, text in docs:
        doc, held = parse(text), []
        for item_text, item_id in asked.items():
            item = parse(item_text)
            best = 0
            for bridges in (False, True):
                chosen = {}
                for shift in range(1 - len(item), len(doc)):
                    marks = ""
                    for j, (word, kind) in enumerate(item):
                        if not 0 <= shift + j < len(doc):
                            marks += "0"
                            continue
                        other, its = doc[shift + j]
                        alike = word == other or (kind == its and kind in ("name", "number", "unit"))
                        plain = not {kind, its} & {"number", "unit"}
                        marks += "1" if alike else "~" if plain and {kind, its} & {"name", "capital"} else "0"
                    if bridges and len(item) >= 8:
                        marks = regex.sub("(?<![~0])~(?![~0])", "1", marks)
                    kept = long_runs(marks.replace("~", "0"), min(8, len(item)))
                    for j in range(len(item)):
                        if kept[j] == "1":
                            order = (-kept.count("1"), shift)
                            chosen[j] = min(chosen.get(j, (order,)), (order,))
                pairs = set()
                for j, ((_, shift),) in chosen.items():
                    (word, kind), (other, its) = item[j], doc[shift + j]
                    if kind == "name" or (bridges and {kind, its} & {"name", "capital"}):
                        pairs.add((word, other))
                if item and len(chosen) >= least_cover * len(item) and len({a for a, _ in pairs}) == len(pairs):
                    best = max(best, len(chosen) / len(item))
            if best:
                held.append((best, -item_id))
        out[doc_id] = (bool(held), -max(held)[1] if held else None, max(held)[0] if held else 0.0, len(held))
    return out


def test_equals_brute_force(spark):
    dice = random.Random(12)
    words = "how many pears are left when she sells some of them to her friend at noon and then buys more from a shop".split()
    names, more = ["Anna", "Ben", "Carla", "Dov"], ["12", "3.5", "120 km", "7 kg", "40 m"]

    def sentence(n):
        parts = []
        for _ in range(n):
            r = dice.random()
            parts.append(dice.choice(names) if r < 0.15 else dice.choice(more) if r < 0.25 else dice.choice(words))
            parts[-1] += dice.choice(["", "", "", "", ",", ".", ";"]) if r > 0.9 else ""
        return " ".join(parts)

    def altered(text):
        swap = dict(zip(names, dice.sample(names + ["Eve", "Ömer"], len(names))))
        out = []
        for part in text.split(" "):
            part = swap.get(part, part)
            if dice.random() < 0.3 and part[0].isdigit():
                part = dice.choice(["5", "99"])
            if dice.random() < 0.04:
                part = dice.choice(words + names)
            out.append(part)
        text = " ".join(out)
        return dice.choice([text, text, text, text.lower(), text.capitalize()])

    items = [(i, sentence(dice.randrange(8, 30))) for i in range(12)]
    items += [(20 + n, " ".join(dice.sample(words, n))) for n in (1, 2, 3, 5, 7)] + [(40, items[0][1]), (41, ""), (42, None), (43, items[1][1] + " " + items[1][1])]
    docs = [(0, None), (1, ""), (2, "?!"), (3, items[3][1]), (4, " ".join(t for _, t in items if t)), (5, items[2][1].upper())]
    for i in range(6, 120):
        copy = altered(dice.choice(items[:12])[1]).split(" ")
        cut = dice.randrange(len(copy)) if dice.random() < 0.4 else len(copy)
        docs.append((i, " ".join([sentence(dice.randrange(1, 9)), *copy[:cut], sentence(dice.randrange(1, 20))])))
    want = brute(docs, items)
    assert 20 < sum(x[0] for x in want.values()) < 110
    got = check(spark, docs, items)
    assert {i: (r.contaminated, r.item_id, round(r.cover, 9), r.n_items) for i, r in got.items()} == {
        i: (*x[:2], round(x[2], 9), x[3]) for i, x in want.items()
    }


def test_ties_clashing_names_and_a_long_text_in_every_form(spark):
    plain = "where would the old ferry to the island stop when it rains on a market day"
    items = spark.createDataFrame([(7, plain, "a", 1), (3, plain, "b", 2), (9, plain + " again", "c", 3)], "item_id long, text string, key string, item int")
    for form in (plain, plain.upper(), plain.title(), plain.capitalize()):
        text = "pad " * 60000 + form + " end" * 60000
        docs = spark.createDataFrame([(1, text, 2, "x", 3, 0.5)], "doc_id long, text string, item int, code string, at int, cover double")
        (row,) = decontaminate(docs, items).collect()
        assert row.contaminated and (row.item_id, row.cover, row.n_items) == (3, 1.0, 2), form[:30]
