import random
import zlib

from tidemark.llm.toxicity import Settings, learn, score_toxicity, segments, toxic_documents, word_scores

INSULTS = ["foo", "bar", "baz"]


def brute(hits, drift):
    """Maximal segments by the definition: split at the best segment, again and again."""
    if not hits:
        return []
    n = hits[-1][0] + 1
    scores = [drift] * n
    for i, s in hits:
        scores[i] = s

    def best(lo, hi):
        found = None
        for a in range(lo, hi):
            total = 0.0
            for b in range(a, hi):
                total += scores[b]
                if total > 1e-12 and (found is None or total > found[0] + 1e-12):
                    found = (total, a, b + 1)
        return found

    def split(lo, hi):
        found = best(lo, hi)
        if not found:
            return []
        return [*split(lo, found[1]), found, *split(found[2], hi)]

    return split(0, n)


def test_segments_equal_the_definition():
    dice = random.Random(1)
    for _ in range(300):
        places = sorted(dice.sample(range(25), dice.randrange(1, 12)))
        hits = [(i, dice.uniform(-2, 2)) for i in places]
        got, want = segments(hits, -0.3), brute(hits, -0.3)
        assert [x[1:] for x in got] == [x[1:] for x in want]
        assert all(abs(a[0] - b[0]) < 1e-9 for a, b in zip(got, want))


def corpus(n):
    dice = random.Random(9)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [dice.choice(vocabulary) for _ in range(dice.choice([10, 60, 300]))]
        toxic = dice.random() < 0.2
        if toxic:
            for _ in range(3):
                words.insert(dice.randrange(len(words)), dice.choice(INSULTS).upper() + ",")
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus(1200)
    extra = [(5000, None, ""), (5001, "", ""), (None, "foo bar baz", ""), (5002, "ok " * 200_000, "")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score string")
    known = spark.createDataFrame([*labels, (5001, None), (7, None)], "doc_id long, toxic int")
    got = toxic_documents(docs, known).collect()
    assert len(got) == len(rows) + 4
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert [r.predicted for r in got if r.doc_id in (5000, 5001, 5002)] == [0, 0, 0]
    found = next(r for r in held if r.predicted and truth[r.doc_id])
    words = dict((i, t) for i, t, _ in rows)[found.doc_id].split(" ")
    assert words[found.first_word].strip(",").lower() in INSULTS


def test_held_out_labels_change_nothing(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    a, b = (learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert a == b


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxic_documents(docs, none).collect()] == [0.0, 0.0]
    assert score_toxicity(docs.limit(0), learn(docs, none)).count() == 0


def test_a_rare_significant_word_is_learned_from_a_large_corpus(spark):
    rows = [(f"plain{i % 7} rude{i % 5}" + (" rarefoul" if i % 500 == 0 else ""), 1) for i in range(4000)]
    rows += [(f"plain{i % 7} nice{i % 5}" + (" kindword" if i % 100 == 0 else ""), 0) for i in range(36000)]
    scores = word_scores(spark.createDataFrame(rows, "text string, is_toxic int"), Settings())
    assert scores[b"rarefoul"] > 0  # in 8 of 4,000 toxic texts ...
    assert scores[b"nice1"] < 0  # ... and only in clean ones
    assert b"plain3" not in scores


def test_a_large_dictionary_is_joined_with_the_same_result(spark):
    rows, labels = corpus(400)
    extra = [(5000, None, ""), (5001, "", ""), (None, "foo bar baz, \u00e9 foo", ""), rows[0], rows[0]]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    a, b = (sorted(map(str, toxic_documents(docs, known, Settings(dictionary=n)).collect())) for n in (200_000, 0))
    assert a == b and len(a) == len(rows) + 5
