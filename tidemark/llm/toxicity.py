"""Toxic passages as maximum-scoring segments of token log-odds.

Learning: words' document counts among toxic and clean labelled texts give log-odds
under an informative Dirichlet prior; words whose log-odds aren't significant
get a small negative score, so that the score of clean text drifts downwards.
Scoring: a linear-time scan finds all maximal segments of a text; the best one is judged
by its extreme-value distribution (the maximum over n words of a negative-drift
walk), fitted on clean texts; a logistic curve turns that into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, small_batches, table
from tidemark.llm.licenses import words_of

HELD_OUT = 2  # the remainder of crc32(doc_id) mod 4 that is never learned from
CALIBRATION = 3  # learned from last: calibrates a model of the other remainders


class Settings(NamedTuple):
    prior: float = 0.1  # strength of the Dirichlet prior, as a share of all counts
    least_z: float = 3.3  # log-odds below this many standard errors count as none
    least_texts: int = 3  # of one kind that must have a word
    drift: float = -0.05  # score of a word without significant log-odds
    significant: float = 0.01  # largest chance in clean text of a reported passage
    dictionary: int = 200_000  # words that go to the tasks at most; more are joined from a table
    sample: int = 200_000  # labelled texts that the logistic curve is fitted on, at most
    threshold: float = 0.3


class Model(NamedTuple):
    scores: dict[bytes, float] | DataFrame  # a stored table (word, delta) beyond ``dictionary`` words
    drift: float
    rate: float = 1.0  # the extreme-value distribution's lambda ...
    log_k: float = 0.0  # ... and ln K
    curve: tuple[float, ...] = ()


def fold(doc_id: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def labelled(docs: DataFrame, labels: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(text, is_toxic, fold) of the rows that may be learned from, stored.

    A document with several labels counts as toxic if one says so.  Of equal texts with
    the same label and fold one is taken.  Texts don't travel to be joined while
    there are at most ``broadcast_rows`` labels of 24 bytes; beyond that they do.
    """
    known = labels.where("toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("is_toxic"))
    known = known.withColumn("fold", fold()).where(F.col("fold") != HELD_OUT)

    def sized(rows: DataFrame) -> DataFrame:
        return F.broadcast(rows) if rows.count() <= broadcast_rows else rows

    known = table(known, "labels")
    coded = docs.select("doc_id", F.xxhash64("text").alias("a"), F.sha1("text").alias("b")).join(sized(known), "doc_id")
    one = coded.groupBy("is_toxic", "fold", "a", "b").agg(F.min("doc_id").alias("doc_id"))
    one = table(one.select("doc_id", "is_toxic", "fold").distinct(), "labels")
    return table(docs.select("doc_id", "text").join(sized(one), "doc_id").drop("doc_id"), "labelled")


_NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_scores(rows: DataFrame, s: Settings) -> dict[bytes, float] | DataFrame:
    """Significant log-odds of words, from all of ``rows`` (text, is_toxic).

    The prior of a word is its share of all counts.  A word must stand in ``least_texts``
    toxic or as many clean texts, however large the corpus is.  Up to ``dictionary``
    words are a dictionary; more stay a table.
    """
    n = {r[0]: r[1] for r in rows.groupBy("is_toxic").count().collect()}
    if not n.get(0) or not n.get(1):
        return {}
    words = F.split(lower_ascii(F.coalesce("text", F.lit(""))), _NOT_WORDS)
    counts = (
        rows.select("is_toxic", F.explode(F.array_distinct(words)).alias("word"))
        .where("word != ''")
        .groupBy("word")
        .agg(F.sum("is_toxic").alias("toxic"), F.sum(1 - F.col("is_toxic")).alias("clean"))
    )
    total = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    all_toxic, all_clean = float(total[0] or 0), float(total[1] or 0)
    prior = s.prior * (F.col("toxic") + F.col("clean"))
    strength = s.prior * (all_toxic + all_clean)

    def log_odds(y: Column, everything: float) -> Column:
        return F.log((y + prior) / (F.lit(everything + strength) - y - prior))

    kept = (
        counts.where(F.greatest("toxic", "clean") >= s.least_texts)
        .withColumn("delta", log_odds(F.col("toxic"), all_toxic) - log_odds(F.col("clean"), all_clean))
        .withColumn("z", F.col("delta") / F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior)))
        .where(F.abs("z") >= s.least_z)
    )
    kept = table(kept.select("word", "delta"), "word-scores")
    if kept.count() > s.dictionary:
        return kept
    return {r["word"].encode(): r["delta"] for r in kept.collect()}


def segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, start, end), in linear time.

    ``hits`` are the words that have a score, by position; those between them score ``drift``
    each.  Segments start and end at words with positive scores, so a stretch
    between two of those is one step.  Each candidate remembers the running total
    before it (low), that at its end (high), and the nearest earlier candidate that starts
    lower; a new one is merged leftwards as long as such a candidate ends lower.
    """
    found: list[tuple[float, float, int, int, int]] = []
    total, at = 0.0, 0
    for place, score in hits:
        total += drift * (place - at)
        at = place + 1
        low, total = total, total + score
        if score <= 0:
            continue
        start, before = place, len(found) - 1
        while True:
            while before >= 0 and found[before][0] >= low:
                before = found[before][4]
            if before < 0 or found[before][1] >= total:
                break
            low, start = found[before][0], found[before][2]
            del found[before:]
            before = len(found) - 1
        found.append((low, total, start, at, before))
    return [(high - low, start, end) for low, high, start, end, _ in found]


def hits_of(words: list[bytes], scores: dict[bytes, float]) -> list[tuple[int, float]]:
    return [(i, scores[w]) for i, w in enumerate(words) if w in scores]


def features(n: int, hits: list[tuple[int, float]], model: Model, s: Settings) -> tuple:
    """(words, best score, significance, passages, share, start, end) of a text of ``n`` words."""
    found = segments(hits, model.drift) if hits else []
    best, start, end = max(found, key=lambda x: (x[0], -x[1]), default=(0.0, None, None))
    offset = model.log_k + math.log(max(n, 1))
    level = -math.log(-math.log1p(-s.significant))  # of the extreme-value distribution
    passages = [x for x in found if model.rate * x[0] - offset >= level]
    share = sum(b - a for _, a, b in passages) / n if n else 0.0
    return n, best, model.rate * best - offset, len(passages), share, start, end


FEATURES = "n_words long, best double, significance double, passages long, share double, first_word long, last_word long"


def _joined_hits(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """``rows`` with ``__hits``: places and scores of the words that have one, joined by a shuffle.

    Only words and places travel; Spark may split a word that is in many texts.
    """
    code = F.struct(F.xxhash64("text").alias("a"), F.sha1("text").alias("b"))
    words = F.filter(F.split(lower_ascii(F.coalesce("text", F.lit(""))), _NOT_WORDS), lambda w: w != "")
    placed = rows.where("text is not null").select(code.alias("code"), F.posexplode(words).alias("place", "word"))
    # a set: equal texts have equal hits
    hits = placed.join(scores, "word").groupBy("code").agg(F.sort_array(F.collect_set(F.struct("place", "delta"))).alias("__hits"))
    hits = table(hits, "hits")
    return rows.withColumn("__code", code).join(hits.withColumnRenamed("code", "__code"), "__code", "left").drop("__code")


def _with_features(rows: DataFrame, kept: list[str], model: Model, s: Settings) -> DataFrame:
    names = [x.split()[0] for x in FEATURES.split(", ")]
    kinds = [pa.float64() if "double" in x else pa.int64() for x in FEATURES.split(", ")]
    schema = ", ".join([*(f"{k} {dict(rows.dtypes)[k]}" for k in kept), FEATURES])
    joined = not isinstance(model.scores, dict)
    if joined:
        rows = _joined_hits(rows.select(*kept, "text"), model.scores)
        model = model._replace(scores={})  # a table can't travel to the tasks

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, text in enumerate(batch["text"]):
                words = words_of(text.as_py())
                if joined:
                    hits = [(x["place"], x["delta"]) for x in batch["__hits"][i].as_py() or []]
                else:
                    hits = hits_of(words, model.scores)
                found.append(features(len(words), hits, model, s))
            columns = list(zip(*found)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [*(batch[k] for k in kept), *(pa.array(c, k) for c, k in zip(columns, kinds))], names=[*kept, *names]
            )

    return rows.select(*kept, "text", *(["__hits"] if joined else [])).mapInArrow(scan, schema)


def _inputs(significance, passages, share, best) -> np.ndarray:
    x = np.stack([np.ones(len(best)), np.clip(significance, -20, 60), np.log1p(passages), share, np.log1p(best)], 1)
    return x.astype(np.float64)


def _fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression by Newton steps, with a ridge on all but the constant."""
    weight = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        slope = x.T @ (p - y) + penalty * weight
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weight -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(w) for w in weight)


def _with_extremes(model: Model, rows: DataFrame, s: Settings) -> Model:
    """The model with its extreme-value distribution, from the moments over all clean rows."""
    kept = _with_features(rows.where("is_toxic = 0 and fold = %d" % CALIBRATION), [], model, s)
    m = kept.where("n_words > 0").agg(
        F.count("*").alias("n"), F.avg("best").alias("mean"), F.var_samp("best").alias("var"), F.avg(F.log("n_words")).alias("ln")
    ).first()
    if not m["n"]:
        return model
    # the maximum's variance is pi^2 / (6 lambda^2), its mean (ln(K n) + Euler's constant) / lambda
    rate = math.pi / math.sqrt(6 * max(m["var"] or 0.0, 0.05))
    return model._replace(rate=rate, log_k=rate * m["mean"] - 0.5772156649 - m["ln"])


def learn(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on labelled rows outside the held-out remainder.

    Words are counted over all of them.  The distribution of the maximum and the logistic
    curve come from texts that the words weren't learned from (remainder 3, with
    a model of remainders 0 and 1); then the words are learned again from all
    three.  The curve is fitted on at most ``sample`` texts, taken by hash of the text.
    Without labels of both kinds there is nothing to learn: all scores are 0.
    """
    rows = labelled(docs, labels)
    with small_batches(docs.sparkSession):
        part = Model(word_scores(rows.where(F.col("fold") != CALIBRATION), s), s.drift)
        full = Model(word_scores(rows, s), s.drift)
        if isinstance(full.scores, dict) and not full.scores:
            return full
        part = _with_extremes(part, rows, s)
        held = _with_features(rows.where(F.col("fold") == CALIBRATION), ["is_toxic"], part, s)
        n = rows.where(F.col("fold") == CALIBRATION).count()
        if n > s.sample:
            # evenly over the hash range, the same rows at every run
            rows = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * s.sample / n * 0.98))
            held = _with_features(rows.where(F.col("fold") == CALIBRATION), ["is_toxic"], part, s)
        got = held.select("is_toxic", "significance", "passages", "share", "best").limit(s.sample).toArrow()
    x = _inputs(*(got[name].to_numpy() for name in ("significance", "passages", "share", "best")))
    y = got["is_toxic"].to_numpy().astype(np.float64)
    curve = _fit_curve(x, y) if len(y) else ()
    return full._replace(rate=part.rate, log_k=part.log_k, curve=curve)


def score_toxicity(docs: DataFrame, model: Model, s: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): score, prediction and passages.

    Only the text is looked at.  Null and empty texts have no words and get the score of a
    text without passages.  ``first_word`` and ``last_word`` (exclusive) bound the best
    passage, null if there is none.  One pass without shuffle, unless the words are so many that
    their scores are a table.
    """
    curve = np.array(model.curve)
    base = _with_features(docs, ["doc_id"], model, s)
    if not len(curve):
        score = F.lit(0.0)
    else:
        # the same terms as in _inputs
        terms = [
            F.lit(1.0),
            F.least(F.greatest("significance", F.lit(-20.0)), F.lit(60.0)),
            F.log1p("passages"),
            F.col("share"),
            F.log1p("best"),
        ]
        total = sum((F.lit(float(w)) * t for w, t in zip(curve, terms)), F.lit(0.0))
        score = 1 / (1 + F.exp(-total))
    scored = base.withColumn("score", score)
    return scored.select(
        "doc_id",
        F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= s.threshold).cast("int").alias("predicted"),
        "passages",
        "share",
        "first_word",
        "last_word",
        "n_words",
    )


def toxic_documents(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Learn from ``labels`` and score every row of ``docs``; stored."""
    return table(score_toxicity(docs, learn(docs, labels, s), s), "toxicity")
