"""Collocations: phrases whose words stand together more often than their parts would.

Stripes pattern: every prefix keys an associative counter of its next words.  A task counts
the stripes of the texts it reads and sends one row per prefix; stripes of a prefix are merged
elementwise.  The merged stripes give all that is asked: an entry is the frequency of an
extended phrase, the stripe of the empty prefix holds the words and their total, the prefix itself
is an entry of the stripe one word shorter, and the largest entry of a stripe is the largest extension
to the right; entries keyed by all but their first word give the largest to the left.

Stripes are counted length by length.  A phrase that is frequent has frequent parts, so
prefixes of k words are extended only where both phrases of k words in the extension may be frequent.  Hashes
of the extended phrases are counted in buckets first, and a phrase goes into a stripe
only if its bucket holds enough for a frequent one.  What may be frequent reaches the tasks as a bitmap
of fixed size: a bit that several phrases share costs a needless count and changes no result.  Texts are read
twice, once to count words and once to turn words into codes; the lengths after that work on codes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sized, small_batches, table

LONGEST = 5  # words in a phrase
LEAST = 100  # occurrences of a candidate
TOP = 2000  # phrases reported for each language
FILTER_BITS = 24
HOT_SHARE = 512  # a prefix with more than one in so many words has its stripe cut into SLICES
SLICES = 32
CHUNK = 1 << 21  # phrases counted at once
WORDS_A_BUCKET = 8  # there are that many fewer buckets of phrases than words
BUCKET_BITS = 16, 26  # and 2^16 at least, 2^26 at most
BLOCK = 1 << 15  # buckets in a row

#: A-Z in lower case; what ends a piece becomes a full stop, which no piece has.
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\v\f\r", b"abcdefghijklmnopqrstuvwxyz.........")


def tokens(text: str | None) -> list[bytes]:
    """Words of a text in lower case, with a full stop wherever a piece ends."""
    return (text or "").encode().translate(_FOLD).replace(b".", b" . ").split()


def word_counts(docs: DataFrame, most: int = 500_000) -> DataFrame:
    """(lang, word, n) for all words of (lang, text), stored; tasks send what they have at ``most`` words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: dict[str, Counter] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            langs = [lang for lang, found in every.items() for _ in found]
            words = [word.decode() for found in every.values() for word in found]
            ns = [n for found in every.values() for n in found.values()]
            every.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(ns, pa.int64())], names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                found = every.setdefault(lang, Counter())
                size -= len(found)
                found.update(tokens(text.as_py()))
                found.pop(b".", None)
                size += len(found)
                if size >= most:
                    yield flush()
                    size = 0
        yield flush()

    partial = docs.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return table(partial.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


MIX = 0xFF51AFD7ED558CCD


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


def phrase_hash(columns: list[np.ndarray]) -> np.ndarray:
    """One unsigned number for each row of codes; a single code is its own."""
    found = columns[0].view(np.uint64)
    for column in columns[1:]:
        found = mixed(found) * np.uint64(0x9E3779B97F4A7C15) + column.view(np.uint64)
    return found


class Filter:
    """Bits of hashes: says of all that were added, and of few others, that they are in it."""

    def __init__(self, data: bytes):
        self.bits = np.frombuffer(data, dtype=np.uint8)
        self.mask = np.uint64(8 * len(data) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = mixed(hashes) & self.mask
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def filter_of(phrases: DataFrame, bits: int) -> bytes:
    """The bits of (phrase array<long>): 2^``bits`` of them, whatever the number of phrases."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["phrase"].flatten().to_numpy()
            if len(flat):
                rows = flat.reshape(batch.num_rows, -1)
                hashes = phrase_hash([np.ascontiguousarray(rows[:, i]) for i in range(rows.shape[1])])
                at = (mixed(hashes) & np.uint64((1 << bits) - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at + 1)], names=["at"])

    each = phrases.select("phrase").mapInArrow(places, "at long")
    maps = each.groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    size = 1 << 12  # bytes in a bucket
    data = bytearray(max(1 << bits >> 3, size))
    for bucket, some in maps.collect():  # at most 2^bits / 32768 rows
        data[(bucket - 1) * size : bucket * size] = some
    return bytes(data)


class Codes(dict):
    """Codes of words, 0 for a word that isn't frequent; forgets when it has grown too large."""

    def __init__(self, frequent: bytes, salt: bytes, most: int = 1 << 20):
        self.frequent, self.salt, self.most = frequent, salt, most
        self.mask = 8 * len(frequent) - 1

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        code = xxhash.xxh64_intdigest(word + self.salt, 42)
        h = (code ^ (code >> 33)) * MIX & (1 << 64) - 1
        at = (h ^ (h >> 29)) & self.mask
        self[word] = found = code if word != b"." and self.frequent[at >> 3] >> (at & 7) & 1 else 0
        return found


def coded(docs: DataFrame, frequent: bytes, salt: str, most: int = 1 << 16) -> DataFrame:
    """(lang, codes): the texts as codes of frequent words, 0 between others; stored.

    Words without a frequent neighbour are left out.  Long texts are several rows, cut between
    pieces after ``most`` codes.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = Codes(frequent, salt.encode())
        for batch in batches:
            langs, rows = [], []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                codes = np.fromiter(map(of.__getitem__, tokens(text.as_py())), dtype=np.uint64)
                codes = runs_only(np.r_[np.uint64(0), codes, np.uint64(0)])
                while len(codes) > 1:
                    ends = np.flatnonzero(codes[most:] == 0)
                    stop = most + int(ends[0]) + 1 if len(ends) else len(codes)
                    langs.append(lang)
                    rows.append(codes[:stop].view(np.int64))
                    codes = codes[stop:]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.list_(pa.int64()))], names=["lang", "codes"])

    return table(docs.select("lang", "text").mapInArrow(encode, "lang string, codes array<long>"), "coded")


def runs_only(codes: np.ndarray) -> np.ndarray:
    """``codes`` (0 first and last) without codes between zeros and without repeated zeros."""
    some = codes != 0
    kept = some & (np.r_[False, some[:-1]] | np.r_[some[1:], False])
    return codes[kept | (np.r_[False, kept[:-1]] & ~kept)]


def occurrences(codes: np.ndarray, size: int, shorter: Filter | None, likely: Filter | None = None) -> np.ndarray:
    """The phrases of ``size`` codes in a sequence, one row each.

    They hold no 0, their first and last ``size`` - 1 codes are in ``shorter``, and they are in ``likely``.
    """
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros((0, size), dtype=np.int64)
    some = codes != 0
    at = np.flatnonzero(np.logical_and.reduce([some[i : i + n] for i in range(size)]))
    if shorter is not None:
        at = at[shorter.has(phrase_hash([codes[at + i] for i in range(size - 1)]))]
        at = at[shorter.has(phrase_hash([codes[at + i] for i in range(1, size)]))]
    if likely is not None:
        at = at[likely.has(phrase_hash([codes[at + i] for i in range(size)]))]
    return np.stack([codes[at + i] for i in range(size)], axis=1)


def stripes_of(phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different phrases (rows of codes) ordered by prefix, their counts, and where each prefix starts."""
    size = phrases.shape[1]
    words, place = np.unique(phrases, return_inverse=True)
    place = place.reshape(phrases.shape).astype(np.int64)
    keys, first, phrase, counts = place[:, 0], None, place[:, 0], None
    for i in range(1, size):
        keys, first, phrase, counts = np.unique(
            phrase * len(words) + place[:, i], return_index=True, return_inverse=True, return_counts=True
        )
    prefixes = keys // max(len(words), 1)
    starts = np.flatnonzero(np.r_[True, prefixes[1:] != prefixes[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return phrases[first], counts, starts


def sequences(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """The codes of a batch, one sequence for each language."""
    every: dict[str, list[np.ndarray]] = {}
    for lang, codes in zip(batch["lang"].to_pylist(), batch["codes"]):
        every.setdefault(lang, []).append(codes.values.to_numpy())
    for lang, parts in every.items():
        yield lang, np.concatenate(parts)


def likely_phrases(texts: DataFrame, size: int, shorter: bytes | None, least: int, bits: int) -> bytes:
    """A bitmap of 2^``bits`` buckets: those whose phrases of ``size`` codes occur ``least`` times, all languages together.

    Tasks count up to 255 and send the buckets that aren't empty; a stream of rows is added up for each block of buckets.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shorter and Filter(shorter)
        counts = np.zeros(1 << bits, dtype=np.uint8)
        for batch in batches:
            for _, codes in sequences(batch):
                phrases = occurrences(codes, size, known)
                hashes = phrase_hash([np.ascontiguousarray(phrases[:, i]) for i in range(size)])
                at = (mixed(hashes) & np.uint64((1 << bits) - 1)).astype(np.int64)
                bucket, n = np.unique(at, return_counts=True)
                counts[bucket] = np.minimum(counts[bucket] + n, 255)
        for start in range(0, 1 << bits, BLOCK):
            here = counts[start : start + BLOCK]
            some = np.flatnonzero(here)
            if len(some):
                columns = [pa.array([start // BLOCK]), pa.array([some.astype(np.uint16).tobytes()]), pa.array([here[some].tobytes()])]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "place", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, place, n in zip(batch["block"].to_pylist(), batch["place"], batch["n"]):
                total = totals.setdefault(block, np.zeros(BLOCK, dtype=np.uint32))
                total[np.frombuffer(place.as_py(), dtype=np.uint16)] += np.frombuffer(n.as_py(), dtype=np.uint8)
                np.minimum(total, 1 << 16, out=total)
        maps = [np.packbits(total >= least, bitorder="little").tobytes() for total in totals.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int64()), pa.array(maps, pa.binary())], names=["block", "bits"])

    partial = texts.mapInArrow(count, "block long, place binary, n binary")
    data = bytearray(max(1 << bits, BLOCK) >> 3)
    for block, some in partial.repartition("block").mapInArrow(add, "block long, bits binary").collect():
        data[block * len(some) : (block + 1) * len(some)] = some  # the bitmap is all that comes back
    return bytes(data)


STRIPES = "lang string, prefix array<long>, slice int, next array<long>, n array<long>"


def stripes(texts: DataFrame, size: int, shorter: bytes | None, likely: bytes, hot: set[tuple], chunk: int = CHUNK) -> DataFrame:
    """The stripes of (lang, codes) for phrases of ``size`` codes, as counted by tasks.

    A stripe of a prefix in ``hot`` (lang and codes) is cut by its next words into slices.  A task sends what it
    has counted after every ``chunk`` phrases.
    """
    hottest = {(lang, np.array(prefix, dtype=np.int64).tobytes()) for lang, prefix in hot}

    def rows_of(lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
        phrases, counts, starts = stripes_of(np.concatenate(parts))
        slices = np.zeros(len(starts), dtype=np.int32)
        prefixes = phrases[starts, : size - 1]
        cut = [i for i, p in enumerate(prefixes) if (lang, p.tobytes()) in hottest] if hottest else []
        if cut:
            stops = np.r_[starts[1:], len(phrases)]
            owner = np.repeat(np.arange(len(starts)), stops - starts)
            part = np.where(np.isin(owner, cut), (mixed(phrases[:, -1].view(np.uint64)) % np.uint64(SLICES)).astype(np.int64), 0)
            order = np.lexsort((part, owner))
            phrases, counts, owner, part = phrases[order], counts[order], owner[order], part[order]
            starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (part[1:] != part[:-1])])
            slices = part[starts].astype(np.int32)
            prefixes = phrases[starts, : size - 1]
        bounds = pa.array(np.r_[starts, len(phrases)].astype(np.int32))
        ends = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * (size - 1))
        columns = [
            pa.array([lang] * len(starts), pa.string()),
            pa.ListArray.from_arrays(ends, pa.array(prefixes.ravel())),
            pa.array(slices),
            pa.ListArray.from_arrays(bounds, pa.array(np.ascontiguousarray(phrases[:, -1]))),
            pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int64))),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "slice", "next", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = [data and Filter(data) for data in (shorter, likely)]
        held: dict[str, list[np.ndarray]] = {}
        n = 0
        for batch in batches:
            for lang, codes in sequences(batch):
                found = occurrences(codes, size, *filters)
                if len(found):
                    held.setdefault(lang, []).append(found)
                    n += len(found)
            if n >= chunk:
                yield from (rows_of(lang, parts) for lang, parts in held.items())
                held, n = {}, 0
        yield from (rows_of(lang, parts) for lang, parts in held.items())

    return texts.mapInArrow(count, STRIPES)


def merged_rows(rows: pa.RecordBatch) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Stripes in the order of their keys, those with equal keys added up: (all but the last, as entries; the last)."""
    lang = rows["lang"].dictionary_encode().indices.to_numpy()
    prefix = rows["prefix"].flatten().to_numpy().reshape(rows.num_rows, -1)
    part = rows["slice"].to_numpy()
    other = (lang[1:] != lang[:-1]) | (prefix[1:] != prefix[:-1]).any(axis=1) | (part[1:] != part[:-1])
    firsts, stripe = np.flatnonzero(np.r_[True, other]), np.r_[0, np.cumsum(other)]
    owner = np.repeat(stripe, rows["next"].value_lengths().to_numpy())
    entry, n = rows["next"].flatten().to_numpy(), rows["n"].flatten().to_numpy()
    order = np.lexsort((entry, owner))
    owner, entry, n = owner[order], entry[order], n[order]
    at = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (entry[1:] != entry[:-1])])
    owner, entry, n = owner[at], entry[at], np.add.reduceat(n, at)
    last = owner == stripe[-1]
    row = rows.slice(int(firsts[-1]), 1)
    held = [row["lang"], row["prefix"], row["slice"], *(pa.array([x[last]], pa.list_(pa.int64())) for x in (entry, n))]
    place = pa.array(firsts[owner[~last]])
    done = [rows["lang"].take(place), rows["prefix"].take(place), pa.array(entry[~last]), pa.array(n[~last])]
    names = ["lang", "prefix", "slice", "next", "n"]
    return (
        pa.RecordBatch.from_arrays(done, names=["lang", "prefix", "next", "n"]),
        pa.RecordBatch.from_arrays(held, names=names),
    )


def merged(partial: DataFrame, least: int) -> DataFrame:
    """(lang, prefix, next, n): stripes merged elementwise, entries of ``least`` or more; stored.

    Stripes meet by prefix (and slice) and are merged as they come in that order; a task holds one merged stripe.
    """
    keys = ["lang", "prefix", "slice"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                rows = batch if held is None else pa.Table.from_batches([held.cast(batch.schema), batch]).combine_chunks().to_batches()[0]
                done, held = merged_rows(rows)
                yield done.filter(pc.greater_equal(done["n"], least))
        if held is not None:
            place = pa.array(np.zeros(len(held["next"][0]), dtype=np.int64))
            columns = [held["lang"].take(place), held["prefix"].take(place), held["next"].flatten(), held["n"].flatten()]
            done = pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "next", "n"])
            yield done.filter(pc.greater_equal(done["n"], least))

    met = partial.repartition(*keys).sortWithinPartitions(*keys)
    return table(met.mapInArrow(merge, "lang string, prefix array<long>, next long, n long"), "stripes")


def salted_codes(words: DataFrame) -> tuple[DataFrame, str]:
    """``words`` with a code for each, none 0 and no two alike in a language, and the salt for that."""
    for salt in ("", "1", "2", "3", "4", "5", "6", "7"):
        found = words.withColumn("code", F.xxhash64(F.concat("word", F.lit(salt))))
        alike = found.groupBy("lang", "code").agg(F.count("*").alias("k")).where("k > 1 or code = 0")
        if alike.isEmpty():
            return found, salt
    raise ValueError("no salt tells all words apart")


def frequent_phrases(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, filter_bits: int = FILTER_BITS, chunk: int = CHUNK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of ``docs`` (lang, text): (lang, n), (lang, word, code), (lang, phrase, n) with words as codes, stored.

    ``n`` is the number of all words of a language, and of a phrase's occurrences; phrases have one to ``longest``
    words and ``least`` or more occurrences.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    with small_batches(docs.sparkSession):
        words = word_counts(docs)
        totals = table(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        known, salt = salted_codes(words)
        known = table(known.where(F.col("n") >= least), "frequent-words")
        found = [known.select("lang", F.array("code").alias("phrase"), "n")]
        every = totals.agg(F.sum("n")).first()[0] or 0
        texts = coded(docs, filter_of(found[0], filter_bits), salt)
        low, high = BUCKET_BITS
        bits = min(max((every // WORDS_A_BUCKET).bit_length(), low), high)
        for size in range(2, longest + 1):
            # at most HOT_SHARE prefixes
            hot = {(r[0], tuple(r[1])) for r in found[-1].where(F.col("n") * HOT_SHARE > every).select("lang", "phrase").collect()}
            shorter = None if size == 2 else filter_of(found[-1], filter_bits)
            likely = likely_phrases(texts, size, shorter, least, bits)
            entries = merged(stripes(texts, size, shorter, likely, hot, chunk), least)
            found.append(entries.select("lang", F.concat("prefix", F.array("next")).alias("phrase"), "n"))
    phrases = found[0]
    for more in found[1:]:
        phrases = phrases.union(more)
    return totals, known.select("lang", "word", "code"), table(phrases, "phrases")


def collocations(
    docs: DataFrame,
    longest: int = LONGEST,
    least: int = LEAST,
    top: int | None = TOP,
    share: int = 100,
    filter_bits: int = FILTER_BITS,
    chunk: int = CHUNK,
) -> DataFrame:
    """The ``top`` collocations of each language in ``docs`` (lang, text): lang, rank, phrase, a, l, r, n, score.

    Texts are folded (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and at blanks and tabs into words.  A phrase of
    2 to ``longest`` words with ``least`` or more occurrences ``a`` is cut where floor(1000 a n / (l r)) is least, first of
    equal ones; ``l`` and ``r`` are the frequencies of the two parts.  A phrase goes if a longer one that holds it has
    ``share`` percent of its occurrences: as no phrase is more frequent than what it holds, one word more on
    either side tells.  Ranks go by score, frequency, and phrase in bytes.  Null texts have no words, a
    null language is ``und``; an empty table has no phrases.  Repeated rows count as often as they stand.  ``top`` None gives all.
    """
    totals, words, phrases = frequent_phrases(docs, longest, least, filter_bits, chunk)
    size = F.size("phrase")
    candidates = phrases.where(size > 1)
    right = candidates.where(size > 2).select("lang", F.slice("phrase", F.lit(1), size - 1).alias("phrase"), "n")
    left = candidates.where(size > 2).select("lang", F.slice("phrase", F.lit(2), size - 1).alias("phrase"), "n")
    longer = right.union(left).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").where(f"longer is null or 100 * longer < {int(share)} * n")
    kept = table(kept.select("lang", "phrase", F.col("n").alias("a")), "candidates")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    first = F.slice("phrase", F.lit(1), F.col("k")).alias("first")
    rest = F.slice("phrase", F.col("k") + 1, size - F.col("k")).alias("rest")
    cuts = cuts.select("lang", "phrase", "a", "k", first, rest)
    parts = phrases.withColumnRenamed("n", "m")
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("m").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("m").alias("r")), ["lang", "rest"])
    cuts = cuts.join(sized(totals), "lang")
    a, n, l, r = (F.col(x).cast("decimal(19,0)") for x in ("a", "n", "l", "r"))
    cuts = cuts.withColumn("up", (a * n) * F.lit(1000).cast("decimal(4,0)")).withColumn("down", l * r)
    cuts = cuts.withColumn("score", F.expr("up div down"))  # whole numbers of up to 38 digits
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = table(best.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r"), "scored")
    spelled = best.select("lang", "phrase", F.posexplode("phrase").alias("at", "code")).join(words, ["lang", "code"])
    spelled = spelled.groupBy("lang", "phrase").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    text = F.array_join(F.transform("words", lambda x: x["word"]), " ")
    named = best.join(spelled.select("lang", "phrase", text.alias("text")), ["lang", "phrase"])
    order = "partition by lang order by score desc, a desc, text"
    ranked = named.withColumn("rank", F.expr(f"row_number() over ({order})"))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long"), F.col("text").alias("phrase"), "a", "l", "r", "n", "score")
