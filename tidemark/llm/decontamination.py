"""Benchmark questions in documents, also with other numbers, names and units.

Texts become templates: numbers, names and units turn into typed placeholders.
Windows of template tokens are hash-joined with those of the benchmark; for the few
pairs that meet, the templates are laid over each other, runs of equal tokens cover the
item, and each name must map to one name.  A name that starts a sentence looks like any other
word there; single places that differ in such a word don't end a run.  Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import row_key, sized, table

#: Placeholders in templates: private-use characters, which no word has.
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"
#: Units that may follow a number.
UNITS = (
    "mm cm dm m km mi ft in yd g kg mg t lb oz ml cl l s ms min h hr hrs hour hours minute minutes "
    "second seconds day days week weeks month months year years mph kph kmh dollar dollars euro euros "
    "cent cents percent meter meters metre metres kilometer kilometers mile miles gram grams liter liters"
).split()

#: A token: a number or a word.  A word with a capital that doesn't start a sentence (after a
#: lower-case letter or a comma and a space) keeps that space, which marks it as a name.
TOKEN = r"(?: (?=\p{Lu})(?<=[\p{Ll},;] ))?+(?:\p{L}[\p{L}\p{M}]*+|[0-9]++(?:[.,][0-9]++)*+)"
RUN = 8  # tokens in a row that count
WINDOW, STRIDE = 5, 4  # every run of RUN tokens holds a window that starts at a multiple of STRIDE
#: Kinds of tokens; a capital is a word with a capital that may just start a sentence.
K_WORD, K_CAPITAL, K_NAME, K_NUMBER, K_UNIT = range(5)


def record(**fields: Column) -> Column:
    """A struct whose names hold inside lambdas too."""
    return F.named_struct(*(x for name, value in fields.items() for x in (F.lit(name), value)))


def marked_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def _kind(every: Column, x: Column, i: Column) -> Column:
    """The kind of token ``x`` at place ``i`` of the marked tokens ``every``; common ones are told first."""

    def number(token: Column) -> Column:
        return (token >= "0") & (token < ":")

    first = F.substring(x, 1, 1)
    unit = number(F.get(every, i - 1)) & x.isin(*UNITS)
    return (
        F.when((x >= "a") & (x < "{"), F.when(unit, K_UNIT).otherwise(K_WORD))
        .when(x < "!", K_NAME)
        .when(number(x), K_NUMBER)
        .when(first != F.lower(first), K_CAPITAL)
        .otherwise(K_WORD)
    )


def kinds(every: Column) -> Column:
    return F.transform(every, lambda x, i: _kind(every, x, i))


def parsed_tokens(every: Column) -> Column:
    """Structs (low, kind) of the marked tokens in a column: lower-case word and kind."""
    return F.transform(every, lambda x, i: record(low=F.lower(F.ltrim(x)), kind=_kind(every, x, i)))


def raw_tokens(text: Column) -> Column:
    """Words and numbers as they stand; as many as template tokens."""
    return F.transform(marked_tokens(text), F.ltrim)


def template_tokens(text: Column) -> Column:
    """Lower-case words, with placeholders for numbers, units after numbers, and names."""

    def template(t: Column) -> Column:
        named = F.when(t["kind"] == K_NAME, NAME).when(t["kind"] == K_UNIT, UNIT)
        return named.when(t["kind"] == K_NUMBER, NUMBER).otherwise(t["low"])

    return F.transform(parsed_tokens(marked_tokens(text)), template)


def codes(every: Column, kind: Column) -> Column:
    """A number for each of the marked tokens ``every`` of these kinds; names have that of their word."""

    def code(x: Column, i: Column) -> Column:
        return F.when(F.get(kind, i) >= K_NUMBER, F.get(kind, i).cast("long")).otherwise(F.xxhash64(F.lower(F.ltrim(x))))

    return F.transform(every, code)


def with_windows(rows: DataFrame, sizes: list[tuple[int, int]]) -> DataFrame:
    """``rows`` with ``text`` replaced by (at, code): windows, for each (size, stride) at every stride-th place.

    A window has up to three forms: without names (which meets copies in lower case), with
    the names in the middle of sentences, and with all capitalised words as names.  Forms that
    are the same are given once.  The last one needs two other words: windows of names alone
    would meet all texts in capitals.
    """
    others = [c for c in rows.columns if c != "text"]
    marked = rows.select(*others, marked_tokens(F.col("text")).alias("__marked"))
    kinded = marked.select(*others, "__marked", kinds(F.col("__marked")).alias("__kinds"))
    coded = kinded.select(*others, codes(F.col("__marked"), F.col("__kinds")).alias("__codes"), "__kinds")

    # all lengths from one reading of the texts
    each = F.explode(F.array(*(record(size=F.lit(size), stride=F.lit(stride)) for size, stride in sizes)))
    sized_rows = coded.select(*others, "__codes", "__kinds", each.alias("__w")).where(F.size("__codes") >= F.col("__w.size"))
    places = F.sequence(F.lit(0), F.size("__codes") - F.col("__w.size"), F.col("__w.stride"))
    placed = sized_rows.select(*others, "__codes", "__kinds", F.col("__w.size").alias("__size"), F.explode(places).alias("at"))

    def for_size(of: Callable[[list[Column], list[Column]], Column]) -> Column:
        """``of`` the codes and kinds in the window, whatever its size."""
        chosen = None
        for size, _ in sizes:
            here = [[F.get(x, F.col("at") + k) for k in range(size)] for x in ("__codes", "__kinds")]
            mine = F.col("__size") == size
            chosen = F.when(mine, of(*here)) if chosen is None else chosen.when(mine, of(*here))
        return chosen

    def code(*named: int) -> Column:
        def hashed(here: list[Column], kind: list[Column]) -> Column:
            parts = [F.when(k.isin(*named), F.lit(K_NAME).cast("long")).otherwise(c) for c, k in zip(here, kind)]
            return F.xxhash64(F.lit(len(here)), *(parts if named else here))

        return for_size(hashed)

    def number_of(named: int) -> Column:
        return for_size(lambda _, kind: reduce(lambda a, b: a + b, [(k == named).cast("int") for k in kind]))

    named = placed.select("*", number_of(K_CAPITAL).alias("__capitals"), number_of(K_NAME).alias("__names"))
    names = F.when(F.col("__names") > 0, code(K_NAME))
    worded = F.col("__capitals") + F.col("__names") <= F.col("__size") - 2
    every = F.when((F.col("__capitals") > 0) & worded, code(K_NAME, K_CAPITAL))
    forms = named.select(*others, "at", F.explode(F.array(code(), names, every)).alias("code"))
    return forms.where("code is not null")


def find_items(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(key, item, size, shift): documents and items that share a template window.

    ``key`` stands for a row of ``docs``, ``item`` for a benchmark text of ``size`` tokens; ``shift`` is
    the place in the document of the item's first token.  Every run of eight tokens in common is met by
    a window of five at a multiple of four, in one of its forms.  Items of fewer tokens are windows of
    their own length, looked for at every place.  Texts are read once for all of that.  The benchmark's
    windows are broadcast only if there are no more than ``broadcast_rows`` of 32 bytes; else the
    join is a shuffle.
    """
    items = table(benchmark.select("item", "text", F.size(marked_tokens(F.col("text"))).alias("size")), "benchmark")
    sizes = items.where(F.col("size").between(1, RUN - 1)).select("size").distinct()
    short = sorted(r[0] for r in sizes.collect())  # at most seven numbers
    asked = [with_windows(items.where(F.col("size") >= RUN), [(WINDOW, 1)])]
    asked += [with_windows(items.where(F.col("size") == n), [(n, 1)]) for n in short]
    asked = table(reduce(DataFrame.union, asked).withColumnRenamed("at", "item_at").distinct(), "benchmark-windows")
    if asked.count() <= broadcast_rows:
        asked = F.broadcast(asked)
    texts = docs.select(row_key().alias("key"), "text")
    met = with_windows(texts, [(WINDOW, STRIDE), *((n, 1) for n in short)]).join(asked, "code")
    return met.select("key", "item", "size", (F.col("at") - F.col("item_at")).alias("shift")).distinct()


#: A 1 that isn't in a run of RUN or more.
_ALONE = "(?!" + "|".join(f"(?<=1{{{n}}})1{{{RUN - n}}}" if n else f"1{{{RUN}}}" for n in range(RUN)) + ")1"


def covered(same: Column) -> Column:
    """A text of 0 and 1 without its short runs of 1: shorter than RUN, or than an item of fewer tokens."""
    short = F.when(F.contains(same, F.lit("0")), F.translate(same, "1", "0")).otherwise(same)
    return F.when(F.length(same) >= RUN, F.regexp_replace(same, _ALONE, "0")).otherwise(short)


def held_items(docs: DataFrame, benchmark: DataFrame, least_cover: float = 0.5) -> DataFrame:
    """(key, best, n_items) of the rows of ``docs`` that hold an item, stored; see ``decontaminate``."""
    asked = benchmark.where("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    asked = table(asked.select(F.xxhash64("text").alias("item"), "item_id", "text"), "benchmark")
    met = table(find_items(docs, asked), "met")
    pairs = table(met.groupBy("key").agg(F.collect_set(F.struct("item", "size", "shift")).alias("met")), "met")
    # Only the part of a document that an item is laid over goes on with the pair.
    texts = docs.select(row_key().alias("key"), "text").join(sized(pairs), "key").dropDuplicates(["key"])
    texts = texts.select("key", "met", marked_tokens(F.col("text")).alias("marked"))
    texts = texts.select("key", parsed_tokens(F.col("marked")).alias("tokens"), F.explode("met").alias("m"))
    start = F.greatest(F.col("m.shift"), F.lit(0))
    part = F.slice("tokens", start + 1, F.col("m.shift") + F.col("m.size") - start)
    parts = texts.select("key", "m.item", "m.size", "m.shift", (start - F.col("m.shift")).alias("lead"), part.alias("part"))
    item_tokens = asked.select("item", marked_tokens(F.col("text")).alias("marked"))
    item_tokens = table(item_tokens.select("item", parsed_tokens(F.col("marked")).alias("tokens")), "benchmark")
    laid = parts.join(sized(item_tokens), "item")

    def over(j: Column) -> Column:
        """The document's token under the item's one at ``j``; none ahead of the document or after it."""
        return F.when(j >= F.col("lead"), F.get("part", F.greatest(j - F.col("lead"), F.lit(0))))

    def compared(x: Column, j: Column) -> Column:
        y = over(j)
        alike = (x["kind"] == y["kind"]) & x["kind"].isin(K_NAME, K_NUMBER, K_UNIT)
        capital = x["kind"].isin(K_CAPITAL, K_NAME) | y["kind"].isin(K_CAPITAL, K_NAME)
        words = ~x["kind"].isin(K_NUMBER, K_UNIT) & ~y["kind"].isin(K_NUMBER, K_UNIT)
        return F.when(y.isNull(), "0").when(alike | (x["low"] == y["low"]), "1").when(capital & words, "~").otherwise("0")

    same = F.array_join(F.transform("tokens", compared), "")
    laid = laid.withColumn("compared", same)
    laid = laid.withColumn("same", F.replace("compared", F.lit("~"), F.lit("0")))
    # one place between equal ones that differs in a capitalised word doesn't end a run
    bridged = F.replace(F.regexp_replace("compared", "(?<![~0])~(?![~0])", "1"), F.lit("~"), F.lit("0"))
    laid = laid.withColumn("bridged", F.when(F.col("size") >= RUN, bridged).otherwise(F.col("same")))
    laid = laid.withColumn("plain_kept", covered(F.col("same"))).withColumn("bridged_kept", covered(F.col("bridged")))
    laid = laid.where(F.contains("plain_kept", F.lit("1")) | F.contains("bridged_kept", F.lit("1")))
    # read without bridges and with them
    plain = F.struct(F.lit(False).alias("bridges"), F.col("plain_kept").alias("kept"))
    other = F.struct(F.lit(True).alias("bridges"), F.col("bridged_kept").alias("kept"))
    laid = laid.withColumn("read", F.explode(F.array(plain, other)))
    laid = laid.withColumn("bridges", F.col("read.bridges")).withColumn("kept", F.col("read.kept"))
    # how much of the item a shift covers: in a periodic text several shifts cover the same places
    length = F.length(F.replace("kept", F.lit("0"), F.lit("")))

    def placed(x: Column, j: Column) -> Column:
        y = over(j)
        capital = x["kind"].isin(K_CAPITAL, K_NAME) | y["kind"].isin(K_CAPITAL, K_NAME)
        name = (x["kind"] == K_NAME) | (F.col("bridges") & capital)
        slot = F.when(name, record(a=x["low"], b=y["low"]))
        return F.when(F.substring("kept", j + 1, F.lit(1)) == "1", record(j=j, slot=slot))

    # a row per covered place: numbers, and the two words only where it is a name
    places = laid.select(
        "key", "item", "bridges", "size", F.struct((-length).alias("less"), "shift").alias("order"),
        F.explode(F.array_compact(F.transform("tokens", placed))).alias("place"),
    )
    # a place that several shifts cover is read at that which covers most, then the smallest
    one = places.groupBy("key", "item", "bridges", "size", "place.j").agg(F.min_by("place.slot", "order").alias("slot"))
    judged = one.groupBy("key", "item", "bridges", "size").agg(
        F.count("*").alias("n"), F.count_distinct("slot").alias("pairs"), F.count_distinct("slot.a").alias("names")
    )
    held = judged.where((F.col("n") >= least_cover * F.col("size")) & (F.col("pairs") == F.col("names")))
    held = held.groupBy("key", "item").agg(F.max(F.col("n") / F.col("size")).alias("cover"))
    held = held.join(asked.select("item", "item_id"), "item")
    best = F.max(F.struct("cover", (-F.col("item_id")).alias("order"), "item_id")).alias("best")
    return table(held.groupBy("key").agg(best, F.count("*").alias("n_items")), "held")


def decontaminate(docs: DataFrame, benchmark: DataFrame, least_cover: float = 0.5) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): whether it holds an item of ``benchmark`` (item_id, text).

    It does if runs of at least eight template tokens (all tokens of a shorter item) cover
    ``least_cover`` of an item and each of its names maps to one; numbers and units may be any.
    It is read twice, also so that single capitalised words that differ don't end a run; then they
    are names as well.  ``item_id`` is
    the item with the largest cover, then the smallest id; ``n_items`` counts all that are
    held.  Equal benchmark texts are one item under their smallest id.  Texts without
    tokens, nulls included, hold nothing and are held by nothing; repeated rows
    get equal results.  A passage in a third of all documents is a few rows for each
    of them, pre-aggregated by document; documents are never compared with each other.
    """
    return (
        docs.select("doc_id", row_key().alias("key"))
        .join(sized(held_items(docs, benchmark, least_cover)), "key", "left")
        .select(
            "doc_id",
            F.col("best").isNotNull().alias("contaminated"),
            F.col("best.item_id").alias("item_id"),
            F.coalesce("best.cover", F.lit(0.0)).alias("cover"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        )
    )
