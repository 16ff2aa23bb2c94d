"""Vector best-fit packing of tokenised documents into sequences."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import partitions, small_batches, table


class Bin(NamedTuple):
    """What one sequence may hold."""

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048  # sum of the squared lengths of its pieces

    def vector(self) -> np.ndarray:
        return np.array(self, dtype=np.float64)


class Pattern(NamedTuple):
    lengths: list[int]  # pieces of one sequence, in order
    times: int  # sequences made by this pattern


# --- tokens -----------------------------------------------------------------

PIECES = "doc_id long, row long, piece int, start long, length long, ids_crc32 long"

#: Fixed value: how the byte-level tokenizer splits texts ahead of its merges.
_SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Letters, signs and marks whose classes all Unicode versions agree on, and no long blanks.
_RARE = re.compile("[^\x00-\u024f\u2010-\u2027]|\\s{200}")
_LONG_WORD = 400


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible Latin-1
    characters stand for themselves, the rest follow from 256 on, in order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class TextIds:
    """Ids of texts, as the tokenizer at ``path`` gives them.

    Where the vocabulary's order is that of its merges, common texts are encoded by rank,
    which gives the same ids in a third of the time.  Special tokens, rare
    characters, long words and long blanks go through the tokenizer itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = self._by_rank(path)

    def _by_rank(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        splitter, model = layout.get("pre_tokenizer") or {}, layout["model"]
        plain = splitter.get("type") == "ByteLevel" and not splitter.get("add_prefix_space") and splitter.get("use_regex", True)
        if not plain or layout.get("normalizer") or model.get("type") != "BPE":
            return None
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in x): i for x, i in model["vocab"].items() if x not in self.special}
        return tiktoken.Encoding("ranked", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={})

    def of(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit numbers."""
        common = self.ranked and not _RARE.search(text) and not any(s in text for s in self.special)
        if common and max(map(len, text.split()), default=0) <= _LONG_WORD:
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4").tobytes()


_workers: dict[str, TextIds] = {}


def worker_ids(path: str) -> TextIds:
    """This Python worker's tokenizer, made once for all its tasks."""
    if path not in _workers:
        _workers[path] = TextIds(path)
    return _workers[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, bin: Bin = Bin(), end_id: int = 0) -> DataFrame:
    """Pieces of at most ``bin.tokens`` ids of each text followed by ``end_id``.

    A document within the bound is one piece.  A longer one is cut so that all
    pieces but the first are full.  Null texts are empty: one piece, the end id.
    ``row`` tells apart rows with equal ids.  The result is a stored table.
    """
    size = bin.tokens
    end = np.array([end_id], dtype="<u4").tobytes()
    names = [x.split()[0] for x in PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_ids(tokenizer_path)
        for batch in batches:
            rows = []
            keys = zip(batch["doc_id"].to_pylist(), batch["row"].to_pylist())
            for (doc_id, row), text in zip(keys, batch["text"]):
                ids = tokens.of(text.as_py() or "") + end
                n = len(ids) // 4
                first = n if n <= size else (n % size or size)
                start, stop, piece = 0, first, 0
                while start < n:
                    rows.append((doc_id, row, piece, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop])))
                    start, stop, piece = stop, stop + size, piece + 1
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    # texts are counted before Python sees them: the number is part of the stored result
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return table(rows.mapInArrow(cut, PIECES), "pieces")


# --- patterns ---------------------------------------------------------------


def patterns(counts: dict[int, int], bin: Bin = Bin(), score: str = "dot", weights=(1.0, 1.0, 1.0)) -> list[Pattern]:
    """Fill sequences one kind at a time until no piece is left.

    ``counts`` says how many pieces there are of each length; a length's demand is
    (tokens, one document, squared length).  A sequence starts with the longest
    piece left.  Then, of the lengths that fit *every* residual capacity, the best
    is taken, again and again: by ``"dot"`` the largest weighted dot-product of demand
    and residual, by ``"norm"`` the smallest weighted norm of what is left over.  As
    all dimensions follow from the length, equal fillings are made in one go, so the work
    depends on the number of lengths only, never on the number of pieces.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    capacity, weight = bin.vector(), np.asarray(weights, dtype=np.float64)
    lengths = np.array(sorted(left), dtype=np.int64)
    if len(lengths) and (lengths[-1] > bin.tokens or float(lengths[-1]) ** 2 > bin.attention or bin.documents < 1):
        raise ValueError("a piece is larger than a sequence may be")
    demand = np.stack([lengths, np.ones(len(lengths)), lengths.astype(np.float64) ** 2], axis=1)
    amount = np.array([left[x] for x in lengths.tolist()], dtype=np.int64)
    scaled = demand / capacity
    made = []
    while amount.any():
        residual, used, order = capacity.copy(), np.zeros(len(lengths), dtype=np.int64), []
        pick = int(np.flatnonzero(amount)[-1])
        while pick >= 0:
            order.append(pick)
            used[pick] += 1
            residual -= demand[pick]
            fits = (amount > used) & (demand <= residual).all(axis=1)
            if not fits.any():
                break
            rest = residual / capacity
            if score == "dot":
                value = scaled @ (weight * rest)
            else:
                value = -(((rest - scaled) ** 2) @ weight)
            value[~fits] = -np.inf
            pick = int(len(value) - 1 - np.argmax(value[::-1]))
        some = used > 0
        times = int((amount[some] // used[some]).min())
        amount -= used * times
        made.append(Pattern([int(lengths[i]) for i in order], times))
    return made


# --- places -----------------------------------------------------------------


class _Places:
    """Where the r-th piece of a length goes."""

    def __init__(self, made: list[Pattern]):
        found: dict[int, list[tuple[int, int, int, list[int]]]] = {}
        taken: dict[int, int] = {}
        base = 0
        for pattern in made:
            offsets: dict[int, list[int]] = {}
            at = 0
            for length in pattern.lengths:
                offsets.setdefault(length, []).append(at)
                at += length
            for length, places in offsets.items():
                start = taken.get(length, 0)
                found.setdefault(length, []).append((start, base, len(places), places))
                taken[length] = start + len(places) * pattern.times
            base += pattern.times
        self.of = {
            length: (
                np.array([x[0] for x in entries]),
                np.array([x[1] for x in entries]),
                np.array([x[2] for x in entries]),
                np.array([np.pad(x[3], (0, max(e[2] for e in entries) - x[2])) for x in entries]),
            )
            for length, entries in found.items()
        }

    def places(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        for length in np.unique(lengths):
            here = np.flatnonzero(lengths == length)
            start, base, each, places = self.of[int(length)]
            k = np.searchsorted(start, ranks[here], side="right") - 1
            turn, slot = np.divmod(ranks[here] - start[k], each[k])
            sequence[here], offset[here] = base[k] + turn, places[k, slot]
        return sequence, offset


def pack(pieces: DataFrame, bin: Bin = Bin(), score: str = "dot", weights=(1.0, 1.0, 1.0)) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Only the number of pieces of each length reaches the driver: at most
    ``bin.tokens`` numbers, whatever the size of the table.  There the patterns are made;
    each piece then finds its place from its rank among the pieces of its length.
    Ranks are counted in (length, salt) groups, so that a length which a third of all pieces
    have spreads over as many tasks as the session has shuffle partitions.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    found = _Places(patterns(counts, bin, score, weights))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row", "piece"), F.lit(partitions(spark))))
    # the sums of the salts of a length before each salt: one row per length and salt
    before = (
        salted.groupBy("length", "salt")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n"))
        .drop("n")
    )
    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("row", "piece")) - 1
    ranked = salted.withColumn("rank", rank).join(before, ["length", "salt"])
    kind = pieces.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    kept = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch["length"].to_numpy()
            ranks = batch["rank"].to_numpy() + batch["before"].to_numpy()
            sequence, offset = found.places(lengths, ranks)
            columns = [batch[name] for name in kept] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    return ranked.mapInArrow(place, kind)


def pack_documents(docs: DataFrame, tokenizer_path: str, bin: Bin = Bin(), end_id: int = 0) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and pack all pieces: one row per piece.

    The empty table gives no rows; repeated rows are packed each.
    """
    with small_batches(docs.sparkSession):
        pieces = token_pieces(docs, tokenizer_path, bin, end_id)
        return table(pack(pieces, bin), "packed").drop("row")


def utilisation(packed: DataFrame, bin: Bin = Bin()) -> DataFrame:
    """One row: the number of sequences and the share of each capacity that they use, 0 to 1.

    The capacity with the largest share is the one that binds.  One aggregation without a
    distinct count: a sequence is counted by its piece at offset 0.  Shares of the empty table are null.
    """
    used = {"tokens": F.sum("length"), "documents": F.count("*"), "attention": F.sum(F.col("length") * F.col("length"))}
    sums = packed.agg(F.count_if(F.col("offset") == 0).alias("sequences"), *(total.alias(name) for name, total in used.items()))
    return sums.select(
        "sequences",
        *(F.try_divide(F.col(name), F.col("sequences") * F.lit(float(getattr(bin, name)))).alias(name) for name in used),
    )
