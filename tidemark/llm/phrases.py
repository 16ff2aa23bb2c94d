"""Substring dedup of long passages by automata of repeated phrases.

1.  *Confirm.*  A distributed search finds the stretches of word windows that an earlier
    document has too, with the smallest document of each.
2.  *Compile.*  The phrases of those stretches (whole windows, laid end to end) are cut from
    the texts and compiled into automata over words, one for each block of documents: a
    block holds the phrases that its own documents need, so an automaton's size follows
    the block's text and each document is streamed through one automaton only.
3.  *Locate.*  Every occurrence of a phrase in a document later than the phrase's first one is
    found by exact comparison of words, wherever it stands, and its words are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, table
from tidemark.llm.repeats import Window, merged, numbered, repeated_windows, stretches, with_stretches

_LAST = 2**63 - 1


def word_units(text: str) -> np.ndarray:
    """One 64-bit hash per word."""
    codes = b"".join([xxhash.xxh64_digest(word) for word in text.encode().split()])
    return np.frombuffer(codes, dtype=np.uint64)


def phrases_of(stretches: list[tuple[int, int, int]], length: int) -> list[tuple[int, int]]:
    """(start, first document) of windows that cover the stretches (lo, hi, first): end to end,
    the last one at ``hi``.  Neighbouring stretches with the same first document are one."""
    joined: list[list[int]] = []
    for lo, hi, first in sorted(stretches):
        if joined and joined[-1][2] == first and lo <= joined[-1][1] + 1:
            joined[-1][1] = max(joined[-1][1], hi)
        else:
            joined.append([lo, hi, first])
    return [(start, first) for lo, hi, first in joined for start in (*range(lo, hi, length), hi)]


class Block:
    """Documents of one block, and the automaton of their phrases."""

    def __init__(self, length: int):
        self.length = length
        self.ids: dict[bytes, int] = {}
        self.first: dict[tuple[int, ...], int] = {}
        self.rows: list[tuple[int, int, list[bytes]]] = []
        self.words = 0

    def add(self, doc_id: int, doc: int, words: list[bytes], stretches: list[tuple[int, int, int]]) -> None:
        self.rows.append((doc_id, doc, words))
        self.words += len(words)
        if stretches:
            codes = [self.ids.setdefault(word, len(self.ids)) for word in words]
            for start, first in phrases_of(stretches, self.length):
                phrase = tuple(codes[start : start + self.length])
                self.first[phrase] = min(first, self.first.get(phrase, first))

    def removed(self) -> Iterator[tuple[int, list[bytes], list[tuple[int, int]]]]:
        """For each document: doc_id, words, and the removed [start, stop)."""
        automaton = None
        if self.first:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
            for phrase, first in self.first.items():
                automaton.add_word(phrase, first)
            automaton.make_automaton()
        other = len(self.ids)  # stands for all words that no phrase has
        for doc_id, doc, words in self.rows:
            found = []
            if automaton is not None and len(words) >= self.length:
                codes = tuple([self.ids.get(word, other) for word in words])
                found = [(end + 1 - self.length, end + 1) for end, first in automaton.iter(codes) if first < doc]
            yield doc_id, words, merged(np.array(found)) if found else []


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def remove_passages(docs: DataFrame, length: int = 50, gram: int = 8, block_words: int = 500_000) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): its words without repeated passages.

    A word goes if a window of ``length`` words that covers it also starts in a document with a smaller
    doc_id.  Windows are judged on the input and never cross documents; the first document
    of a passage keeps all its copies of it.  Null texts have no words; null doc_ids
    come last; rows with equal doc_ids aren't earlier than each other.
    """
    w = Window(length, min(gram, length), (1,))
    rows = numbered(docs, F.coalesce("doc_id", F.lit(_LAST)))
    found = stretches(repeated_windows(rows, word_units, w, earlier=True), by_first=True)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(block: Block) -> pa.RecordBatch:
            out = []
            for doc_id, words, spans in block.removed():
                kept, at = [], 0
                for start, stop in spans:
                    kept += words[at:start]
                    at = stop
                text = b" ".join(kept + words[at:] if spans else words)
                removed = sum(b - a for a, b in spans)
                out.append((doc_id, len(words), removed, hashlib.sha256(text).hexdigest(), text.decode()))
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64()] * 3 + [pa.string()] * 2
            names = [x.split()[0] for x in RESULT.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        block = Block(length)
        for batch in batches:
            for i in range(batch.num_rows):
                lists, stretches = batch["covered"][i], []
                if lists.is_valid:
                    flat = lists.values
                    stretches = list(zip(*(flat.field(j).to_pylist() for j in range(3))))
                words = batch["text"][i].as_py().encode().split()
                block.add(batch["doc_id"][i].as_py(), batch["doc"][i].as_py(), words, stretches)
                if block.words >= block_words:
                    yield flush(block)
                    block = Block(length)
        yield flush(block)

    with small_batches(docs.sparkSession):
        full = with_stretches(rows, found)
        return table(full.select("doc_id", "doc", "text", "covered").mapInArrow(cut, RESULT), "without-passages")
