"""License scan by templates with optional and replaceable regions.

A template is mandatory wording with two kinds of markup: ``[ ... ]`` may be left out
(it nests) and ``{0-8}`` stands for that many words of any kind.  Templates compile
into one automaton over words; a text is accepted where the mandatory words
stand exactly, in order, with nothing between them but what the markup allows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import small_batches, table


class Template(NamedTuple):
    label: str
    weight: float  # what a match says about the text's license, 0 to 1
    text: str


#: The phrases that are counted, and their labels.
BASE = [
    Template("mit", 0.5, "mit license"),
    Template("apache", 0.5, "apache license"),
    Template("gpl", 0.5, "general public license"),
]

# Wording of common license texts, in the parts that several have in common.
MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and "
    "associated documentation files the software to deal in the software without restriction including "
    "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
    "copies of the software and to permit persons to whom the software is furnished to do so subject to "
    "the following conditions"
)
MIT_NOTICE = (
    "the above copyright notice and this permission notice [including the next paragraph] shall be "
    "included in all copies or substantial portions of the software"
)
MIT_WARRANTY = (
    "the software is provided as is without warranty of any kind express or implied including but not "
    "limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
    "in no event shall {1-12} be liable for any claim damages or other liability whether in an action of "
    "contract tort or otherwise arising from out of or in connection with the software or the use or "
    "other dealings in the software"
)
BSD_GRANT = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met"
)
BSD_SOURCE = (
    "[1] [a] redistributions of source code must retain the above copyright notice this list of "
    "conditions and the following disclaimer"
)
BSD_BINARY = (
    "[2] [b] redistributions in binary form must reproduce the above copyright notice this list of "
    "conditions and the following disclaimer in the documentation and or other materials provided with "
    "the distribution"
)
BSD_ADVERTISING = (
    "[3] [c] all advertising materials mentioning features or use of this software must display the "
    "following acknowledgement this product includes software developed by {1-12}"
)
BSD_NAMES = (
    "[3] [c] [4] [d] neither the name of {1-12} nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission"
)
BSD_DISCLAIMER = (
    "this software is provided by {1-12} as is and any express or implied warranties including but not "
    "limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed in no event shall {1-12} be liable for any direct indirect incidental special exemplary or "
    "consequential damages including but not limited to procurement of substitute goods or services loss "
    "of use data or profits or business interruption however caused and on any theory of liability "
    "whether in contract strict liability or tort including negligence or otherwise arising in any way "
    "out of the use of this software even if advised of the possibility of such damage"
)
APACHE_OPENING = (
    "licensed under the apache license version 2 0 the license you may not use this file except in "
    "compliance with the license"
)
APACHE_REST = (
    "you may obtain a copy of the license at {1-8} unless required by applicable law or agreed to in "
    "writing software distributed under the license is distributed on an as is basis without warranties "
    "or conditions of any kind either express or implied see the license for the specific language "
    "governing permissions and limitations under the license"
)
GPL_OPENING = (
    "free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation"
)
GPL_REST = (
    "of the license or at your option any later version this {1-4} is distributed in the hope that it "
    "will be useful but without any warranty without even the implied warranty of merchantability or "
    "fitness for a particular purpose see the gnu general public license for more details"
)

#: Whole texts weigh 1, one-line notices 0.8, texts that only begin like a license 0.6.
TEMPLATES = [
    Template("mit-notice", 0.8, "released under the mit license"),
    Template("mit-notice", 0.8, "licensed under the [terms of the] mit license"),
    Template("mit-opening", 0.6, MIT_GRANT),
    Template("mit-text", 1.0, f"{MIT_GRANT} {MIT_NOTICE} {MIT_WARRANTY}"),
    Template("apache-2.0-notice", 0.8, "licensed under the apache license version 2 0"),
    Template("apache-2.0-text", 1.0, f"{APACHE_OPENING} {APACHE_REST}"),
    Template("gpl-3.0-notice", 0.8, "gnu general public license [as published by {1-6}] [either] version 3"),
    Template("gpl-2.0-notice", 0.8, "gnu general public license [as published by {1-6}] [either] version 2"),
    Template("gpl-opening", 0.6, GPL_OPENING),
    Template("gpl-3.0-text", 1.0, f"{GPL_OPENING} either version 3 {GPL_REST}"),
    Template("gpl-2.0-text", 1.0, f"{GPL_OPENING} either version 2 {GPL_REST}"),
    Template("lgpl-notice", 0.8, "gnu lesser general public license"),
    Template("agpl-notice", 0.8, "gnu affero general public license"),
    Template("bsd-opening", 0.6, BSD_GRANT),
    Template("bsd-2-clause-text", 1.0, f"{BSD_GRANT} {BSD_SOURCE} {BSD_BINARY} {BSD_DISCLAIMER}"),
    Template("bsd-3-clause-text", 1.0, f"{BSD_GRANT} {BSD_SOURCE} {BSD_BINARY} {BSD_NAMES} {BSD_DISCLAIMER}"),
    Template(
        "bsd-4-clause-text",
        1.0,
        f"{BSD_GRANT} {BSD_SOURCE} {BSD_BINARY} {BSD_ADVERTISING} {BSD_NAMES} {BSD_DISCLAIMER}",
    ),
    Template("cc-notice", 0.8, "licensed under [a] [the] [creative commons] cc by [nc] [sa] [nd] [{1-1} 0]"),
    Template("cc-notice", 0.8, "creative commons attribution [noncommercial] [sharealike] [noderivatives]"),
    Template("mpl-notice", 0.8, "mozilla public license [v] [version]"),
]

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_NOT_WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


class Automaton:
    """Templates as one automaton over words, without empty steps between states."""

    ANY = b""  # no word is empty, so this may stand for all of them

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.steps: list[dict[bytes, set[int]]] = []
        self.jumps: list[set[int]] = []
        self.accepts: dict[int, int] = {}
        self.first: dict[bytes, set[int]] = {}
        starts = []
        for number, template in enumerate(templates):
            start = self._state()
            starts.append(start)
            self.accepts[self._compile(template.text, start)] = number
        self.reach = [self._reached(i) for i in range(len(self.steps))]
        for start in starts:
            for state in self.reach[start]:
                for word, after in self.steps[state].items():
                    if word == self.ANY:
                        raise ValueError("a template must start with a mandatory word")
                    self.first.setdefault(word, set()).update(after)

    def _state(self) -> int:
        self.steps.append({})
        self.jumps.append(set())
        return len(self.steps) - 1

    def _step(self, state: int, word: bytes) -> int:
        after = self._state()
        self.steps[state].setdefault(word, set()).add(after)
        return after

    def _compile(self, text: str, state: int) -> int:
        open_at = []
        for part in re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", text):
            if part == "[":
                open_at.append(state)
            elif part == "]":
                self.jumps[open_at.pop()].add(state)
            elif part[0] == "{":
                least, most = map(int, part[1:-1].split("-"))
                skips = []
                for i in range(most):
                    if i >= least:
                        skips.append(state)
                    state = self._step(state, self.ANY)
                for skip in skips:
                    self.jumps[skip].add(state)
            else:
                state = self._step(state, part.encode())
        return state

    def _reached(self, state: int) -> list[int]:
        seen, todo = {state}, [state]
        while todo:
            new = self.jumps[todo.pop()] - seen
            seen |= new
            todo += new
        return sorted(seen)

    def matches(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(template, start) of each place where a template is accepted."""
        first = self.first
        for start, word in enumerate(words):
            if word not in first:
                continue
            found: set[int] = set()
            at, states = start + 1, first[word]
            while states:
                live = {x for state in states for x in self.reach[state]}
                found |= {self.accepts[x] for x in live if x in self.accepts}
                if at == len(words):
                    break
                word = words[at]
                states = {y for x in live for key in (word, self.ANY) for y in self.steps[x].get(key, ())}
                at += 1
            for template in sorted(found):
                yield template, start


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_NOT_WORDS).split()


RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)


def scan_licenses(
    docs: DataFrame, base: list[Template] | None = None, templates: list[Template] | None = None
) -> DataFrame:
    """The licenses that each text of ``docs`` (doc_id, text) names.

    ``base`` templates are counted at all their places (``n_base``, ``first_word``,
    ``last_word``); ``labels`` has theirs and those of ``templates``.  A license's text is
    accepted as a whole, up to the end of its disclaimer; what follows is another text.  ``score`` is the
    largest weight of what was accepted, 0 for none.  Nulls and empty texts have no
    words; a null ``doc_id`` stays null; repeated rows give repeated results.  One
    pass without a shuffle; a text is never cut.
    """
    base = BASE if base is None else base
    every = base + (TEMPLATES if templates is None else templates)
    automaton = Automaton(every)
    n = len(base)

    def one(text: str | None) -> tuple:
        words = words_of(text)
        places, labels, own, score = [], set(), set(), 0.0
        if not automaton.first.keys().isdisjoint(words):
            for template, start in automaton.matches(words):
                labels.add(every[template].label)
                score = max(score, every[template].weight)
                if template < n:
                    own.add(every[template].label)
                    places.append(start)
        low, high = (min(places), max(places)) if places else (None, None)
        return len(words), len(places), low, high, ",".join(sorted(own)), ",".join(sorted(labels)), score

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(text.as_py()) for text in batch["text"]]
            columns = list(zip(*rows)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(pa.int64()), *(pa.array(x, k) for x, k in zip(columns, kinds))],
                names=[x.split()[0] for x in RESULT.split(", ")],
            )

    with small_batches(docs.sparkSession):
        return table(docs.select("doc_id", "text").mapInArrow(scan, RESULT), "licenses")
