"""License scanning by template markup: templates compiled into automata over words.

A template is plain wording with ``[[...]]`` around optional regions, ``{{a-b}}`` for a replaceable region of a to
b words and ``{{x|y z}}`` for alternatives. It accepts a run of words if all its mandatory wording is there, in
order and word for word, with nothing between but what its regions allow. Beside the templates there are
plain phrases, each counted at every place.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready

# Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# The wording of common licences and notices, in parts that several of them share.
_GRANT = "{{licensed|released|distributed|available}} under the [[terms of the]]"
_MIT_OPENING = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"
_BSD_OPENING = "redistribution and use in source and binary forms with or without modification are permitted [[{{1-6}}]] provided that the following conditions are met"
_BSD_TWO = "[[{{1|a|i}}]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer [[{{2|b|ii}}]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
_BSD_NAMES = "[[{{3|c|iii}}]] neither the name of {{1-12}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"
_BSD_DISCLAIMER = "this software is provided by {{the copyright holders and contributors|the copyright holder and contributors|the regents and contributors|the authors and contributors}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall {{1-6}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
_GNU = "{{this|the}} {{1-4}} is free software you can redistribute it and or modify it under the terms of the"
_FSF = "general public license as published by the free software foundation {{either version|version}} {{1-2}} [[of the license]] [[or at your option any later version]]"
_HOPE = "[[this]] [[{{1-4}}]] is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"

# Templates and their labels. Those named opening or notice are not whole licences.
TEMPLATES = {
    "apache": "[[{{this|the}} {{1-4}} {{is|are}}]] " + _GRANT + " apache [[software]] license [[version {{1-2}}]]",
    "apache-header": "licensed under the apache license version 2 0 the license you may not use this {{1-3}} except in compliance with the license [[you may obtain a copy of the license at {{1-12}}]] unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
    "bsd-2-clause": f"{_BSD_OPENING} {_BSD_TWO} {_BSD_DISCLAIMER}",
    "bsd-3-clause": f"{_BSD_OPENING} {_BSD_TWO} {_BSD_NAMES} {_BSD_DISCLAIMER}",
    "bsd-notice": _GRANT + " [[{{2|3}} clause]] bsd [[{{2|3}} clause]] license",
    "bsd-opening": _BSD_OPENING,
    "cc-by-nc": "{{licensed|released|distributed|available}} under [[a|the]] {{cc by nc|creative commons attribution noncommercial|creative commons attribution non commercial}} [[{{sa|nd|sharealike|noderivatives}}]] [[{{1-3}} license]]",
    "cc-notice": "{{licensed|released|distributed|available}} under [[a|the]] {{cc by|creative commons attribution}} [[{{sa|nd|sharealike|noderivatives}}]] [[{{1-3}} license]]",
    "agpl-header": f"{_GNU} gnu affero {_FSF} {_HOPE} see the gnu affero general public license for more details",
    "gpl-header": f"{_GNU} gnu {_FSF} {_HOPE} see the gnu general public license for more details",
    "gpl-notice": "[[this {{1-4}} is]] " + _GRANT + " gnu general public license [[version {{1-2}}]]",
    "isc": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and {{1-4}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall {{1-4}} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
    "lgpl-header": f"{_GNU} gnu {{{{lesser|library}}}} {_FSF} {_HOPE} see the gnu {{{{lesser|library}}}} general public license for more details",
    "lgpl-notice": "[[this {{1-4}} is]] " + _GRANT + " gnu lesser general public license [[version {{1-2}}]]",
    "mit": _MIT_OPENING + " including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the {{authors or copyright holders|copyright holders}} be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit-notice": _GRANT + " {{mit|expat}} license",
    "mit-opening": _MIT_OPENING,
    "mpl-notice": "[[this {{1-4}} is]] {{licensed|released|subject}} {{under|to}} the terms of the mozilla public license [[v {{1-2}}|version {{1-2}}]]",
    "public-domain": "this is free and unencumbered software released into the public domain",
    "reserved-notice": "copyright [[c]] [[{{1-2}}]] {{1-6}} all rights reserved",
}
#: Scores of a template that stands for a whole licence, header or notice, of one that is an opening only, and of a phrase alone.
WHOLE, OPENING, PHRASE = 1.0, 0.75, 0.5

#: Keeps 0-9, a-z and every byte of a longer character; A-Z are lower-cased; all else parts words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_MARK = re.compile(r"(\[\[|\]\]|\{\{.*?\}\}|\|)")


class Automaton:
    """A nondeterministic automaton over words; state 0 starts and ``final`` accepts."""

    def __init__(self, template: str):
        self.word: list[dict[bytes, list[int]]] = []
        self.any: list[list[int]] = []
        self.free: list[list[int]] = []
        self.literals: list[list[bytes]] = [[]]
        tokens = [t for t in _MARK.split(template) if t.strip()]
        begin = self._state()
        self.final = self._alternatives(iter(tokens), begin, False)
        #: the longest run of mandatory words: every accepted text holds it
        self.anchor = max((b" " + b" ".join(x) + b" " for x in self.literals), key=len)
        self.before = self._longest_before()

    def _state(self) -> int:
        self.word.append({})
        self.any.append([])
        self.free.append([])
        return len(self.word) - 1

    def _alternatives(self, tokens: Iterator[str], begin: int, optional: bool) -> int:
        """Reads up to a closing bracket; alternatives are parted by bars."""
        end, at = self._state(), begin
        for t in tokens:
            if t == "]]":
                break
            if t == "|":
                self.free[at].append(end)
                at = begin
            elif t == "[[":
                after = self._alternatives(tokens, at, True)
                self.free[at].append(after)
                at = after
                self.literals.append([])
            elif t.startswith("{{"):
                at = self._region(t[2:-2], at)
                self.literals.append([])
            else:
                for w in t.encode().translate(_WORDS).split():
                    at = self._step(at, w)
                    if not optional:
                        self.literals[-1].append(w)
        self.free[at].append(end)
        return end

    def _region(self, inner: str, at: int) -> int:
        end = self._state()
        if span := re.fullmatch(r"(\d+)-(\d+)", inner):
            least, most = map(int, span.groups())
            for k in range(most):
                if k >= least:
                    self.free[at].append(end)
                after = self._state()
                self.any[at].append(after)
                at = after
            self.free[at].append(end)
            return end
        for choice in inner.split("|"):
            x = at
            for w in choice.encode().translate(_WORDS).split():
                x = self._step(x, w)
            self.free[x].append(end)
        return end

    def _step(self, at: int, w: bytes) -> int:
        after = self._state()
        self.word[at].setdefault(w, []).append(after)
        return after

    def _close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def _longest_before(self) -> int:
        """Words that may stand before the anchor; the automaton has no cycles."""
        n = len(self.word)
        return sum(1 for s in range(n) if self.word[s] or self.any[s])

    def accept(self, words: list[bytes], at: int) -> int:
        """End of the longest accepted run from ``at``, or -1."""
        now, found = self._close({0}), -1
        k = at
        while now:
            if self.final in now:
                found = k
            if k == len(words):
                break
            after = {s for x in now for s in self.word[x].get(words[k], ())} | {s for x in now for s in self.any[x]}
            now = self._close(after)
            k += 1
        return found


@dataclass(frozen=True)
class Scanner:
    phrases: tuple[tuple[str, str], ...] = tuple(PHRASES.items())
    templates: tuple[tuple[str, str], ...] = tuple(TEMPLATES.items())


@lru_cache(4)
def _compiled(s: Scanner) -> tuple[list[tuple[bytes, str]], list[tuple[str, Automaton]]]:
    return [(b" " + p.encode() + b" ", label) for p, label in s.phrases], [(label, Automaton(t)) for label, t in s.templates]


def places(flat: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which a padded phrase begins in words that are parted and padded by one blank."""
    out, at, seen, last = [], flat.find(phrase), 0, 0
    while at >= 0:
        seen += flat.count(b" ", last, at)
        last = at
        out.append(seen)
        at = flat.find(phrase, at + 1)
    return out


def scan(text: str | None, s: Scanner = Scanner()) -> tuple:
    """``n_words, n_base, first_word, last_word, base_labels, labels, n_templates, matched_words, score``"""
    phrases, templates = _compiled(s)
    words = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()
    flat = b" " + b" ".join(words) + b" "
    at, base = [], set()
    for phrase, label in phrases:
        if found := places(flat, phrase):
            at += found
            base.add(label)
    spans, accepted = set(), set()
    for label, automaton in templates:
        tried: set[int] = set()
        done = 0
        for p in places(flat, automaton.anchor):
            for start in range(max(done, p - automaton.before), p + 1):
                if start not in tried:
                    tried.add(start)
                    if (end := automaton.accept(words, start)) > p:
                        spans.add((start, end))
                        accepted.add(label)
                        done = end
                        break
    covered = sum(1 for _ in {k for a, b in spans for k in range(a, b)})
    whole = any(not x.endswith("-opening") for x in accepted)
    score = WHOLE if whole else OPENING if accepted else PHRASE if at else 0.0
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | accepted)), len(spans), covered, score


_FIELDS = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("n_templates", pa.int64()), ("matched_words", pa.int64()), ("score", pa.float64())]


def _scan(s: Scanner, id_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scan(t, s) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), *(pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(_FIELDS))], [id_col, *(n for n, _ in _FIELDS)])

    return run


def scan_licenses(docs: DataFrame, scanner: Scanner = Scanner(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for every row of ``docs``: the id and what ``scan`` finds in its whole text.

    ``n_base`` counts all places of all phrases; ``first_word`` and ``last_word`` are the smallest and largest
    word numbers at which one begins, null if there is none. ``labels`` are those of the phrases and of the
    accepted templates. ``score`` is 1 if a template accepts that stands for a whole licence, header or notice, 0.75 if only
    the opening of a licence is there (whatever follows it departs from the licence), 0.5 if only a phrase stands, else 0.
    A null or blank text has no words and nothing found. Repeated rows give equal rows, an empty table none; several
    templates may accept the same words, and all labels stand. Other columns are not read.
    """
    ready(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    names = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    schema = ", ".join([f"`{id_col}` {kind}", *(f"{n} {names[t]}" for n, t in _FIELDS)])
    return docs.select(F.col(id_col), F.col(text_col).alias("text" if id_col != "text" else "text_")).mapInArrow(_scan(scanner, id_col), schema)
