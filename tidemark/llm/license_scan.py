"""Licence scan: phrases, and templates with optional and replaceable regions.

A template is licence wording with markup: `[[ ... ]]` is optional, `{name:a-b}` stands for a to b words of any
kind (a holder, a year), `{a|b}` for one of some wordings. Each is compiled into an automaton over words. A text
is accepted where the mandatory words stand one after the other exactly, with optional regions present or not and
replaceable ones of allowed size; a changed, missing or extra mandatory word means no match. A match adds the
template's label, so a notice counts under the method only when its wording is whole. Labels that end in `text` stand
for a licence's whole wording, those in `notice` for words that name a licence. The words that can start a
template are known, so an automaton runs only where one of them stands.

Words are runs of ASCII digits, letters in lower case and characters beyond ASCII. A null text counts as empty:
no words, no places, empty labels, score 0. Phrases and templates may overlap; every place counts. Repeated rows
each return, those of null id too. An empty table gives an empty result. Texts are read whole, whatever their length.
Columns other than doc_id and text are not read, whatever their names. The score is the share of a text's words that
stand in phrases or template matches.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import DataFrame

from .base import prepare

# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of public licences and of notices that name them.
TEMPLATES = {
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this {software|font} [[and associated documentation files]] the software "
        "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software "
        "and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice "
        "[[including the next paragraph]] shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the {authors or copyright holders|copyright holders|authors} be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
        "arising from out of or in connection with the software or the use or other dealings in the software"
    ),
    "isc-text": (
        "permission to use copy modify and {or|} distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice "
        "and this permission notice appear in all copies "
        "the software is provided as is and {the author disclaims|holder disclaims|isc disclaims|the authors disclaim} all warranties with regard to this software including all implied warranties of merchantability and fitness "
        "in no event shall {the author|the authors|isc} be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"
    ),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "[[{1|a}]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
        "[[{2|b}]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer "
        "in the documentation and or other materials provided with the distribution "
        "[[[[{3|c}]] neither the name of {holder:1-10} nor the names of {its|their|the} contributors may be used to endorse or promote products derived from this software without specific prior written permission]] "
        "this software is provided by the copyright {holders|holder} and contributors as is and any express or implied warranties including but not limited to "
        "the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright {holder|holders|owner} or contributors be liable for any direct indirect incidental special exemplary or consequential damages "
        "including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort "
        "including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"
    ),
    "apache-notice": (
        "licensed under the apache license version 2 0 the license you may not use this {file|software|work} except in compliance with the license you may obtain a copy of the license at {http|https} www apache org licenses license 2 0 "
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied "
        "see the license for the specific language governing permissions and limitations under the license"
    ),
    "apache-short-notice": "licensed under the apache license version 2 0 [[the license]]",
    "mit-notice": "{released|licensed|distributed} under the [[terms of the]] mit license",
    "gpl-notice": "licensed under the [[terms of the]] gnu [[{lesser|affero}]] general public license version {2|3} [[{or later|only}]]",
    "gpl-notice-text": (
        "is free software you can redistribute it and or modify it under the terms of the gnu [[{lesser|affero}]] general public license as published by the free software foundation "
        "either version {2|3} of the license or at your option any later version {this program is|this library is|this software is|it is} distributed in the hope that it will be useful "
        "but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu [[{lesser|affero}]] general public license for more details"
    ),
    "cc-by-notice": "licensed under [[a]] {cc by|creative commons attribution} {4 0|3 0}",
    "cc-by-nc-notice": "licensed under [[a]] {cc by nc|creative commons attribution noncommercial} {4 0|3 0}",
    "cc-by-sa-notice": "licensed under [[a]] {cc by sa|creative commons attribution sharealike} {4 0|3 0}",
    "rights-reserved": "copyright [[c]] {year:1-3} {holder:1-6} all rights reserved",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at {http|https} mozilla org mpl 2 0",
    "unlicense-text": (
        "this is free and unencumbered software released into the public domain "
        "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means "
        "in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public domain "
        "we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors "
        "we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
        "in no event shall the authors be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
        "arising from out of or in connection with the software or the use or other dealings in the software [[for more information please refer to {http|https} unlicense org]]"
    ),
}

# Fixed value: bytes of a word (digits, letters, anything beyond ASCII); capitals fall to small letters, the rest to spaces.
_FOLD = bytes(b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
_MARKUP = re.compile(r"\[\[|\]\]|\{[^}]*\}|[^\s\[\]{}]+")


class Automaton:
    """A template as a set-of-states automaton: edges (word or None for any) and free moves."""

    def __init__(self, template: str):
        self.edges: list[dict[bytes | None, list[int]]] = [{}]
        self.free: list[list[int]] = [[]]
        opened: list[int] = []
        at = 0
        for x in _MARKUP.findall(template):
            if x == "[[":
                opened.append(at)
            elif x == "]]":
                start, end = opened.pop(), self._state()
                self.free[at].append(end)
                self.free[start].append(end)
                at = end
            elif x[0] == "{" and ":" in x:
                low, high = map(int, x[1:-1].split(":")[1].split("-"))
                end = self._state()
                for k in range(high):
                    if k >= low:
                        self.free[at].append(end)
                    at = self._word(at, None)
                self.free[at].append(end)
                at = end
            elif x[0] == "{":
                end = self._state()
                for choice in x[1:-1].split("|"):
                    here = at
                    for w in choice.split():
                        here = self._word(here, w.encode())
                    self.free[here].append(end)
                at = end
            else:
                at = self._word(at, x.encode())
        self.end = at
        self.starts = {w for s in self._closure({0}) for w in self.edges[s]}
        if opened or None in self.starts or at in self._closure({0}):
            raise ValueError(f"a template starts with a known word and closes its regions: {template[:60]}")

    def _state(self) -> int:
        self.edges.append({})
        self.free.append([])
        return len(self.edges) - 1

    def _word(self, at: int, word: bytes | None) -> int:
        new = self._state()
        self.edges[at].setdefault(word, []).append(new)
        return new

    def _closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def match(self, words: list[bytes], at: int) -> int:
        """Words of the longest match that starts at a word; 0 where there is none."""
        states, found = self._closure({0}), 0
        for n in range(at, len(words)):
            states = self._closure({t for s in states for t in (*self.edges[s].get(words[n], ()), *self.edges[s].get(None, ()))})
            if not states:
                break
            if self.end in states:
                found = n + 1 - at
        return found


@functools.cache
def compiled() -> tuple[tuple[str, Automaton], ...]:
    return tuple((k, Automaton(t)) for k, t in TEMPLATES.items())


@functools.cache
def _tables():
    phrases = [(p.encode().split(), label) for p, label in PHRASES.items()]
    starts: dict[bytes, list[tuple[str, Automaton]]] = {}
    for k, a in compiled():
        for w in a.starts:
            starts.setdefault(w, []).append((k, a))
    return phrases, starts


def scan(text: str | None) -> tuple[int, list[tuple[int, int, str, bool]]]:
    """n_words, and places (first word, words, label, from a phrase) in a whole text."""
    words = (text or "").encode().translate(_FOLD).split()
    phrases, starts = _tables()
    present = set(words)
    found = []
    for phrase, label in phrases:
        if present.issuperset(phrase):
            i, n = -1, len(phrase)
            with_first = phrase[0]
            for _ in range(words.count(with_first)):
                i = words.index(with_first, i + 1)
                if words[i : i + n] == phrase:
                    found.append((i, n, label, True))
    for w in present.intersection(starts):
        i = -1
        for _ in range(words.count(w)):
            i = words.index(w, i + 1)
            for label, a in starts[w]:
                if n := a.match(words, i):
                    found.append((i, n, label, False))
    return len(words), sorted(found)


def license_scan(docs: DataFrame) -> DataFrame:
    """A row for each document: counts, first and last place of a phrase, labels, score, and the method's places."""
    prepare(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())]))]
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "matches"]
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                n, found = scan(t)
                base = [x for x in found if x[3]]
                covered: set[int] = set()
                for i, k, _, _ in found:
                    covered.update(range(i, i + k))
                rows.append((n, len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted({x[2] for x in base})), ",".join(sorted({x[2] for x in found})), len(covered) / n if n else 0.0, [{"label": x[2], "first_word": x[0], "n_words": x[1]} for x in found if not x[3]]))
            cols = zip(*rows) if rows else [()] * 8
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<label:string,first_word:long,n_words:long>>")
