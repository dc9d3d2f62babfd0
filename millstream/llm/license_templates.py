"""License scan: templates with optional and replaceable regions as token automata.

A template is a line of words. ``[ ... ]`` is an optional region, ``{n}`` stands for one to
``n`` words of any kind (a name, a year). It compiles into an automaton over words whose
states are positions in the template; a text carries the template's label if somewhere
its words take the automaton from the first state to the last, so mandatory wording must
be there word for word.

A text is searched only at words that can open a template, which are found by the hashes
of all words of a chunk; the automaton then compares the words themselves. Texts are
scanned whole, in one pass without a shuffle.

Defined cases: null and empty texts have no words, no places and empty labels; overlapping
places count one by one; repeated rows get equal results; only id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import query
from .textwords import WORD, Texts, Words, map_texts, read_table, run_hashes, words_of

# The base phrases with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# The wording of public licenses, in words as the scan splits them. First notices
# that name a license, then the texts of licenses themselves, whole or (Unlicense, Boost) their
# opening paragraph, with what publishers leave out or put in as regions.
TEMPLATES = {
    "mit": [
        "released under [the terms of] the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "{6} and associated documentation files",
    ],
    "apache-2": [
        "licensed under the apache license [version] 2 0",
        "licensed under the apache license version 2 0 [the license you may not use this file "
        "except in compliance with the license]",
    ],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "licensed under the [new] [simplified] bsd [2 clause] [3 clause] license",
    ],
    "cc-by": ["licensed under [a] creative commons attribution {2} license",
              "licensed under cc by [version] 4 0"],
    "cc-by-nc": ["licensed under [a] [the] cc by nc [version] 4 0",
                 "creative commons attribution noncommercial [{3}] license"],
    "cc-by-sa": ["licensed under [a] [the] cc by sa [version] 4 0"],
    "gpl-3": ["licensed under the gnu general public license [as published by {6}] [either] "
              "version 3 [of the license] [or any later version]"],
    "lgpl-3": ["licensed under the gnu lesser general public license [either] version 3"],
    "mpl-2": ["subject to the terms of the mozilla public license [v] [version] 2 0"],
    "rights-reserved": ["copyright [c] {8} all rights reserved"],
}
_WARRANTY = (
    "the software is provided as is without warranty of any kind express or implied including "
    "but not limited to the warranties of merchantability fitness for a particular purpose "
    "[title] and noninfringement ")
_MIT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software "
    "and associated documentation files the software to deal in the software without restriction "
    "including without limitation the rights to use copy modify merge publish distribute "
    "sublicense and or sell copies of the software and to permit persons to whom the software is "
    "furnished to do so ")
_BSD_TWO = (
    "redistribution and use in source and binary forms with or without modification are "
    "permitted provided that the following conditions are met [1] [a] redistributions of source "
    "code must retain the above copyright notice this list of conditions and the following "
    "disclaimer [2] [b] redistributions in binary form must reproduce the above copyright notice "
    "this list of conditions and the following disclaimer in the documentation and or other "
    "materials provided with the distribution ")
_BSD_END = (
    "this software is provided by {12} as is and any express or implied warranties including but "
    "not limited to the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed in no event shall {12} be liable for any direct indirect incidental "
    "special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however "
    "caused and on any theory of liability whether in contract strict liability or tort including "
    "negligence or otherwise arising in any way out of the use of this software even if advised "
    "of the possibility of such damage")
TEMPLATES |= {
    "mit-text": [
        _MIT + "subject to the following conditions the above copyright notice and this "
        "permission notice [including the next paragraph] shall be included in all copies or "
        "substantial portions of the software " + _WARRANTY + "in no event shall the {6} be "
        "liable for any claim damages or other liability whether in an action of contract tort "
        "or otherwise arising from out of or in connection with the software or the use or other "
        "dealings in the software"],
    "mit-0-text": [_MIT + _WARRANTY],
    "bsd-2-text": [_BSD_TWO + _BSD_END],
    "bsd-3-text": [
        _BSD_TWO + "[3] [c] neither the name {12} nor the names of [its] [{3}] contributors may "
        "be used to endorse or promote products derived from this software without specific "
        "prior written permission " + _BSD_END],
    "isc-text": [
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted [provided that the above copyright notice and this "
        "permission notice appear in all copies] the software is provided as is and {8} "
        "disclaims all warranties with regard to this software including all implied warranties "
        "of merchantability and fitness in no event shall {8} be liable for any special direct "
        "indirect or consequential damages or any damages whatsoever resulting from loss of use "
        "data or profits whether in an action of contract negligence or other tortious action "
        "arising out of or in connection with the use or performance of this software"],
    "zlib-text": [
        "this software is provided as is without any express or implied warranty in no event "
        "will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including "
        "commercial applications and to alter it and redistribute it freely subject to the "
        "following restrictions [1] the origin of this software must not be misrepresented you "
        "must not claim that you wrote the original software if you use this software in a "
        "product an acknowledgment in the product documentation would be appreciated but is not "
        "required [2] altered source versions must be plainly marked as such and must not be "
        "misrepresented as being the original software [3] this notice may not be removed or "
        "altered from any source distribution"],
    "unlicense-text": [
        "this is free and unencumbered software released into the public domain anyone is free "
        "to copy modify publish use compile sell or distribute this software either in source "
        "code form or as a compiled binary for any purpose commercial or non commercial and by "
        "any means"],
    "boost-1-text": [
        "permission is hereby granted free of charge to any person or organization obtaining a "
        "copy of the software and accompanying documentation covered by this license the "
        "software to use reproduce display distribute execute and transmit the software and to "
        "prepare derivative works of the software and to permit third parties to whom the "
        "software is furnished to do so all subject to the following"],
    "apache-2-notice": [
        "licensed under the apache license version 2 0 the license you may not use this {3} "
        "except in compliance with the license you may obtain a copy of the license at [http] "
        "[https] www apache org licenses license 2 0 unless required by applicable law or agreed "
        "to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license "
        "for the specific language governing permissions and limitations under the license"],
    "mpl-2-notice": [
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a "
        "copy of the mpl was not distributed with this file you can obtain one at"],
    **{f"{label}-notice": [
        "you can redistribute it and or modify it under the terms of the gnu " + name + " as "
        "published by the free software foundation either version " + version + " of the license "
        "or at your option any later version [{8}] is distributed in the hope that it will be "
        "useful but without any warranty without even the implied warranty of merchantability or "
        "fitness for a particular purpose"]
       for label, name, version in [
           ("gpl-2", "general public license", "2"), ("gpl-3", "general public license", "3"),
           ("lgpl-2-1", "lesser general public license", "2 1"),
           ("lgpl-3", "lesser general public license", "3"),
           ("agpl-3", "affero general public license", "3")]},
}


class Automaton:
    """States are bits; bit ``i`` set means that the first ``i`` items are behind."""

    def __init__(self, template: str):
        self.items: list[str | None] = []  # a word, or None for any word
        skips: list[tuple[int, int]] = []  # from one state to a later one without a word
        opened: list[int] = []
        for part in template.replace("[", " [ ").replace("]", " ] ").split():
            if part == "[":
                opened.append(len(self.items))
            elif part == "]":
                skips.append((opened.pop(), len(self.items)))
            elif part.startswith("{"):
                begin, n = len(self.items), int(part[1:-1])
                self.items += [None] * n
                skips += [(begin + i, begin + n) for i in range(1, n)]
            else:
                self.items.append(part)
        if opened:
            raise ValueError(f"an optional region is not closed: {template}")
        self.last = len(self.items)
        # all states that can be reached from each one without a word
        self.reach = [1 << i for i in range(self.last + 1)]
        for begin in range(self.last, -1, -1):
            for a, b in skips:
                if a == begin:
                    self.reach[begin] |= self.reach[b]
        self.steps: dict[str | None, list[int]] = {}
        for i, item in enumerate(self.items):
            self.steps.setdefault(item, []).append(i)
        self.opening = {self.items[i] for i in range(self.last) if self.reach[0] >> i & 1}
        if None in self.opening or self.reach[0] >> self.last & 1:
            raise ValueError(f"a template begins with a word: {template}")

    def accepts(self, words) -> bool:
        """Whether some first part of ``words`` leads to the last state."""
        states = self.reach[0]
        for word in words:
            after = 0
            for key in (word, None):
                for i in self.steps.get(key, ()):
                    if states >> i & 1:
                        after |= self.reach[i + 1]
            if after >> self.last & 1:
                return True
            if not after:
                return False
            states = after
        return False


def template_regex(template: str) -> str:
    """The same as a regular expression over words that each end in a blank."""
    out = []
    for part in template.replace("[", " [ ").replace("]", " ] ").split():
        out.append({"[": "(?:", "]": ")?"}.get(part) or (
            f"(?:[^ ]+ ){{1,{part[1:-1]}}}" if part[0] == "{" else f"{part} "))
    return "".join(out)


def _hash_of(word: str) -> int:
    raw = WORD[np.frombuffer(word.encode(), np.uint8)]
    return int(run_hashes(raw, np.array([0]), np.array([len(raw)]))[0])


class Scanner:
    def __init__(self, base: dict[str, str], templates: dict[str, list[str]]):
        self.base = [(p.split(), label) for p, label in base.items()]
        self.base_hashes = [np.array([_hash_of(w) for w in p], np.uint64) for p, _ in self.base]
        self.automata = [(Automaton(t), label) for label, ts in templates.items() for t in ts]
        opening: dict[str, list] = {}
        for automaton, label in self.automata:
            for word in automaton.opening:
                opening.setdefault(word, []).append((automaton, label))
        self.opening = [(np.uint64(_hash_of(w)), w, found) for w, found in opening.items()]

    def _words(self, texts: Texts, words: Words, at: int, stop: int):
        for i in range(at, stop):
            raw = texts.data[words.starts[i]:words.ends[i]].tobytes()
            yield raw.lower().decode("utf-8", "replace")  # bytes.lower folds A-Z alone

    def scan(self, texts: Texts) -> tuple[list[dict], np.ndarray]:
        """What was found in each row, and the rows' numbers of words."""
        words = words_of(texts)
        h, first = words.hashes, words.first
        found: dict[int, dict] = {}

        def entry(row):
            return found.setdefault(row, {"places": [], "base": set(), "labels": set()})

        for (phrase, label), wanted in zip(self.base, self.base_hashes, strict=True):
            n = len(wanted)
            if len(h) < n:
                continue
            hit = h[:len(h) - n + 1] == wanted[0]
            for i in range(1, n):
                hit &= h[i:len(h) - n + 1 + i] == wanted[i]
            for at in np.flatnonzero(hit).tolist():
                row = int(np.searchsorted(first, at, "right")) - 1
                if at + n <= first[row + 1] and list(
                        self._words(texts, words, at, at + n)) == phrase:
                    entry(row)["places"].append(at - int(first[row]))
                    entry(row)["base"].add(label)
        for wanted, _, automata in self.opening:
            for at in np.flatnonzero(h == wanted).tolist():
                row = int(np.searchsorted(first, at, "right")) - 1
                for automaton, label in automata:
                    if automaton.accepts(self._words(texts, words, at, int(first[row + 1]))):
                        entry(row)["labels"].add(label)
        nothing = {"places": [], "base": set(), "labels": set()}
        return [found.get(r, nothing) for r in range(len(texts))], np.diff(first)


def scan_licenses(docs: DataFrame, keep: dict, text: str = "text",
                  base: dict[str, str] = BASE,
                  templates: dict[str, list[str]] = TEMPLATES) -> DataFrame:
    """Columns ``keep``, then n_words, n_base, first_word, last_word, base_labels, labels and
    score: 1 where a template matched, 0.5 for base phrases alone, else 0."""

    def make():
        scanner = Scanner(base, templates)

        def work(kept, texts):
            rows, n_words = scanner.scan(texts)
            return [
                n_words.astype(np.int64),
                pa.array([len(r["places"]) for r in rows], pa.int64()),
                pa.array([min(r["places"], default=None) for r in rows], pa.int64()),
                pa.array([max(r["places"], default=None) for r in rows], pa.int64()),
                pa.array([",".join(sorted(r["base"])) for r in rows], pa.string()),
                pa.array([",".join(sorted(r["base"] | r["labels"])) for r in rows], pa.string()),
                pa.array([1.0 if r["labels"] else 0.5 if r["base"] else 0.0 for r in rows],
                         pa.float64())]
        return work

    return map_texts(docs, text, keep, "n_words long, n_base long, first_word long, "
                     "last_word long, base_labels string, labels string, score double", make)


def _sql() -> str:
    places = ", ".join(
        "list_filter(range(len(w)), lambda i: w[i+1:i+{n}] = {words})".format(
            n=len(p.split()), words=str(p.split())) for p in BASE)
    bases = ", ".join(f"CASE WHEN len(p{i}) > 0 THEN '{label}' END"
                      for i, label in enumerate(BASE.values()))
    tests = ", ".join(
        "CASE WHEN regexp_matches(j, '{}') THEN '{}' END".format(
            "|".join(f"(?: {template_regex(t)})" for t in ts), label)
        for label, ts in TEMPLATES.items())
    p = [f"p{i}" for i in range(len(BASE))]
    names = ", ".join(f"ps[{i + 1}] AS {x}" for i, x in enumerate(p))
    return rf"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
a AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS j, [{places}] AS ps FROM t),
b AS (SELECT *, {names}, flatten(ps) AS found FROM a),
c AS (SELECT *, list_filter([{bases}], lambda x: x IS NOT NULL) AS bl,
             list_filter([{tests}], lambda x: x IS NOT NULL) AS tl FROM b)
SELECT doc_id, len(w) AS n_words, len(found) AS n_base, list_min(found) AS first_word,
       list_max(found) AS last_word, array_to_string(list_sort(bl), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(bl || tl)), ',') AS labels,
       CASE WHEN len(tl) > 0 THEN 1.0 WHEN len(bl) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM c"""


@query(_sql())
def op6_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"), {"doc_id": F.col("doc_id")})
