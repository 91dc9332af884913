"""License scans: fixed phrases, and license templates with markup as token automata.

Words are the runs of lower-case letters, digits and non-ASCII characters after
A-Z is lower-cased. Phrases are found where their words stand consecutively.
A template is text with four kinds of regions, ``<<optional>> .. <</optional>>``
(may be absent), ``<<any N>>`` (up to N words of any kind), ``<<any>>`` (any
number of words, up to the next mandatory ones) and ``<<of a b ..>>`` (any number of
the words listed). It is compiled to an automaton
over words: one state for each word, a way around each optional region, a counted
loop for each replaceable one with a number, a free one for those without and one over
the listed words. A template's label is given
where the automaton reaches its end, that is, where all mandatory words stand
exactly and in order.

Words are compared by 64-bit hashes computed for whole slices at once; a hit of
a phrase or of a template's first words is then compared word by word in bytes.
Scanning needs no exchange.

Edge cases: a null text is empty: no words, no labels, score 0. Texts are scanned
whole, however long. Repeated rows get equal results; findings at the same word are
ordered by label. The result holds the id and the scan's own columns only: other
columns do not pass through, so their names cannot clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import SYMBOLS, Words, slices

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wordings of licences.
_MIT = """permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
    files the software to deal in the software without restriction including without limitation the rights to use copy modify
    merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
    furnished to do so subject to the following conditions the above copyright notice and this permission notice
    <<optional>>including the next paragraph<</optional>> shall be included in all copies or substantial portions of the software
    the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of
    merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be
    liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in
    connection with the software or the use or other dealings in the software"""
_ISC = """permission to use copy modify <<optional>>and or<</optional>> <<optional>>and<</optional>> distribute this software for any
    purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all
    copies the software is provided as is and <<any>> disclaims all warranties with regard to this software including all implied
    warranties of merchantability and fitness in no event shall <<any>> be liable for any special direct indirect or consequential
    damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or
    other tortious action arising out of or in connection with the use or performance of this software"""

_BSD_CONDITIONS = """redistribution and use in source and binary forms with or without modification are permitted provided that the following
    conditions are met <<of 1 a i>> redistributions of source code must retain the above copyright notice this list of conditions and the
    following disclaimer <<of 2 b ii and>> redistributions in binary form must reproduce the above copyright notice this list of conditions
    and the following disclaimer in the documentation and or other materials provided with the distribution"""
_BSD_ENDORSEMENT = """<<of 3 c iii>> neither the name of <<any>> may be used to endorse or promote products derived from this software
    without specific prior written permission"""
_BSD_DISCLAIMER = """this software is provided by <<any>> as is and any express or implied warranties including but not limited to the implied
    warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall <<any>> be liable for any direct
    indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services
    loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability
    or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such
    damage"""
_ZLIB = """this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
    damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial
    applications and to alter it and redistribute it freely subject to the following restrictions <<of 1>> the origin of this software must
    not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment
    in the product documentation would be appreciated but is not required <<of 2>> altered source versions must be plainly marked as such
    and must not be misrepresented as being the original software <<of 3>> this notice may not be removed or altered from any source
    distribution"""
_UNLICENSE = """this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile
    sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by
    any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest
    in the software to the public domain we make this dedication for the benefit of the public at large and to the detriment of our heirs
    and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
    software under copyright law the software is provided as is without warranty of any kind express or implied including but not limited to
    the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors be liable for any
    claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the
    software or the use or other dealings in the software"""
_GPL_3 = """this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as
    published by the free software foundation either version 3 of the license or at your option any later version this program is
    distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness
    for a particular purpose see the gnu general public license for more details you should have received a copy of the gnu general public
    license along with this program if not see <<of http https www gnu org licenses>>"""
_APACHE_2 = """licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you
    may obtain a copy of the license at <<any>> unless required by applicable law or agreed to in writing software distributed under the
    license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the
    specific language governing permissions and limitations under the license"""
_MPL_2 = """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with
    this file you can obtain one at <<of http https www mozilla org>> mpl 2 0"""

#: Notices that licences ask to be put into files or begin with, and the whole wording of short licences, with their
#: replaceable regions. The labels ``..-notice`` say that the opening stands there, whatever follows it;
#: ``..-whole`` the whole licence, ``..-header`` the whole notice that a longer licence asks for.
TEMPLATES = {
    "apache-2.0-notice": """<<optional>>licensed under the apache license version 2 0 the license<</optional>>
        you may not use this file except in compliance with the license
        <<optional>>you may obtain a copy of the license at <<any>><</optional>>
        unless required by applicable law or agreed to in writing""",
    "gpl-notice": """this program is free software you can redistribute it and or modify it under the terms of the
        gnu <<optional>>lesser<</optional>> <<optional>>affero<</optional>> general public license as published by
        the free software foundation <<optional>>either<</optional>> version <<any 2>> of the license
        <<optional>>or at your option any later version<</optional>>""",
    "mit-notice": """permission is hereby granted free of charge to any person obtaining a copy of this software
        and associated documentation files <<optional>>the software<</optional>> to deal in the software without restriction""",
    "bsd-notice": """redistribution and use in source and binary forms with or without modification are permitted
        provided that the following conditions are met""",
    "isc-notice": """permission to use copy modify <<optional>>and or<</optional>> <<optional>>and<</optional>> distribute this
        software for any purpose with or without fee is hereby granted""",
    "cc-notice": """licensed under a creative commons attribution <<of noncommercial non commercial sharealike share alike noderivatives
        noderivs no derivatives derivs cc by nc sa nd 1 2 3 4 0 5>> international license""",
    "spdx": """spdx license identifier <<any 1>>""",
    "mit-whole": _MIT,
    "isc-whole": _ISC,
    "bsd-2-whole": f"{_BSD_CONDITIONS} {_BSD_DISCLAIMER}",
    "bsd-3-whole": f"{_BSD_CONDITIONS} {_BSD_ENDORSEMENT} {_BSD_DISCLAIMER}",
    "zlib-whole": _ZLIB,
    "unlicense-whole": _UNLICENSE,
    "gpl-3.0-header": _GPL_3,
    "apache-2.0-header": _APACHE_2,
    "mpl-2.0-header": _MPL_2,
}

_MARK = re.compile(r"<<[^>]*>>|[^\s<]+")


class Automaton:
    """States 0 .. n over words; ``run`` says whether the end is reached from a place."""

    def __init__(self, template: str):
        self.word: list[bytes | None] = []  # what leads from a state to the next; None: any word
        self.skip: dict[int, list[int]] = {}  # states that are reached without a word
        self.loops: set[int] = set()  # states that stay with any word
        self.listed: dict[int, set[bytes]] = {}  # states that stay with these words
        opened: list[int] = []
        for mark in _MARK.findall(template):
            if mark == "<<optional>>":
                opened.append(len(self.word))
            elif mark == "<</optional>>":
                self.skip.setdefault(opened.pop(), []).append(len(self.word))
            elif mark == "<<any>>" or mark.startswith("<<of"):  # a state of its own, so that a way around an optional region does not loop
                self.skip.setdefault(len(self.word), []).append(len(self.word) + 1)
                if mark == "<<any>>":
                    self.loops.add(len(self.word))
                else:
                    self.listed[len(self.word)] = set(mark[4:-2].encode().split())
                self.word.append(b"")  # no word is empty, so it is left without one
            elif mark.startswith("<<any "):
                first, n = len(self.word), int(mark[6:-2])
                self.word += [None] * n
                for k in range(n):
                    self.skip.setdefault(first + k, []).append(first + n)
            elif mark.startswith("<<"):
                raise ValueError(f"no region of a template: {mark}")
            else:
                self.word.append(mark.encode())
        self.end = len(self.word)
        first = self.closure({0})
        self.starts = {self.word[s] for s in first if s < self.end}.union(*[self.listed[s] for s in first & self.listed.keys()])

        self.prefix = []  # the words that every match begins with
        while len(self.prefix) < min(4, self.end) and self.word[len(self.prefix)] and len(self.prefix) not in self.skip:
            self.prefix.append(self.word[len(self.prefix)])

    def closure(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skip.get(todo.pop(), ()):
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def run(self, words, at: int, stop: int, dead: dict[int, int] | None = None) -> int | None:
        """Where the shortest match that begins at ``at`` ends, or None.

        ``dead`` collects loops and the places from which they went on to ``stop``
        in vain; a later run over the same words leaves them there.
        """
        dead = {} if dead is None else dead
        since: dict[int, int] = {}
        states = self.closure({0})
        while states:
            if self.end in states:
                return at
            loops = states & self.loops
            for s in loops:
                since.setdefault(s, at)
            if at >= stop:
                for s in loops:
                    dead[s] = min(since[s], dead.get(s, stop))
                return None
            w = words(at)
            after = {s + 1 for s in states if s < self.end and self.word[s] in (None, w)}
            stay = {s for s in loops if at < dead.get(s, stop)} | {s for s in states & self.listed.keys() if w in self.listed[s]}
            states = self.closure(after | stay)
            at += 1
        return None


def _hashes(words: list[bytes]) -> np.ndarray:
    """Hashes as ``Words`` gives them; each word here must be whole."""
    return Words(pa.array([b" ".join(words).decode()]), breaks=SYMBOLS).hashes()


def _places(hashes: np.ndarray, wanted: np.ndarray) -> list[int]:
    """Where the wanted hashes stand one after another."""
    hit = np.ones(max(len(hashes) - len(wanted) + 1, 0), dtype=bool)
    for k, w in enumerate(wanted):
        hit &= hashes[k:k + len(hit)] == w
    return np.flatnonzero(hit).tolist()


def scan_licenses(docs: DataFrame, phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans.

    ``spans`` lists each match as (label, first word, words). The score is 0
    without a match, 0.5 with phrases alone and 1 with a whole template, be it a
    notice, the opening of a licence (labels ``..-notice``) or a whole licence.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    schema = (f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words bigint, n_base bigint, "
              "first_word bigint, last_word bigint, base_labels string, labels string, score double, "
              "spans array<struct<label: string, first_word: bigint, words: bigint>>")
    span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))

    def scan(batches):
        automata = [(label, Automaton(t)) for label, t in templates.items()]
        wanted = [(label, p.encode().split()) for p, label in phrases.items()]
        keys = [_hashes(p) for _, p in wanted]
        # a template may begin where its first words stand, up to four, or one of those that may come first
        begins = [(label, a, _hashes(a.prefix or sorted(a.starts))) for label, a in automata]
        for b in batches:
            for s in slices(b, text_col):
                words = Words(s.column(text_col), lower=True, breaks=SYMBOLS)
                h = words.hashes()
                word = lambda i: words.data[words.start[i]:words.end[i]].tobytes()  # noqa: E731, B023
                found: list[list] = [[] for _ in range(s.num_rows)]
                base: list[list] = [[] for _ in range(s.num_rows)]
                for (label, parts), key in zip(wanted, keys):
                    m = len(parts)
                    for i in _places(h, key):
                        d = words.doc[i]
                        if d == words.doc[i + m - 1] and all(word(i + k) == parts[k] for k in range(m)):
                            base[d].append((label, i - int(words.first[d]), m))
                for label, a, first in begins:
                    dead: dict[int, dict[int, int]] = {}
                    for i in _places(h, first) if a.prefix else np.flatnonzero(np.isin(h, first)).tolist():
                        d = words.doc[i]
                        end = a.run(word, i, int(words.first[d + 1]), dead.setdefault(d, {}))
                        if end is not None:
                            found[d].append((label, i - int(words.first[d]), end - i))
                names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
                rows = {k: [] for k in names}
                for d in range(s.num_rows):
                    at = [x[1] for x in base[d]]
                    values = (int(words.count[d]), len(at), min(at, default=None), max(at, default=None),
                              ",".join(sorted({x[0] for x in base[d]})),
                              ",".join(sorted({x[0] for x in base[d] + found[d]})),
                              1.0 if found[d] else 0.5 if at else 0.0,
                              [dict(zip(("label", "first_word", "words"), x)) for x in sorted(base[d] + found[d], key=lambda x: (x[1], x[0]))])
                    for k, v in zip(names, values):
                        rows[k].append(v)
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), span]
                yield pa.RecordBatch.from_arrays([s.column(0)] + [pa.array(rows[k], t) for k, t in zip(names, kinds)],
                                                 names=[id_col, *names])

    return docs.select(id_col, text_col).mapInArrow(scan, schema)
