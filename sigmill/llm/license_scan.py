"""License scan by template markup.

A template is a line of words with regions:

* ``[[ ... ]]`` is optional,
* ``{{n}}`` is replaceable: any 0 to n words may stand there,
* all other words are mandatory and must stand exactly as written, in order.

Each template is compiled into a token automaton (one state per position, with bypasses for the
optional regions), and one left-to-right pass over a text's words runs all automata at once. A text
gets a template's label if some run of its words is accepted.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import lower_ascii, text_chunks, word_bounds

# Phrases whose places are counted, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

_WARRANTY = (
    "software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement "
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with "
    "the software or the use or other dealings in the software"
)
_BSD_HEAD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    "[[1]] redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer "
    "[[2]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"
)
_BSD_TAIL = (
    "this software is provided by {{8}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed "
    "in no event shall {{12}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data "
    "or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this "
    "software even if advised of the possibility of such damage"
)

# Label and markup of each template: whole licenses first, then notices; the wording is that of the public license texts.
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including "
        "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to "
        "the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software the " + _WARRANTY,
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all "
        "copies the software is provided as is and {{6}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall {{6}} be liable "
        "for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action "
        "arising out of or in connection with the use or performance of this software",
    ),
    ("bsd-2-clause", f"{_BSD_HEAD} {_BSD_TAIL}"),
    (
        "bsd-3-clause",
        f"{_BSD_HEAD} [[3]] neither the name of {{{{12}}}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission {_BSD_TAIL}",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to "
        "anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this software must "
        "not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not "
        "required 2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled "
        "binary for any purpose commercial or non commercial and by any means",
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at {{12}} unless required by applicable "
        "law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the "
        "specific language governing permissions and limitations under the license",
    ),
    ("apache-2.0", "licensed under the apache license [[version]] 2 0 [[the license]]"),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software {{12}} to deal in the software without restriction"),
    ("mit-notice", "[[this {{4}} is]] released under the mit license"),
    ("mit-notice", "licensed under the mit license"),
    ("gpl-3.0", "licensed under the [[terms of the]] gnu general public license [[as published by the free software foundation]] [[either]] version 3"),
    ("gpl-2.0", "licensed under the [[terms of the]] gnu general public license [[as published by the free software foundation]] [[either]] version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("cc-by-nc-4.0", "licensed under [[a]] cc by nc 4 0"),
    ("cc-by-nc-4.0", "licensed under [[a]] creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa-4.0", "licensed under [[a]] cc by sa 4 0"),
    ("cc-by-4.0", "licensed under [[a]] cc by 4 0"),
    ("cc-by-4.0", "licensed under [[a]] creative commons attribution 4 0 international license"),
    ("cc0-1.0", "[[released {{4}} under]] cc0 1 0 [[universal]]"),
    ("all-rights-reserved", "copyright {{8}} all rights reserved"),
)

_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


class TokenAutomaton:
    """All templates in one nondeterministic automaton; states are numbered through all of them."""

    def __init__(self, templates: Iterable[tuple[str, str]]):
        self.on_word: dict[str, dict[int, list[int]]] = {}  # word -> from -> to
        self.on_any: dict[int, int] = {}  # state -> state, for replaceable words
        self.skips: dict[int, list[int]] = {}  # moves that read nothing
        self.accepts: dict[int, str] = {}
        self._n = 0
        starts = []
        for label, markup in templates:
            start = self._state()
            starts.append(start)
            self.accepts[self._compile(markup, start)] = label
        self.start = frozenset(x for s in starts for x in self._closure({s}))
        self.begins = {word: {to for a in moves.keys() & self.start for to in moves[a]} for word, moves in self.on_word.items()}
        self.first_words = {word.encode() for word, to in self.begins.items() if to}

    def _state(self) -> int:
        self._n += 1
        return self._n - 1

    def _compile(self, markup: str, at: int) -> int:
        open_at: list[int] = []
        for token in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\s\[\]{}]+", markup):
            if token == "[[":
                open_at.append(at)
            elif token == "]]":
                end = self._state()
                self.skips.setdefault(at, []).append(end)
                self.skips.setdefault(open_at.pop(), []).append(end)
                at = end
            elif token.startswith("{{"):
                end = self._state()
                for _ in range(int(token[2:-2])):
                    self.skips.setdefault(at, []).append(end)
                    to = self._state()
                    self.on_any[at] = to
                    at = to
                self.skips.setdefault(at, []).append(end)
                at = end
            else:
                to = self._state()
                self.on_word.setdefault(token, {}).setdefault(at, []).append(to)
                at = to
        if open_at:
            raise ValueError(f"an optional region is not closed: {markup}")
        return at

    def _closure(self, states: set[int]) -> set[int]:
        todo, found = list(states), set(states)
        while todo:
            for x in self.skips.get(todo.pop(), ()):
                if x not in found:
                    found.add(x)
                    todo.append(x)
        return found

    def labels(self, words: Iterable[str]) -> set[str]:
        found: set[str] = set()
        active: set[int] = set()
        for word in words:
            moves = self.on_word.get(word)
            if not moves and not active:
                continue
            after = set(self.begins[word]) if moves else set()
            if moves and active:
                after.update(to for a in active if a in moves for to in moves[a])
            after.update(self.on_any[a] for a in active if a in self.on_any)
            active = self._closure(after)
            found.update(self.accepts[a] for a in active if a in self.accepts)
        return found


def scan_texts(column: pa.Array, automaton: TokenAutomaton) -> Iterator[tuple]:
    """For each text the values of SCHEMA."""
    phrases = [(p.split(), label) for p, label in BASE_PHRASES.items()]
    # A text without any of these cannot be accepted or hold a place: its words are only counted.
    needed = {p[0][-1].encode() for p in phrases} | automaton.first_words
    needed = re.compile(b"|".join(sorted(map(re.escape, needed))))
    for i, j, data, offsets in text_chunks(column):
        data = lower_ascii(data)
        starts, ends, first = word_bounds(_WORD[data], offsets)
        raw = data.tobytes()
        for k in range(j - i):
            a, b = int(first[k]), int(first[k + 1])
            if not needed.search(raw, int(offsets[k]), int(offsets[k + 1])):
                yield b - a, 0, None, None, "", "", 0.0
                continue
            words = [raw[s:e].decode("utf-8", "surrogateescape") for s, e in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)]
            at: list[int] = []
            base: set[str] = set()
            for phrase, label in phrases:
                last, n = phrase[-1], len(phrase)
                hits = [x - n + 1 for x, w in enumerate(words) if w == last and x >= n - 1 and words[x - n + 1 : x + 1] == phrase]
                if hits:
                    at += hits
                    base.add(label)
            matched = automaton.labels(words)
            yield (
                b - a, len(at), min(at, default=None), max(at, default=None),
                ",".join(sorted(base)), ",".join(sorted(base | matched)), 1.0 if matched else 0.5 if base else 0.0,
            )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: tuple = TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: id, number of words, places of the base phrases, labels, score.

    The score is 1 if a template is accepted, 0.5 if only base phrases stand in the text, else 0.
    Null and empty texts have no words, no labels, score 0 and null places; repeated rows and null
    ids stay, one result each, equal texts equal results; very long texts are read whole; an empty table
    gives an empty result; other columns are not read, whatever their names.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = TokenAutomaton(templates)
        for batch in batches:
            rows = list(scan_texts(batch.column(1), automaton))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"id {kind}, {SCHEMA}")
    return out.withColumnRenamed("id", id_col)
