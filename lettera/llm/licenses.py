"""License scan by template-markup matching.

A template is wording with marked regions: ``[[...]]`` may be absent, ``{{n}}`` stands for one to
n words of any kind, and everything else must be there word for word.  Templates are compiled
into one automaton over words.  A text is accepted by a template at a place where its mandatory
wording stands exactly; the automaton is entered only at words that can begin a template.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettera.llm.common import map_batches, text_of, texts

#: Fixed values of the base: phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: The whole wording of short public licenses, with what may be left out or replaced.
#: A clause that is added, changed or cut off is no match.
MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this {{3}} and associated
documentation files (the {{3}}), to deal in the {{3}} without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the {{3}}, and to
permit persons to whom the {{3}} is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice [[(including the next paragraph)]] shall be included in
all copies or substantial portions of the {{3}}.
THE {{3}} IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
[[THE]] {{8}} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE {{3}} OR THE USE OR OTHER DEALINGS IN THE {{1}}
"""
ISC = """
Permission to use, copy, modify, and[[/or]] distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND {{8}} DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL {{8}} BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE
"""
BSD_TERMS = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
[[1]] [[a]] Redistributions of source code must retain the above copyright notice, this list of conditions and
the following disclaimer.
[[2]] [[b]] Redistributions in binary form must reproduce the above copyright notice, this list of conditions and
the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_NAMES = """
[[3]] [[c]] Neither the name of {{12}} nor the names of [[its]] [[other]] contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""
BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY {{12}} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
{{12}} BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING,
BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT
(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE
"""
UNLICENSE = """
This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code
form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the public at
large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of
relinquishment in perpetuity of all present and future rights to this software under copyright law.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE
[[For more information, please refer to <http{{5}}>]]
"""
#: Labels and their templates: whole licenses, their opening clauses, usual notices.
TEMPLATES = [
    ("mit-text", MIT), ("isc-text", ISC), ("bsd-2-clause", BSD_TERMS + BSD_DISCLAIMER),
    ("bsd-3-clause", BSD_TERMS + BSD_NAMES + BSD_DISCLAIMER), ("unlicense-text", UNLICENSE),
    ("mit-notice", "released [[or distributed]] under the [[terms of the]] mit license"),
    ("mit-notice", "licensed under the [[terms of the]] mit license"),
    ("mit-opening", "permission is hereby granted free of charge to any person obtaining a copy of this "
                    "{{3}} and associated documentation files"),
    ("apache-2.0", "licensed under the [[terms of the]] apache license [[version]] 2 [[0]]"),
    ("apache-2.0", "apache license version 2 0 [[january 2004]]"),
    ("gpl-3.0", "licensed under the [[terms of the]] gnu general public license [[as published by the "
                "free software foundation]] [[either]] version 3 [[of the license]] [[or any later version]]"),
    ("gpl-2.0", "licensed under the [[terms of the]] gnu general public license [[as published by the "
                "free software foundation]] [[either]] version 2 [[of the license]] [[or any later version]]"),
    ("gpl-notice", "is free software you can redistribute it and or modify it under the terms of the gnu "
                   "[[lesser]] general public license"),
    ("lgpl", "gnu lesser general public license [[version {{2}}]]"),
    ("cc-by-nc", "licensed under [[a]] [[creative commons]] cc by nc [[sa]] [[nd]] {{2}}"),
    ("cc-by-sa", "licensed under [[a]] [[creative commons]] cc by sa {{2}}"),
    ("cc-by-version", "licensed under [[a]] [[creative commons]] cc by 4 0"),
    ("cc-text", "creative commons attribution [[noncommercial]] [[sharealike]] [[noderivatives]] {{2}} "
                "[[international]] license"),
    ("bsd-opening", "redistribution and use in source and binary forms with or without modification are "
                    "permitted provided that the following conditions are met"),
    ("isc-opening", "permission to use copy modify and [[or]] distribute this software for any purpose with or "
                    "without fee is hereby granted"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense-opening", "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", "all rights reserved"),
    ("copyright-notice", "copyright [[c]] {{1}} [[by]] {{4}} all rights reserved"),
]
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
_MARK = re.compile(r"\[\[|\]\]|\{\{(\d+)\}\}|[^\s\[\]{}]+")


def words_of(text: str) -> list[str]:
    """Words of a whole text after A-Z became a-z."""
    return WORD.findall(text.translate(_LOWER))


@dataclass
class Automaton:
    """Word transitions, transitions on any word, free moves, and labels of final states."""

    on_word: list[dict[str, list[int]]] = field(default_factory=list)
    on_any: list[list[int]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)
    labels: dict[int, list[str]] = field(default_factory=dict)
    starts: dict[str, list[int]] = field(default_factory=dict)

    def state(self) -> int:
        self.on_word.append({}), self.on_any.append([]), self.free.append([])
        return len(self.on_word) - 1

    def add(self, label: str, template: str) -> None:
        first = at = self.state()
        opened: list[int] = []
        for mark in _MARK.finditer(template):
            token = mark.group()
            if token == "[[":
                opened.append(at)
            elif token == "]]":
                begin, nxt = opened.pop(), self.state()
                self.free[at].append(nxt), self.free[begin].append(nxt)
                at = nxt
            elif mark.group(1):
                end, here = self.state(), at
                for _ in range(int(mark.group(1))):
                    nxt = self.state()
                    self.on_any[here].append(nxt), self.free[nxt].append(end)
                    here = nxt
                at = end
            else:
                for word in words_of(token):
                    nxt = self.state()
                    self.on_word[at].setdefault(word, []).append(nxt)
                    at = nxt
        if opened:
            raise ValueError(f"an optional region stays open: {template}")
        self.labels.setdefault(at, []).append(label)
        for s in self.closure([first]):
            if self.on_any[s] or s in self.labels:
                raise ValueError(f"a template must begin with wording: {template}")
            for word in self.on_word[s]:
                self.starts.setdefault(word, []).append(first)

    def closure(self, states) -> set[int]:
        out, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in out:
                    out.add(s), todo.append(s)
        return out

    def run(self, words: list[str], at: int) -> dict[str, int]:
        """Labels of the templates accepted from word ``at`` on, with their longest end."""
        found: dict[str, int] = {}
        states = self.closure(set(self.starts.get(words[at], ())))
        while states and at < len(words):
            word, nxt = words[at], set()
            for s in states:
                nxt.update(self.on_word[s].get(word, ())), nxt.update(self.on_any[s])
            at, states = at + 1, self.closure(nxt)
            for s in states:
                for label in self.labels.get(s, ()):
                    found[label] = at
        return found


def compiled(templates=TEMPLATES) -> Automaton:
    out = Automaton()
    for label, template in templates:
        out.add(label, template)
    return out


def scan(text: str, automaton: Automaton, base: dict[str, str] = BASE) -> dict:
    """Counts, places and labels of one text; see ``scanned``."""
    words = words_of(text)
    phrases: dict[str, list[tuple[list[str], str]]] = {}
    for phrase, label in base.items():
        first = phrase.split()
        phrases.setdefault(first[0], []).append((first, label))
    entry = phrases.keys() | automaton.starts.keys()
    places, base_labels, labels, spans = [], set(), set(), []
    for at in [i for i, w in enumerate(words) if w in entry]:
        for phrase, label in phrases.get(words[at], ()):
            if words[at : at + len(phrase)] == phrase:
                places.append(at)
                base_labels.add(label)
                spans.append((at, at + len(phrase)))
        for label, end in automaton.run(words, at).items():
            labels.add(label)
            spans.append((at, end))
    covered, last = 0, 0
    for a, b in sorted(spans):
        covered += max(0, b - max(a, last))
        last = max(last, b)
    return {
        "n_words": len(words), "n_base": len(places),
        "first_word": min(places, default=None), "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(base_labels | labels)),
        "score": covered / len(words) if words else 0.0,
    }


def scanned(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_base (places of base phrases),
    first_word and last_word (their least and greatest start, else null), base_labels, labels
    (base and templates; distinct, sorted, comma-joined) and score, the share of the text's words
    that matched wording covers.  A null text counts as the empty one: no words, no labels, 0.
    """
    def work(batches):
        automaton = compiled(templates)
        for batch in batches:
            for doc, text in zip(batch.column(0), texts(batch, "text"), strict=True):
                yield {"doc_id": doc.as_py(), **scan(text, automaton)}

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return map_batches(rows, work, "doc_id long, n_words long, n_base long, first_word long, "
                                   "last_word long, base_labels string, labels string, score double")
