"""License scans: templates with markup, compiled to one automaton over words.

A template is the wording of a license or notice. ``<<optional>>`` ... ``<<end>>`` marks
words that may be missing (nested as one likes), ``<<any 1-4>>`` stands for so many words
of any kind. A text is accepted where the mandatory wording stands word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words, in the bytes of a lower-cased text: digits, a-z and all beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
MARKUP = re.compile(r"<<(optional|end|any \d+-\d+)>>")
#: States that an automaton remembers before it starts anew.
REMEMBERED = 50_000
OTHER = 0


class Template(NamedTuple):
    label: str
    text: str
    base: bool = False


# fixed values of the contract
BASE = (
    Template("mit", "mit license", True),
    Template("apache", "apache license", True),
    Template("gpl", "general public license", True),
)

# fixed values: wording of common licenses and of the notices that name them
MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use,
copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
<<optional>>(including the next paragraph)<<end>> shall be included in all copies or substantial portions of the Software. THE
SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL <<any 1-12>> BE LIABLE FOR ANY CLAIM,
DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC_TEXT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND
<<any 1-12>> DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."""
BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met: <<optional>>1.<<end>> Redistributions of source code must retain the above copyright notice, this list
of conditions and the following disclaimer. <<optional>>2.<<end>> Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. """
BSD_NAMES = """<<optional>>3.<<end>> Neither the name of <<any 1-12>> nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission. """
BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY <<any 1-12>> "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."""
APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<any 1-3>> except in compliance with
the License. <<optional>>You may obtain a copy of the License at http<<optional>>s<<end>>://www.apache.org/licenses/LICENSE-2.0<<end>>
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""
TEMPLATES = BASE + (
    Template("mit-notice", "released under the <<optional>>terms of the<<end>> MIT License"),
    Template("mit-notice", "licensed under the <<optional>>terms of the<<end>> MIT License"),
    Template("mit-text", MIT_TEXT),
    Template("apache-2.0", "Apache License <<optional>>Version<<end>> 2.0"),
    Template("apache-2.0-header", APACHE_HEADER),
    Template("gpl-2.0", "GNU General Public License <<optional>>as published by the Free Software Foundation either<<end>> version 2"),
    Template("gpl-3.0", "GNU General Public License <<optional>>as published by the Free Software Foundation either<<end>> version 3"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("lgpl", "GNU Library General Public License"),
    Template("bsd-2-clause", BSD_HEAD + BSD_TAIL),
    Template("bsd-3-clause", BSD_HEAD + BSD_NAMES + BSD_TAIL),
    Template("isc", ISC_TEXT),
    Template("mpl-2.0", "subject to the terms of the Mozilla Public License <<optional>>v<<end>> <<optional>>version<<end>> 2.0"),
    Template("cc-by-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
)


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().lower())


def parse(text: str) -> list:
    """A template as a list of words (bytes), pairs (least, most) of any words, and lists that are optional."""
    stack: list[list] = [[]]
    for i, part in enumerate(MARKUP.split(text)):
        if i % 2 == 0:
            stack[-1] += words(part)
        elif part == "optional":
            stack.append([])
        elif part == "end":
            if len(stack) == 1:
                raise ValueError("<<end>> without <<optional>>")
            done = stack.pop()
            stack[-1].append(done)
        else:
            least, most = part.split(" ")[1].split("-")
            stack[-1].append((int(least), int(most)))
    if len(stack) > 1:
        raise ValueError("<<optional>> without <<end>>")
    return stack[0]


def mandatory(items: list) -> int:
    """Words that are found in every text the template accepts, as written."""
    return sum(isinstance(x, bytes) for x in items)


def strength(template: Template) -> float:
    """How sure a place of this template makes one: half the doubt is left by each two mandatory words."""
    return 1.0 - 0.5 ** (mandatory(parse(template.text)) / 2)


class Automaton:
    """Accepts all templates at once; the sets of places in them are made to states as texts come to them."""

    def __init__(self, templates: tuple[Template, ...]):
        self.vocabulary: dict[bytes, int] = {}
        self.edges: list[dict[int, int]] = []  # place -> word -> place
        self.free: list[int | None] = []  # place -> place behind any word
        self.skips: list[list[int]] = []  # place -> places that need no word
        ends: dict[int, int] = {}
        starts = []
        for number, template in enumerate(templates):
            starts.append(self.place())
            ends[self.chain(parse(template.text), starts[-1])] = number
        self.ends = ends
        self.start_set = self.closed(starts)
        if any(self.free[p] is not None or p in ends for p in self.start_set):
            raise ValueError("a template starts with a word of its own")
        self.first = frozenset(w for w, i in self.vocabulary.items() if any(i in self.edges[p] for p in self.start_set))
        self.forget()

    def place(self) -> int:
        self.edges.append({})
        self.free.append(None)
        self.skips.append([])
        return len(self.edges) - 1

    def chain(self, items: list, at: int) -> int:
        """Places for ``items`` behind ``at``; the last."""
        for x in items:
            if isinstance(x, bytes):
                word = self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
                after = self.place()
                self.edges[at][word] = after
                at = after
            elif isinstance(x, list):
                inside, after = self.place(), self.place()
                self.skips[at] += [inside, after]
                self.skips[self.chain(x, inside)].append(after)
                at = after
            else:
                least, most = x
                after = self.place()
                for k in range(most):
                    if k >= least:
                        self.skips[at].append(after)
                    self.free[at] = self.place()
                    at = self.free[at]
                self.skips[at].append(after)
                at = after
        return at

    def closed(self, places: list[int]) -> frozenset[int]:
        out, todo = set(places), list(places)
        while todo:
            for p in self.skips[todo.pop()]:
                if p not in out:
                    out.add(p)
                    todo.append(p)
        return frozenset(out)

    def forget(self) -> None:
        self.numbers: dict[frozenset[int], int] = {}
        self.sets: list[frozenset[int]] = []
        self.steps: list[dict[int, int]] = []
        self.accepts: list[tuple[int, ...]] = []
        self.state(self.start_set)

    def state(self, places: frozenset[int]) -> int:
        if places not in self.numbers:
            self.numbers[places] = len(self.sets)
            self.sets.append(places)
            self.steps.append({})
            self.accepts.append(tuple(sorted({self.ends[p] for p in places if p in self.ends})))
        return self.numbers[places]

    def step(self, state: int, word: int) -> int:
        """The state behind a word, -1 if no template goes on."""
        got = self.steps[state].get(word)
        if got is None:
            places = [self.edges[p][word] for p in self.sets[state] if word in self.edges[p]]
            places += [self.free[p] for p in self.sets[state] if self.free[p] is not None]
            got = self.steps[state][word] = self.state(self.closed(places)) if places else -1
        return got

    def scan(self, found: list[bytes]) -> list[tuple[int, int, int]]:
        """(template, first word, words) of every place that is accepted, the longest from each first word.

        Places of one template inside a longer place of it are left out.
        """
        number, first = self.vocabulary.get, self.first
        out: list[tuple[int, int, int]] = []
        reach: dict[int, int] = {}
        for at in [i for i, w in enumerate(found) if w in first]:
            if len(self.sets) > REMEMBERED:
                self.forget()
            state, here, longest = 0, at, {}
            while here < len(found):
                state = self.step(state, number(found[here], OTHER))
                if state < 0:
                    break
                here += 1
                for template in self.accepts[state]:
                    longest[template] = here
            for template, end in longest.items():
                if end > reach.get(template, 0):
                    reach[template] = end
                    out.append((template, at, end - at))
        return out


@lru_cache(maxsize=8)
def automaton(templates: tuple[Template, ...]) -> Automaton:
    return Automaton(templates)


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns ``carry``, all if None) with ``n_words`` and ``matches``.

    ``matches`` lists every place where a template is accepted, in the order of first words:
    label, whether it is a base template, strength from 0 to 1, first word and words, and
    the first and end character in the text. Of places of one template that lie in each
    other the longest counts; places of different templates may overlap, so a whole license
    gives its notice as well. Words are runs of a-z, A-Z, 0-9 and all characters beyond
    ASCII; A-Z are lower-cased. A template starts with a word of its own.

    Null and empty texts have no words and an empty list. Repeated rows and ids are scanned
    for themselves. A very long text takes time in proportion to its length, at most that of
    the longest template from each word. Input columns named ``n_words`` or ``matches`` are
    replaced; an empty table gives an empty one.
    """
    keep = [c for c in (docs.columns if carry is None else carry) if c not in ("n_words", "matches")]
    place = T.StructType(
        [T.StructField("label", T.StringType()), T.StructField("base", T.BooleanType()), T.StructField("strength", T.DoubleType())]
        + [T.StructField(c, T.LongType()) for c in ("first_word", "words", "start", "end")]
    )
    arrow = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("strength", pa.float64())] + [(c, pa.int64()) for c in ("first_word", "words", "start", "end")]))
    rows = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField("n_words", T.LongType()), T.StructField("matches", T.ArrayType(place))])
    strengths = [strength(t) for t in templates]

    def places(text: str, found: list[tuple[int, int, int]]) -> list[dict]:
        data = text.encode().lower()
        spans = [m.span() for m in WORD.finditer(data)]
        out = []
        for t, first, n in found:
            start, end = (len(data[:b].decode()) for b in (spans[first][0], spans[first + n - 1][1]))
            out.append({"label": templates[t].label, "base": templates[t].base, "strength": strengths[t],
                        "first_word": first, "words": n, "start": start, "end": end})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(templates)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                counts, matches = [], []
                for text in batch.column(batch.num_columns - 1).to_pylist():
                    found = words(text)
                    hits = machine.scan(found)
                    counts.append(len(found))
                    matches.append(places(text, hits) if hits else [])
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64()), pa.array(matches, arrow)], schema.names)

    return rows.mapInArrow(run, schema)


def as_pattern(items: list) -> str:
    """The regular expression that accepts what the template accepts, in words with one blank before each."""
    out = ""
    for x in items:
        if isinstance(x, bytes):
            out += " " + x.decode()
        elif isinstance(x, list):
            out += f"(?:{as_pattern(x)})?"
        else:
            out += f"(?: [^ ]+){{{x[0]},{x[1]}}}"
    return out
