"""License scans by matching template markup.

A template is the wording of a license with marks for what may differ:

    <<beginOptional>> words that may be missing <<endOptional>>
    <<var;words=0..8>>   any words, as many as stated, may stand here
    <<oneOf;a|b c>>      one of these wordings stands here

Every template is compiled to an automaton over words; all templates form
one automaton, whose deterministic states are made as texts need them.  A
text is accepted from a place on if the mandatory wording matches exactly,
word by word; case, punctuation and line breaks do not count.  The
automaton is started only at words with which some template can begin.

Labels that end in ``-text`` stand for the whole mandatory wording of a
license, conditions and disclaimer included; a text that lacks, changes or
adds a word there does not get them.  Labels that end in ``-notice`` stand
for a sentence that names a license.

Words of a text: A-Z are lower-cased; a word is a run of characters other
than ASCII ones that are neither digits nor letters.  Texts are scanned in
blocks that overlap by the longest template, whole texts at any length.

Defined results: a null text counts as empty (0 words, no label, null
first_word and last_word, score 0).  A null id is carried along; repeated
rows give repeated results; an empty table gives an empty result.  Other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relkit.llm.common import slices

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Wording of public licenses and their usual notices, with
# the regions that may be missing or replaced.
TEMPLATES = (
    ("mit-text", """
        Permission is hereby granted, free of charge, to any person obtaining a copy
        of this software and associated documentation files
        <<beginOptional>>(the "Software")<<endOptional>>, to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice
        <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in
        all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE <<var;words=1..12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
        IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit-0-text", """
        Permission is hereby granted, free of charge, to any person obtaining a copy
        of this software and associated documentation files
        <<beginOptional>>(the "Software")<<endOptional>>, to deal in the Software without
        restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE <<var;words=1..12>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER
        IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
        WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("mit-notice", """
        <<beginOptional>>released<<endOptional>> under the <<beginOptional>>terms of
        the<<endOptional>> MIT License"""),
    ("apache-2.0-notice", """
        Licensed under the Apache License, Version 2.0 <<beginOptional>>(the "License");
        you may not use this file except in compliance with the License. You may obtain a
        copy of the License at <<var;words=1..8>><<endOptional>>"""),
    ("gpl-3.0-notice", """
        licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public
        License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>,
        <<beginOptional>>either<<endOptional>> version 3 <<beginOptional>>of the
        License<<endOptional>><<beginOptional>>, or (at your option) any later
        version<<endOptional>>"""),
    ("gpl-2.0-notice", """
        licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public
        License <<beginOptional>>as published by the Free Software Foundation<<endOptional>>,
        <<beginOptional>>either<<endOptional>> version 2 <<beginOptional>>of the
        License<<endOptional>><<beginOptional>>, or (at your option) any later
        version<<endOptional>>"""),
    ("cc-by-4.0-notice", """
        licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>
        CC BY 4.0"""),
    ("cc-by-nc-4.0-notice", """
        licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>
        CC BY-NC 4.0"""),
    ("cc-by-sa-4.0-notice", """
        licensed under <<beginOptional>>a<<endOptional>> <<beginOptional>>the<<endOptional>>
        CC BY-SA 4.0"""),
    ("bsd-2-clause-text", """
        Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met:
        <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.
        THIS SOFTWARE IS PROVIDED BY <<var;words=1..12>> "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
        <<var;words=1..12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
        OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("bsd-3-clause-text", """
        Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met:
        <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the
        above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.
        <<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1..12>> nor the
        names of <<oneOf;its|the>> contributors may be used to endorse or promote products
        derived from this software without specific prior written permission.
        THIS SOFTWARE IS PROVIDED BY <<var;words=1..12>> "AS IS" AND ANY EXPRESS OR IMPLIED
        WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY
        AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
        <<var;words=1..12>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT,
        STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
        OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("isc-text", """
        Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this
        software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1..12>> DISCLAIMS ALL WARRANTIES WITH
        REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL <<var;words=1..12>> BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
        USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE."""),
    ("0bsd-text", """
        Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this
        software for any purpose with or without fee is hereby granted.
        THE SOFTWARE IS PROVIDED "AS IS" AND <<var;words=1..12>> DISCLAIMS ALL WARRANTIES WITH
        REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL <<var;words=1..12>> BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
        USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
        SOFTWARE."""),
    ("zlib-text", """
        This software is provided <<oneOf;'as-is'|'as is'>>, without any express or implied
        warranty. In no event will the <<oneOf;author|authors>> be held liable for any
        damages arising from the use of this software.
        Permission is granted to anyone to use this software for any purpose, including
        commercial applications, and to alter it and redistribute it freely, subject to the
        following restrictions:
        <<beginOptional>>1.<<endOptional>> The origin of this software must not be
        misrepresented; you must not claim that you wrote the original software. If you use
        this software in a product, an acknowledgment in the product documentation would be
        appreciated but is not required.
        <<beginOptional>>2.<<endOptional>> Altered source versions must be plainly marked as
        such, and must not be misrepresented as being the original software.
        <<beginOptional>>3.<<endOptional>> This notice may not be removed or altered from any
        source distribution."""),
    ("mpl-2.0-notice", """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"""),
    ("unlicense-text", """
        This is free and unencumbered software released into the public domain.
        Anyone is free to copy, modify, publish, use, compile, sell, or distribute this
        software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.
        In jurisdictions that recognize copyright laws, the author or authors of this
        software dedicate any and all copyright interest in the software to the public
        domain. We make this dedication for the benefit of the public at large and to the
        detriment of our heirs and successors. We intend this dedication to be an overt act
        of relinquishment in perpetuity of all present and future rights to this software
        under copyright law.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A
        PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL
        THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
        SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
        <<beginOptional>>For more information, please refer to
        <<var;words=1..4>><<endOptional>>"""),
    ("bsd-notice", """
        Use of this source code is governed by a BSD-style license"""),
    ("unlicense-notice", """
        This is free and unencumbered software released into the public domain"""),
    ("all-rights-reserved", """
        copyright <<beginOptional>>(c)<<endOptional>> <<var;words=1..6>> all rights reserved"""),
)

_TABLE = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
_BLOCK = 1 << 22
_MARK = re.compile(r"<<(.*?)>>", re.S)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


@dataclass
class Automaton:
    """States are numbers.  step[s] maps a word to the next state, any_to[s]
    is the next state for whatever word; free[s] lists states reached
    without a word; accepts[s] lists the templates that end there."""
    step: list[dict[bytes, list[int]]]
    any_to: list[int | None]
    free: list[list[int]]
    accepts: list[list[int]]
    longest: int = 0

    def new(self) -> int:
        self.step.append({})
        self.any_to.append(None)
        self.free.append([])
        self.accepts.append([])
        return len(self.step) - 1

    def closure(self, states: set[int]) -> frozenset[int]:
        todo = list(states)
        while todo:
            for t in self.free[todo.pop()]:
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return frozenset(states)

    def next(self, states: frozenset[int], word: bytes) -> frozenset[int]:
        to = {t for s in states for t in self.step[s].get(word, ())}
        to.update(self.any_to[s] for s in states if self.any_to[s] is not None)
        return self.closure(to)


def compile_templates(templates: list[str]) -> Automaton:
    """State 0 is the start of all templates."""
    auto = Automaton([], [], [], [])
    auto.new()
    for number, text in enumerate(templates):
        at, most, opened = auto.new(), 0, []
        auto.free[0].append(at)
        for k, part in enumerate(_MARK.split(text)):
            mark = part.split(";")[0].strip() if k % 2 else None
            if mark is None:
                for w in words_of(part.encode()):
                    to = auto.new()
                    auto.step[at].setdefault(w, []).append(to)
                    at, most = to, most + 1
            elif mark == "beginOptional":
                opened.append(at)
            elif mark == "endOptional":
                if not opened:
                    raise ValueError(f"endOptional without beginOptional: {text!r}")
                to = auto.new()
                auto.free[at].append(to)
                auto.free[opened.pop()].append(to)
                at = to
            elif mark == "oneOf":
                end, longest = auto.new(), 0
                for wording in part.split(";", 1)[1].split("|"):
                    branch, ways = at, words_of(wording.encode())
                    for w in ways:
                        to = auto.new()
                        auto.step[branch].setdefault(w, []).append(to)
                        branch = to
                    auto.free[branch].append(end)
                    longest = max(longest, len(ways))
                at, most = end, most + longest
            elif mark == "var" and (m := re.search(r"words=(\d+)\.\.(\d+)", part)):
                low, high = map(int, m.groups())
                end = auto.new()
                for n in range(high):
                    if n >= low:
                        auto.free[at].append(end)
                    to = auto.new()
                    auto.any_to[at] = to
                    at = to
                auto.free[at].append(end)
                at, most = end, most + high
            else:
                raise ValueError(f"unknown mark <<{part}>>")
        if opened:
            raise ValueError(f"beginOptional without endOptional: {text!r}")
        auto.accepts[at].append(number)
        auto.longest = max(auto.longest, most)
    start = auto.closure({0})
    if any(auto.any_to[s] is not None or auto.accepts[s] for s in start):
        raise ValueError("a template must begin with wording")
    return auto


class Scanner:
    """The deterministic form of an automaton, made as texts need it."""

    def __init__(self, templates: list[str]):
        self.auto = compile_templates(templates)
        start = self.auto.closure({0})
        self.begin = {w for s in start for w in self.auto.step[s]}
        self.sets = [start]
        self.number = {start: 0}
        self.known = {w for d in self.auto.step for w in d}
        self.moves: list[dict[bytes | None, int]] = [{}]
        self.ends: list[list[int]] = [[]]

    def _move(self, state: int, word: bytes | None) -> int:
        to = self.auto.next(self.sets[state], word)
        if to not in self.number:
            self.number[to] = len(self.sets)
            self.sets.append(to)
            self.moves.append({})
            self.ends.append(sorted({t for s in to for t in self.auto.accepts[s]}))
        n = self.moves[state][word] = self.number[to] if to else -1
        return n

    def matches(self, words: list[bytes], starts: list[int]) -> Iterator[tuple[int, int, int]]:
        """(template, first word, word after the last) of every accepted place."""
        for a in starts:
            state, i = 0, a
            while i < len(words):
                w = words[i] if words[i] in self.known else None
                to = self.moves[state].get(w)
                state = self._move(state, w) if to is None else to
                if state < 0:
                    break
                i += 1
                for t in self.ends[state]:
                    yield t, a, i

    def scan(self, raw: bytes) -> tuple[int, list[tuple[int, int, int]]]:
        """Number of words and all matches of a text, read in blocks."""
        found, base, held, lap = [], 0, [], self.auto.longest
        a = 0
        while True:
            b = len(raw)
            if b - a > _BLOCK:
                # a block ends where a word does
                cut = raw[a:a + _BLOCK].translate(_TABLE).rfind(b" ")
                if cut > 0:
                    b = a + cut
                else:
                    ahead = raw[a:].translate(_TABLE).find(b" ")
                    b = a + ahead if ahead > 0 else b
            words = held + words_of(raw[a:b])
            last = b >= len(raw)
            stop = len(words) if last else max(0, len(words) - lap)
            begin = self.begin
            starts = [i for i, w in enumerate(words[:stop]) if w in begin]
            if starts:
                found += [(t, base + i, base + j) for t, i, j in self.matches(words, starts)]
            if last:
                return base + len(words), found
            base, held, a = base + stop, words[stop:], b


_SCANNERS: dict[tuple, Scanner] = {}

SCHEMA = ("id {0}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double")


def _scanner(base: tuple, templates: tuple):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (key := (base, templates)) not in _SCANNERS:
            _SCANNERS[key] = Scanner([x[0] for x in base] + [x[1] for x in templates])
        scanner = _SCANNERS[key]
        label = [x[1] for x in base] + [x[0] for x in templates]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        kinds = [None, *[pa.int64()] * 4, pa.string(), pa.string(), pa.float64()]
        for batch in slices(batches):
            rows = []
            for own, raw in zip(batch.column("id").to_pylist(),
                                batch.column("text").cast(pa.large_binary()).to_pylist()):
                n, found = scanner.scan(raw or b"")
                plain = [a for t, a, _ in found if t < len(base)]
                covered, upto = 0, 0
                for a, b in sorted((a, b) for _, a, b in found):
                    covered += max(0, b - max(a, upto))
                    upto = max(upto, b)
                rows.append((own, n, len(plain), min(plain, default=None), max(plain, default=None),
                             ",".join(sorted({label[t] for t, _, _ in found if t < len(base)})),
                             ",".join(sorted({label[t] for t, _, _ in found})),
                             covered / n if n else 0.0))
            kinds[0] = batch.schema.field("id").type
            cols = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         base: tuple = BASE, templates: tuple = TEMPLATES) -> DataFrame:
    """One row per document: id, n_words; n_base (places of base phrases),
    first_word and last_word (smallest and largest start of one),
    base_labels, labels (the templates' too), and score: the share of the
    document's words that lie in an accepted place."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = SCHEMA.format(own.schema["id"].dataType.simpleString())
    return own.mapInArrow(_scanner(tuple(base), tuple(templates)), schema).withColumnRenamed("id", id_col)
