"""Licence texts and notices in documents, by the Dice coefficient over word bigrams.

Units of a text are its lines, its paragraphs (runs of lines between blank ones), the text as a whole, and windows: runs
of words across lines and paragraphs. A window has at least as many bigrams as the template it is compared with; a
shorter one has to begin and end where a line or sentence does, so that the part that several licences share is not cut
out of another one. Only stretches with as many bigrams of a template as the coefficient takes are searched. A unit is
normalised to lower-case words without digits and compared with templates: twice the shared bigrams (as multisets) over
all bigrams of both. A coefficient of ``DICE`` is out of reach if the sizes differ too much, so only templates between
DICE / (2 - DICE) and (2 - DICE) / DICE times the unit's number of bigrams are compared, and only units with enough
bigrams that occur in some template.

A unit names the template with the highest coefficient, the first by name on ties. Of equal spans one is reported, and
units inside a reported larger one are left out. A window takes the place of the lines and paragraphs inside it if it is
more than (2 - DICE) / DICE times as large or has a higher coefficient, and gives way to other units that it touches; of
windows that overlap, the same decides. Offsets count code points, ends are exclusive. NULL and empty texts and
units of one word have no bigrams and no licence. Repeated rows give repeated rows; other columns are ignored. There is no shuffle.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, functions as F

from pulseframe.llm.common import map_texts

DICE = 0.8
WORDS = re.compile(r"[^\W\d_]+")
PARAGRAPH_END = re.compile(r"\n[^\S\n]*(?:\n[^\S\n]*)+")
# What stands between two words if a line or a sentence ends there.
BREAK = re.compile(r"\n|[.!?][^\w\s]*\s")

# Licence texts and usual notices (name: texts). Numbers do not matter, they are normalised away.
TEMPLATES = {
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Licensed under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
        the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
        "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "Released under the GNU General Public License.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)
        any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
        without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General
        Public License for more details. You should have received a copy of the GNU General Public License along with
        this program. If not, see https://www.gnu.org/licenses/.""",
    ],
    "ISC": [
        "Released under the ISC License.",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS
        PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER
        IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
        PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    ],
    "MPL": [
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ],
    "Public domain": ["This is free and unencumbered software released into the public domain."],
}

Bigram = tuple[str, str]


def bigrams(text: str) -> list[Bigram]:
    words = WORDS.findall(text.lower())
    return list(zip(words, words[1:], strict=False))


class Templates:
    """Templates by size, with every bigram that occurs in one."""

    def __init__(self, texts: Mapping[str, list[str]] = TEMPLATES, least: float = DICE) -> None:
        self.least = least
        found = [(sum((c := Counter(bigrams(t))).values()), name, c) for name, group in texts.items() for t in group]
        self.rows = sorted((r for r in found if r[0]), key=lambda r: (r[0], r[1]))
        self.sizes = [size for size, _, _ in self.rows]
        self.known: dict[Bigram, list[int]] = {}  # the numbers of the templates that hold a bigram
        for number, (_, _, count) in enumerate(self.rows):
            for bigram in count:
                self.known.setdefault(bigram, []).append(number)

    def candidates(self, size: int) -> list[tuple[int, str, Counter]]:
        """Templates whose size lets a unit of ``size`` bigrams reach the least coefficient."""
        low, high = size * self.least / (2 - self.least), size * (2 - self.least) / self.least
        return self.rows[bisect_left(self.sizes, low - 1e-9):bisect_right(self.sizes, high + 1e-9)]

    def best(self, unit: str) -> tuple[float, str] | None:
        """The highest coefficient from ``least`` on, with the name of its template."""
        found = bigrams(unit)
        size = len(found)
        candidates = self.candidates(size) if size else []
        if not candidates:
            return None
        # A coefficient of ``least`` takes least / 2 * (both sizes) shared bigrams, at least with the smallest candidate.
        if sum(map(self.known.__contains__, found)) < self.least / 2 * (size + candidates[0][0]) - 1e-9:
            return None
        count = Counter(found)
        scored = [
            (2 * sum(min(n, count[b]) for b, n in other.items() if b in count) / (size + other_size), name)
            for other_size, name, other in candidates
        ]
        score, name = min(scored, key=lambda s: (-s[0], s[1]))
        return (score, name) if score >= self.least else None


def units(text: str) -> Iterator[tuple[int, int]]:
    """Spans of the whole text, its paragraphs and its lines, larger ones first, without repeats."""
    yield 0, len(text)
    start = 0
    for end, onward in [*((m.start(), m.end()) for m in PARAGRAPH_END.finditer(text)), (len(text), len(text))]:
        if (start, end) != (0, len(text)):
            yield start, end
        at = start
        if text.find("\n", start, end) >= 0:
            while at <= end:
                stop = text.find("\n", at, end)
                stop = end if stop < 0 else stop
                yield at, stop
                at = stop + 1
        start = onward


Window = tuple[float, int, int, int, str]  # coefficient, bigrams, first and last bigram, licence


def first_apart(windows: list[Window]) -> list[Window]:
    """Those of ``windows``, the best first, that overlap none before them."""
    firsts: list[int] = []
    lasts: list[int] = []
    chosen = []
    for w in windows:
        at = bisect_right(firsts, w[3])
        if not at or lasts[at - 1] < w[2]:
            firsts.insert(at, w[2])
            lasts.insert(at, w[3])
            chosen.append(w)
    return chosen


def windows_of(
    pairs: list[Bigram], hits: list[int], row: tuple[int, str, Counter], least: float, begins: list[bool]
) -> list[Window]:
    """The best windows for one template that do not overlap. ``hits`` are the places of its bigrams in ``pairs``, and
    ``begins`` tells for every word, and the end of the text, whether a line or sentence begins there."""
    size, name, template = row
    need = math.ceil(size * least / (2 - least) - 1e-9)  # shared bigrams of the smallest unit in reach
    longest = math.floor(size * (2 - least) / least + 1e-9)
    found, tried = [], 0
    for first, last in zip(hits, hits[need - 1:], strict=False):
        if last - first >= longest:
            continue
        low, high = max(tried, last - longest + 1), min(len(pairs), first + 1)
        # The window may end with the text, then it is as large as the template.
        starts = [p for p in range(low, high) if pairs[p] in template or begins[p] or p == len(pairs) - size]
        tried = max(tried, high)
        for start in starts:
            if bisect_left(hits, start + longest) - bisect_left(hits, start) < need:
                continue
            left, shared, best = dict(template), 0, None
            for end in range(start, min(len(pairs), start + longest)):
                if left.get(pairs[end], 0):
                    left[pairs[end]] -= 1
                    shared += 1
                n = end - start + 1
                if 2 * shared >= least * (n + size) - 1e-9 and (n >= size or begins[start] and begins[end + 2]):
                    best = max(best or (0.0, 0, 0), (2 * shared / (n + size), n, end))
            if best and best[0] >= least:
                found.append((best[0], best[1], start, best[2], name))
    return first_apart(sorted(found, key=lambda w: (-w[0], -w[1], w[2])))


def outranks(one: tuple[float, int], other: tuple[float, int], least: float) -> bool:
    """Whether the first (coefficient, bigrams) goes before the second: much larger, or not much smaller and more alike."""
    factor = (2 - least) / least
    return one[1] > factor * other[1] or (factor * one[1] >= other[1] and one[0] > other[0])


def settled(windows: list[Window], least: float) -> list[Window]:
    """Windows of all templates that do not overlap: much larger ones first, then those with higher coefficients."""
    chosen: list[Window] = []
    rest = windows
    while rest:  # what only gave way to a window that gives way itself comes again
        top = []
        for w in sorted(rest, key=lambda w: (-w[1], -w[0], w[4], w[2])):
            larger = bisect_left(top, -(2 - least) / least * w[1], key=lambda o: -o[1])
            if all(w[2] > o[3] or w[3] < o[2] for o in top[:larger]):
                top.append(w)
        taken = first_apart(sorted(top, key=lambda w: (-w[0], -w[1], w[4], w[2])))
        chosen += taken
        ordered = sorted(taken, key=lambda w: w[2])
        firsts = [w[2] for w in ordered]
        rest = [w for w in rest if not (n := bisect_right(firsts, w[3])) or ordered[n - 1][3] < w[2]]
    return chosen


def windows_in(text: str, templates: Templates) -> list[tuple[int, int, str, float, int]]:
    """Start, end, licence, coefficient and number of bigrams of the windows of a text that match a template."""
    lower = text.replace("\u0130", "i").lower()  # the one letter whose lower case is longer
    words = WORDS.findall(lower)
    pairs = list(zip(words, words[1:], strict=False))
    hits: dict[int, list[int]] = {}
    for at, pair in enumerate(pairs):
        if pair in templates.known:
            for number in templates.known[pair]:
                hits.setdefault(number, []).append(at)
    dense = []
    for number, places in hits.items():
        size = templates.sizes[number]
        need = math.ceil(size * templates.least / (2 - templates.least) - 1e-9)
        longest = math.floor(size * (2 - templates.least) / templates.least + 1e-9)
        if any(last - first < longest for first, last in zip(places, places[need - 1:], strict=False)):
            dense.append(number)
    if not dense:
        return []
    placed = [m.span() for m in WORDS.finditer(lower)]
    begins = [True, *(bool(BREAK.search(lower, a[1], b[0])) for a, b in zip(placed, placed[1:], strict=False)), True]
    every = [w for n in dense for w in windows_of(pairs, hits[n], templates.rows[n], templates.least, begins)]
    return [
        (placed[first][0], placed[last + 1][1], name, score, n)
        for score, n, first, last, name in settled(every, templates.least)
    ]


def found_in(text: str | None, templates: Templates) -> list[tuple[int, int, str, float]]:
    """Start, end, licence and coefficient of the units that match a template."""
    out: list[tuple[int, int, str, float]] = []
    reach = -1  # end of the last reported unit; units come larger first and in order
    for start, end in units(text or ""):
        if end - start > 1 and end > reach:
            best = templates.best(text[start:end])
            if best:
                out.append((start, end, best[1], best[0]))
                reach = end
    if not text or (out and out[0][:2] == (0, len(text))):
        return out
    for start, end, name, score, size in windows_in(text, templates):
        # Units do not overlap and are in order, so those that the window touches are neighbours.
        low = bisect_right(out, start, key=lambda o: o[1])
        high = bisect_left(out, end, key=lambda o: o[0])
        if all(
            len(WORDS.findall(text, start, end)) > len(WORDS.findall(text, max(s, start), min(e, end)))
            and len(WORDS.findall(text, s, e)) == len(WORDS.findall(text, max(s, start), min(e, end)))
            and outranks((score, size), (d, len(bigrams(text[s:e]))), templates.least)
            for s, e, _, d in out[low:high]
        ):
            out[low:high] = [(start, end, name, score)]
    return out


def scan_documents(docs: DataFrame, texts: Mapping[str, list[str]] = TEMPLATES, least: float = DICE) -> DataFrame:
    """doc_id, start, end, licence and dice of every licence text or notice of every document."""

    def work(rows: dict[str, list]) -> dict[str, list]:
        templates = Templates(texts, least)
        names = ("doc_id", "start", "end", "licence", "dice")
        found = [(d, *hit) for d, t in zip(rows["doc_id"], rows["text"], strict=True) for hit in found_in(t, templates)]
        return dict(zip(names, zip(*found, strict=True) if found else [[]] * len(names), strict=True))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_texts(narrow, "text", work, "doc_id long, start long, end long, licence string, dice double")
