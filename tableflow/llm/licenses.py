"""License scans by patience alignment.

A template and a text are word lists. Words that occur exactly once in both are anchors; the longest increasing
subsequence of their places is kept, and the gaps before, between and after the anchors are aligned the same way. Where
a gap has no common unique word, equal words at its ends are matched and what is left inside counts as not covered.
Coverage is the share of the template's words that were matched. A template is reported when it reaches ``least``; of
templates whose matched stretches overlap, only the one with most matched words (then the best covered) stays.

Before anything is aligned, a bound that loses nothing decides: coverage cannot exceed the share of the template's words
that occur in the text at all. A copy that reaches ``least`` lacks a bounded number of the template's words, so of one word
more than that at least one is matched: those positions whose words are rarest in the text are the starts, at every occurrence
in the whole text, so copies of a notice are found one by one. From a start the stretch to be aligned grows on both sides
until the template reaches ``least``, or the words to the left and right cannot make it do so. A copy may hold words
that the template lacks, twice as many as the template has words and GAP more: so far a stretch grows, and one
that is wider is none. Words of a notice that stand in order but all over a long text are therefore no license.

Before a text is aligned anywhere, its longest common subsequence with the template (one pass, a bit for each word of the
template) says whether the template can be there at all: an alignment is never longer.

Null and empty texts have no license. Of templates with as many matched words and equal coverage that overlap, the first in the
text counts, then the first by name. A row without an id is scanned like any other, repeated rows give repeated results, other
columns cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Words that a copy of even a short template may hold between its own.
GAP = 32
#: Notices and whole texts in public use, by their SPDX names; where a shorter one is part of a longer one, the longer one is reported.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions"
    ),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
    ),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "MIT-full": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, "
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
        "and/or other materials provided with the distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, "
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE "
        "LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS "
        "OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, "
        "OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice "
        "and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib": (
        "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product "
        "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. "
        "3. This notice may not be removed or altered from any source distribution."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
LEAST = 0.9
_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by piles: each value goes on the leftmost pile whose top is not less."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def longest_common(template: list[str], text: list[str]) -> int:
    """Length of a longest common subsequence. Bit i of the row stays set while word i of the template adds nothing to what came before."""
    places: dict[str, int] = {}
    for i, w in enumerate(template):
        places[w] = places.get(w, 0) | 1 << i
    whole = (1 << len(template)) - 1
    row = whole
    for w in text:
        if at := places.get(w):
            met = row & at
            row = (row + met | row - met) & whole
    return len(template) - row.bit_count()


def align(template: list[str], text: list[str]) -> list[tuple[int, int]]:
    """Matched places (template, text), increasing on both sides."""
    out: list[tuple[int, int]] = []
    work = [(0, len(template), 0, len(text))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and template[a] == text[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and template[b - 1] == text[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        here = {w: i for i, w in enumerate(template[a:b], a)}
        once = {w for w, n in Counter(template[a:b]).items() if n == 1}
        places: dict[str, int] = {}
        often: set[str] = set()
        for j in range(c, d):
            if (w := text[j]) in once:
                if w in places:
                    often.add(w)
                places[w] = j
        anchors = sorted((here[w], j) for w, j in places.items() if w not in often)
        if not anchors:
            continue
        anchors = [anchors[i] for i in longest_increasing([j for _, j in anchors])]
        last = (a, c)
        for i, j in anchors:
            out.append((i, j))
            work.append((last[0], i, last[1], j))
            last = (i + 1, j + 1)
        work.append((last[0], b, last[1], d))
    return sorted(out)


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self.least = least
        self.templates = {name: words(t) for name, t in templates.items()}
        self.known = frozenset(w for t in self.templates.values() for w in t)

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """License, coverage, first and last word (exclusive) of the template's stretch, best first."""
        body = words(text)
        present = self.known.intersection(body)
        found = []
        places: dict[str, list[int]] = {}
        for name, template in self.templates.items():
            if sum(w in present for w in template) < self.least * len(template):
                continue
            if not places:
                for i, w in enumerate(body):
                    if w in present:
                        places.setdefault(w, []).append(i)
            if longest_common(template, body) < self.least * len(template):
                continue
            for pairs in self._copies(template, places, body):
                found.append((name, len(pairs) / len(template), pairs[0][1], pairs[-1][1] + 1, len(template)))
        found.sort(key=lambda x: (-x[1] * x[4], -x[1], x[2], x[0]))
        out: list[tuple[str, float, int, int]] = []
        for name, coverage, a, b, _ in found:
            if all(b <= o[2] or o[3] <= a for o in out):
                out.append((name, coverage, a, b))
        return out

    def _copies(self, template: list[str], places: dict[str, list[int]], body: list[str]) -> list[list[tuple[int, int]]]:
        """Matched places (template, text) of every copy found, each stretch once."""
        size = len(template)
        need = next(k for k in range(size + 1) if k >= self.least * size)
        # a copy lacks size - need words at most: of one position more, one is matched
        starts = sorted((len(places.get(w, ())), i) for i, w in enumerate(template))[: size - need + 1]
        out = {}
        for _, i in starts:
            for p in places.get(template[i], ()):
                pairs = self._grown(template, body, places, i, p, need)
                if pairs:
                    out[pairs[0][1], pairs[-1][1]] = max(out.get((pairs[0][1], pairs[-1][1]), []), pairs, key=len)
        return [out[k] for k in sorted(out)]

    @staticmethod
    def widest(size: int) -> int:
        """Words of a stretch at most."""
        return 3 * size + GAP

    @staticmethod
    def _grown(template: list[str], body: list[str], places: dict[str, list[int]], i: int, p: int, need: int) -> list[tuple[int, int]] | None:
        """The alignment of the least stretch around word p of the text, matched with word i of the template, that reaches need."""
        size, slack = len(template), len(template) // 4 + 1
        most = Scanner.widest(size) - size
        most_left = sum(w in places and places[w][0] < p for w in template[:i])
        most_right = sum(w in places and places[w][-1] > p for w in template[i + 1 :])
        left: list[tuple[int, int]] = []
        right: list[tuple[int, int]] = []
        first = True
        while True:
            lo, hi = max(0, p - i - slack), min(len(body), p - i + size + slack)
            if first:
                whole = align(template, body[lo:hi])
                if len(whole) >= need and whole[-1][1] - whole[0][1] < Scanner.widest(size):
                    return [(a, lo + b) for a, b in whole]
                first = False
            if most_left + most_right + 1 < need:
                return None
            if len(left) < most_left:
                left = max(left, [(a, lo + b) for a, b in align(template[:i], body[lo:p])], key=len)
            if len(right) < most_right:
                right = max(right, [(i + 1 + a, p + 1 + b) for a, b in align(template[i + 1 :], body[p + 1 : hi])], key=len)
            if len(left) + 1 + len(right) >= need:
                pairs = [*left, (i, p), *right]
                return pairs if pairs[-1][1] - pairs[0][1] < Scanner.widest(size) else None
            if slack == most or lo == 0 and hi == len(body):
                return None
            slack = min(2 * slack, most)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_licenses, license (best, null without one), coverage, licenses (all, comma-joined in text order)."""
    scanner = Scanner(templates or TEMPLATES, least)

    def run(b: pa.RecordBatch) -> dict:
        found = [scanner.scan(t) for t in common.strings(b.column("text"))]
        return {
            "doc_id": b.column("doc_id"), "n_licenses": [len(x) for x in found], "license": [x[0][0] if x else None for x in found],
            "coverage": [x[0][1] if x else 0.0 for x in found], "licenses": [",".join(n for n, _, _, _ in sorted(x, key=lambda s: s[2])) for x in found],
        }

    return common.map_arrow(common.texts_of(docs, id_col, text_col), run, "doc_id long, n_licenses long, license string, coverage double, licenses string")
