"""License scan: a generalised suffix automaton of licence tokens, and chains of long matches.

All templates go into one suffix automaton over word numbers. A document is streamed through it once: at each
word the automaton knows the longest suffix of the text so far that occurs in any template (the matching
statistic). Complete phrases are read off the suffix links. Maximal matches of some length are chained, template
by template, where they keep their order in both, and a chain that covers enough of its template is a span. Short
templates must be covered whole, and the first number of any template (its version) must be covered in any case.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import utf8

#: Fixed values of the contract: phrase and label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices and short licences: label and text. A label may have several templates.
TEMPLATES: list[tuple[str, str]] = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("apache-1.1", "Licensed under the Apache License, Version 1.1"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("bsd-3-clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("zlib", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("gpl-2.0-notice", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("gpl-3.0-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-4.0", "Licensed under CC BY 4.0"),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Words of licences that any text has.
COMMON = {b"the", b"of", b"and", b"in", b"to", b"or", b"is", b"by", b"a", b"with", b"that", b"for", b"are", b"be", b"this", b"it", b"at", b"on", b"an", b"not", b"all", b"any", b"no"}

#: Bytes to words: A-Z in lower case, every other ASCII byte that is no digit or letter parts words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of ASCII letters (lower-cased), digits and non-ASCII characters."""
    return text.translate(_TABLE).split()


class Automaton:
    """Suffix automaton of several word sequences; ``ends`` of a state: (template, end) of its longest string."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        for t, seq in enumerate(sequences):
            last = 0
            for i, w in enumerate(seq):
                last = self._extend(last, w)
                self.ends[last].append((t, i + 1))
        for v in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.link[v] > 0:  # what ends at a state ends at its suffixes
                self.ends[self.link[v]].extend(self.ends[v])
        self.ends = [sorted(set(x)) for x in self.ends]

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, w: int) -> int:
        if (q := self.next[last].get(w)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new


#: What a word between two matches of a chain takes from its weight: of chains that cover as much, the closest.
_FAR = 1e-4

Match = tuple[int, int, int]  # text start, template start, length


def _follow(a: Match, b: Match) -> tuple[Match, int] | None:
    """``b`` after ``a`` in a chain, without what they share in text or template, and the words between; or None."""
    cut = max(0, a[0] + a[2] - b[0], a[1] + a[2] - b[1])
    if b[0] <= a[0] or b[1] <= a[1] or cut >= b[2]:
        return None
    return (b[0] + cut, b[1] + cut, b[2] - cut), b[0] + cut - a[0] - a[2]


def chains(matches: list[Match], gap: int) -> list[list[Match]]:
    """Chains that don't meet in the text, the heaviest first; every match is in one at most.

    A chain moves forward in text and template, with no more than ``gap`` words of text between two of its matches,
    and what two matches share is counted once. Its weight is the words it covers, less a little for each between.
    Matches come in the order of their ends in the text; of chains with the same weight, the first comes first.
    """
    best: list[tuple[float, int, Match]] = []  # weight, match before or -1, the match itself as trimmed
    begin = 0
    for i, m in enumerate(matches):
        while begin < i and matches[begin][0] + matches[begin][2] + gap < m[0]:
            begin += 1
        here = (float(m[2]), -1, m)
        for j in range(begin, i):
            if step := _follow(best[j][2], m):
                trimmed, between = step
                if between <= gap and (weight := best[j][0] + trimmed[2] - _FAR * between) > here[0]:
                    here = (weight, j, trimmed)
        best.append(here)
    out, taken = [], [False] * len(matches)
    spans: list[tuple[int, int]] = []  # of the text, sorted, apart
    for i in sorted(range(len(matches)), key=lambda i: (-best[i][0], i)):
        chain, j = [], i
        while j >= 0 and not taken[j]:
            chain.append(j)
            j = best[j][1]
        if not chain:
            continue
        found = [best[j][2] for j in reversed(chain)]
        first, last = found[0][0], found[-1][0] + found[-1][2]
        at = bisect_left(spans, (first, last))
        if at < len(spans) and spans[at][0] < last or at and spans[at - 1][1] > first:
            taken[i] = True
            continue
        spans.insert(at, (first, last))
        for j in chain:
            taken[j] = True
        out.append(found)
    return out


def _first_numbers(template: list[bytes]) -> list[int]:
    out: list[int] = []
    for i, w in enumerate(template):
        if w.isdigit() and (not out or out[-1] == i - 1):
            out.append(i)
    return out


class Scanner:
    """Finds phrases and template spans in lists of words.

    ``min_match`` words make a match worth chaining, ``coverage`` of a template's words make a span (all of them in
    templates of up to ``short`` words), the first number of a template must be among them, and a chain breaks where
    the text has more than ``gap`` words between two matches.
    """

    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, min_match: int = 3, coverage: float = 0.75, gap: int = 60, short: int = 20):
        texts = [*((label, p, True) for p, label in phrases.items()), *((label, t, False) for label, t in templates)]
        self.labels = [x[0] for x in texts]
        split = [words(x[1].encode()) for x in texts]
        self.numbers = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for s in split for w in s))}
        self.sizes = [len(s) for s in split]
        self.n_phrases, self.min_match, self.gap = len(phrases), min_match, gap
        self.wanted = [n if n <= short else coverage * n for n in self.sizes]
        # the places of the first run of numbers in each template
        self.numbered = [_first_numbers(x) for x in split]
        self.automaton = a = Automaton([[self.numbers[w] for w in s] for s in split])
        # the phrases that end at each state, longest string first, also by its suffix links
        self.phrases: list[list[int]] = [[] for _ in a.next]
        for v in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            own = [t for t, end in a.ends[v] if t < self.n_phrases and end == self.sizes[t] and a.length[a.link[v]] < self.sizes[t] <= a.length[v]]
            self.phrases[v] = [*own, *self.phrases[a.link[v]]]
        # (template, end, words) of the longest match with each place of a template that ends where the text is at a state
        self.after = [(*s, -1) for s in ([self.numbers[w] for w in s] for s in split)]
        self.places: list[list[tuple[int, int, int]]] = [[] for _ in a.next]
        for v in sorted(range(1, len(a.next)), key=a.length.__getitem__):
            if a.length[v] >= min_match:
                own = set(a.ends[v])
                self.places[v] = [*((t, end, a.length[v]) for t, end in a.ends[v] if t >= self.n_phrases), *(x for x in self.places[a.link[v]] if x[:2] not in own)]
        self.lost: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        # Words that no phrase and no span can do without: all but common ones, if every text has enough others.
        common = COMMON if all(sum(w in COMMON for w in x) < len(x) * (1.0 if i < len(phrases) else coverage) for i, x in enumerate(split)) else set()
        self.rare = {w for x in split for w in x if w not in common}

    def scan(self, doc: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """(start, phrase) of each place, and (template, covered, first word, last word + 1) of each span."""
        a, places, matches = self.automaton, [], {}
        follow, link, length, phrases, sizes = a.next, a.link, a.length, self.phrases, self.sizes
        get = self.numbers.get
        state = l = 0
        for i, x in enumerate([*map(get, doc), None]):
            if l >= self.min_match:
                self._keep(matches, state, l, i, x or 0)
            if x is None:
                state = l = 0
                continue
            if x not in follow[state]:
                while state and x not in follow[state]:
                    state = link[state]
                    l = length[state]
            if x in follow[state]:
                state, l = follow[state][x], l + 1
                for t in phrases[state]:
                    if sizes[t] <= l:
                        places.append((i + 1 - sizes[t], t))
        spans = []
        for t, found in matches.items():
            for chain in chains(found, self.gap):
                covered = sum(n for *_, n in chain)
                if covered >= self.wanted[t] and all(any(at <= k < at + n for _, at, n in chain) for k in self.numbered[t]):
                    spans.append((t, covered, chain[0][0], chain[-1][0] + chain[-1][2]))
        return places, self._own(spans)

    def _keep(self, matches: dict, state: int, l: int, end: int, x: int) -> None:
        """Matches that the next word ``x`` ends, template by template, whether or not another template goes on."""
        if (lost := self.lost.get((state, x))) is None:
            lost = self.lost[state, x] = [p for p in self.places[state] if self.after[p[0]][p[1]] != x]
        for t, at, n in lost:
            n = min(n, l)
            matches.setdefault(t, []).append((end - n, at - n, n))

    def _own(self, spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """Without spans of incomplete templates inside a span of another one that covers more words: GPL 2 in GPL 3."""
        out, near = [], []
        for s in sorted(spans, key=lambda s: (s[2], -s[3], -s[1])):
            near = [x for x in near if x[3] > s[2]]
            if s[1] >= self.sizes[s[0]] or not any(x[3] >= s[3] and x[1] > s[1] for x in near):
                out.append(s)
            near.append(s)
        kept = set(out)
        return [s for s in spans if s in kept]


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, **options) -> DataFrame:
    """One row per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    ``spans`` holds (label, start, end, coverage) of each covered template, in words; ``score`` is the largest
    share of a template or phrase that the text covers, 0 if there is none. Null or empty text has no words and
    no places. Ties between chains go to the first in the text. Any other column is ignored.
    """
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:long,end:long,coverage:double>>"
    span = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("coverage", pa.float64())]))
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64(), span]
    names = [x.split(" ")[0] for x in re.split(", (?=[a-z_]+ )", schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scanner(phrases, templates, **options)
        rare, labels, sizes = s.rare, s.labels, s.sizes
        for batch in batches:
            cols: list[list] = [[] for _ in kinds]
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                split = words(text)
                # without a single word that is special to licences there is neither a phrase nor a span
                places, spans = ([], []) if rare.isdisjoint(split) else s.scan(split)
                base = sorted({labels[t] for _, t in places})
                every = sorted({*base, *(labels[t] for t, *_ in spans)})
                found = [{"label": labels[t], "start": a, "end": b, "coverage": min(1.0, c / sizes[t])} for t, c, a, b in spans]
                score = 1.0 if places else max((x["coverage"] for x in found), default=0.0)
                at = [p for p, _ in places]
                for col, x in zip(cols, (doc, len(split), len(places), min(at, default=None), max(at, default=None), ",".join(base), ",".join(every), score, found), strict=True):
                    col.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
