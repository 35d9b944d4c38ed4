"""Licence scans: patience alignment of texts with licence templates.

Around each occurrence of one of a template's telling words a window of the text is
aligned with the template: words that are unique in both anchor the alignment, the
longest increasing subsequence of the anchors stays, and the gaps between are aligned
the same way; a gap without such words is aligned by a longest common subsequence.  Coverage is the share of the template's words that are aligned; windows
that reach COVERAGE are reported, those with most aligned words first, without overlaps.

Words that are in no template can't be aligned, so a text is reduced to the places of
the templates' words first; every place of a whole text is looked at.

Defined results: null and blank texts have no licences; a template found twice in a
text is two rows; of windows with as many aligned words that of higher coverage is
taken, then the earlier place, then the first name; places are those of the text as it is
given; repeated rows and ids give repeated rows; only doc_id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

COVERAGE = 0.8
#: A window may hold as many words more than its template, as a share of its length, plus two.
SLACK = 0.5
_WORD = re.compile(r"[a-z0-9]+(?:[.\-'][a-z0-9]+)*")

_BSD_START = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_TERMS = "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_THIRD = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_GNU = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {0} for more details."

#: Texts by SPDX id, a slash and what they are (fixed values: public licences in their
#: usual wording; whole texts, the notices that files carry, and one-line statements).
TEMPLATES = {
    "MIT/text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause/text": f"{_BSD_START} {_BSD_TERMS} {_BSD_END}",
    "BSD-3-Clause/text": f"{_BSD_START} {_BSD_TERMS} {_BSD_THIRD} {_BSD_END}",
    "ISC/text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib/text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "BSL-1.0/text": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "Unlicense/text": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "Apache-2.0/notice": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "GPL-2.0-or-later/notice": _GNU.format("General Public License", 2),
    "GPL-3.0-or-later/notice": _GNU.format("General Public License", 3),
    "LGPL-2.1-or-later/notice": _GNU.format("Lesser General Public License", 2.1),
    "AGPL-3.0-or-later/notice": _GNU.format("Affero General Public License", 3),
    "MPL-2.0/notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0/notice": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0/notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0/notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC-BY-ND-4.0/notice": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "CC0-1.0/notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    "MIT/statement": "Released under the MIT License",
    "Apache-2.0/statement": "Licensed under the Apache License, Version 2.0",
    "BSD/statement": _BSD_START,
    "GPL-3.0/statement": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0/statement": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0/statement": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0/statement": "Licensed under CC BY-SA 4.0",
    "Proprietary/statement": "All rights reserved",
}
#: Words of templates that ordinary prose is full of; they don't open windows.
COMMON = frozenset("a an and any are as at by for form free from in is it of on or that the this to under use version with you".split())


def lowered(text: str) -> str:
    """Lower case in as many characters: one that would become several stays."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([x if len(x := c.lower()) == 1 else c for c in text])


def words_of(text: str) -> list[tuple[str, int, int]]:
    """(word, start, end) of the lower-cased text."""
    return [(m[0], m.start(), m.end()) for m in _WORD.finditer(lowered(text))]


@dataclass
class Template:
    name: str
    words: list[str]
    telling: dict[str, int] = field(default_factory=dict)


def templates(texts: dict[str, str]) -> list[Template]:
    """Templates with their telling words, each with its first place; all words where none tells."""
    out = []
    for name, text in texts.items():
        words = [w for w, _, _ in words_of(text)]
        first: dict[str, int] = {}
        for i, w in enumerate(words):
            first.setdefault(w, i)
        out.append(Template(name, words, {w: i for w, i in first.items() if w not in COMMON} or first))
    return out


def increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, in order of their first numbers, whose second numbers rise."""
    tops: list[int] = []
    at: list[int] = []
    before: list[int] = []
    for i, (_, b) in enumerate(pairs):
        j = bisect_left(tops, b)
        before.append(at[j - 1] if j else -1)
        tops[j : j + 1] = [b]
        at[j : j + 1] = [i]
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(pairs[i])
        i = before[i]
    return out[::-1]


def longest_common(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence, the earliest where there are several."""
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def patience(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Aligned places (in a, in b): common ends, then unique common words, then the gaps."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 >= a1 or b0 >= b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        anchors = increasing([(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place])
        if not anchors:
            out += [(a0 + i, b0 + j) for i, j in longest_common(a[a0:a1], b[b0:b1])]
            continue
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Scanner:
    def __init__(self, texts: dict[str, str], coverage: float = COVERAGE):
        self.templates, self.coverage = templates(texts), coverage
        self.vocabulary = frozenset(w for t in self.templates for w in t.words)
        # a text without any telling word has no window at all
        telling = sorted({w for t in self.templates for w in t.telling})
        self.any_telling = re.compile("|".join(map(re.escape, telling)))

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, start, end in characters), in order of place."""
        if not text:
            return []
        low = lowered(text)
        if not self.any_telling.search(low):
            return []
        # (place among all words, word, start, end) of the templates' words
        found = [(n, m[0], m.start(), m.end()) for n, m in enumerate(_WORD.finditer(low)) if m[0] in self.vocabulary]
        by_word: dict[str, list[int]] = {}
        for i, (_, w, _, _) in enumerate(found):
            by_word.setdefault(w, []).append(i)
        places = [f[0] for f in found]
        hits = []
        for order, t in enumerate(self.templates):
            if sum(w in by_word for w in t.words) < self.coverage * len(t.words):
                continue
            slack, seen = int(SLACK * len(t.words)) + 2, set()
            for w, offset in t.telling.items():
                for i in by_word.get(w, ()):
                    first = bisect_left(places, places[i] - offset - slack // 2)
                    last = bisect_left(places, places[i] - offset + len(t.words) + slack - slack // 2)
                    if (first, last) in seen:
                        continue
                    seen.add((first, last))
                    window = [x[1] for x in found[first:last]]
                    if sum((Counter(t.words) & Counter(window)).values()) < self.coverage * len(t.words):
                        continue
                    pairs = patience(t.words, window)
                    covered = len(pairs) / len(t.words)
                    if covered >= self.coverage:
                        a, b = first + pairs[0][1], first + pairs[-1][1]
                        hits.append((-len(pairs), -covered, found[a][2], order, found[b][3]))
        taken: list[tuple[str, float, int, int]] = []
        for _, covered, start, order, end in sorted(hits):
            if all(end <= s or start >= e for _, _, s, e in taken):
                taken.append((self.templates[order].name, round(-covered, 6), start, end))
        return sorted(taken, key=lambda x: x[2])


def scan(docs: DataFrame, texts: dict[str, str] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """(doc_id, license, kind, coverage, start, end): each licence text found, its places in characters."""
    texts = dict(texts or TEMPLATES)

    def run(batches):
        scanner = Scanner(texts, coverage)
        for batch in batches:
            rows, at = [], []
            for i, text in enumerate(batch.column("text")):
                found = scanner.scan(text.as_py())
                rows += [(*name.partition("/")[::2], *rest) for name, *rest in found]
                at += [i] * len(found)
            columns = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "license", "kind", "coverage", "start", "end"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, license string, kind string, coverage double, start long, end long")
