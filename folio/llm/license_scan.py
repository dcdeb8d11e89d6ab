"""License scans: winnowed fingerprints of license templates in an inverted index pick candidates, and banded sequence
alignment reports what of a template a document has, and where.

Words lie between white space, lower-cased, without the marks at their ends. Every K consecutive words that templates
also have give a hash; of WINDOW consecutive ones the least is looked up in the index of the templates' own. Hits of a
template on neighbouring diagonals make a candidate region; in it the best local alignment within BAND of the diagonal
counts if it matches MIN_COVERAGE of the template's words. The templates are few and fixed, so tasks hold the index.

A document can have several matches, of one template or of many; overlapping ones of a template give the best. Licenses
share clauses, so that a text can match several templates in one place: is_best marks those that no overlapping match
beats, by matched words, then by coverage. A null or empty text has none. Repeated rows are scanned each for itself. Long
texts are scanned whole; the work grows with the words and the places where a template may begin. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.llm.common import text_of
from folio.llm.words import slices, words

K, WINDOW, BAND = 3, 2, 6
MIN_COVERAGE = 0.8
MATCH, MISMATCH, GAP = 2, -1, -1

#: Names and texts of license notices and of the licenses' main clauses.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "MIT notice": "Released under the MIT License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0 notice": "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty. You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see <http://creativecommons.org/publicdomain/zero/1.0/>.",
    "GPL-2.0 header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-2.1 header": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "LGPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
    "AGPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD disclaimer": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "MIT disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    "BSL-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
}


def winnowed(grams: np.ndarray) -> np.ndarray:
    """Places of the least hash of each WINDOW consecutive grams, the rightmost of equals; negative grams are none."""
    if not len(grams):
        return np.zeros(0, np.int64)
    order = (grams.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(0x5BD1E995)
    order[grams < 0] = np.uint64(2**64 - 1)
    width = min(WINDOW, len(grams))
    view = np.lib.stride_tricks.sliding_window_view(order, width)
    at = np.arange(len(view)) + width - 1 - np.argmin(view[:, ::-1], axis=1)
    at = np.unique(at)
    return at[grams[at] >= 0]


class Index:
    """The templates' words, how often each has them, and fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        distinct, index, offsets = words(pa.array(list(templates.values()), pa.string()))
        self.vocabulary = pa.array(distinct, pa.string())
        self.texts = [index[a:b].astype(np.int64) for a, b in zip(offsets, offsets[1:], strict=False)]
        self.bags = [np.unique(text, return_counts=True) for text in self.texts]
        self.places: dict[int, list[tuple[int, int]]] = {}
        for t, text in enumerate(self.texts):
            grams = self.grams(text)
            for at in winnowed(grams):
                self.places.setdefault(int(grams[at]), []).append((t, int(at)))
        self.known = np.array(sorted(self.places), np.int64)

    def grams(self, ids: np.ndarray) -> np.ndarray:
        """Of each K consecutive words; -1 where a word is in no template."""
        out = np.zeros(max(len(ids) - K + 1, 0), np.int64)
        for k in range(K):
            part = ids[k : len(ids) - K + 1 + k]
            out = np.where((out < 0) | (part < 0), -1, out * len(self.vocabulary) + part)
        return out

    def may_match(self, t: int, window: np.ndarray) -> bool:
        """Whether a window has enough of a template's words, in whatever order."""
        distinct, counts = self.bags[t]
        there = np.bincount(window[window >= 0], minlength=len(self.vocabulary))
        return np.minimum(there[distinct], counts).sum() >= MIN_COVERAGE * len(self.texts[t])


#: Regions aligned at once.
TOGETHER = 4096


def aligned(doc: np.ndarray, template: np.ndarray, shifts: np.ndarray, low: np.ndarray | int = 0, high: np.ndarray | int | None = None) -> np.ndarray:
    """first and end place in doc, and matched words, of the best local alignment of template near doc place = template place + shift, for each shift, within the places from low to high.

    The cells of a band are walked in order, all shifts side by side. Of equal scores the one with more matched words counts,
    then the first.
    """
    n, width = len(shifts), 2 * BAND + 1
    high = len(doc) if high is None else high
    none = np.array([0, -1, -1, 0], np.int64)  # score, first place, end, matched words
    row, best = np.tile(none, (width + 2, n, 1)), np.tile(none, (n, 1))
    padded = np.concatenate([doc, [-2]])
    for j, word in enumerate(template.tolist()):
        new = np.tile(none, (width + 2, n, 1))
        for c in range(1, width + 1):
            at = shifts + (j + c - BAND - 1)  # doc place = template place + shift + c - BAND - 1
            inside = (at >= low) & (at < high)
            same = padded[np.where(inside, at, len(doc))] == word
            before = row[c]
            begun = before[:, 0] > 0
            cell = before.copy()
            cell[:, 0] += np.where(same, MATCH, MISMATCH)
            cell[:, 1] = np.where(same & ~begun, at, cell[:, 1])
            cell[:, 2] = at + 1
            cell[:, 3] = np.where(same, np.where(begun, cell[:, 3] + 1, 1), cell[:, 3])
            cell[cell[:, 0] <= 0] = none
            for other in (new[c - 1], row[c + 1]):  # a word more in the document, or in the template
                further = other[:, 0] + GAP > cell[:, 0]
                cell[further] = other[further] + np.array([GAP, 0, 0, 0])
            cell[~inside] = none
            new[c] = cell
            better = (cell[:, 0] > best[:, 0]) | (cell[:, 0] == best[:, 0]) & (cell[:, 3] > best[:, 3])
            best[better] = cell[better]
        row = new
    return best[:, 1:]


def regions(shifts: np.ndarray) -> np.ndarray:
    """Of distinct ascending diagonals some, such that each is at most BAND // 2 above one; a spread of BAND lies in one's band."""
    out, last = [], None
    for s in np.unique(shifts).tolist():
        if last is None or s > last + BAND // 2:
            out.append(s)
            last = s
    return np.array(out, np.int64)


def candidates(doc: np.ndarray, index: Index) -> dict[int, list[int]]:
    """Of each template the regions of a document, as diagonals, that have enough of its words."""
    grams = index.grams(doc)
    near = np.isin(grams, index.known)
    hits: dict[int, list[int]] = {}
    for at in winnowed(np.where(near, grams, -1)).tolist():
        for t, place in index.places.get(int(grams[at]), ()):
            hits.setdefault(t, []).append(at - place)
    out = {}
    for t, found in hits.items():
        n = len(index.texts[t])
        kept = [s for s in regions(np.array(found, np.int64)).tolist() if index.may_match(t, doc[max(s - BAND, 0) : max(s + n + BAND, 0)])]
        if kept:
            out[t] = kept
    return out


def chosen(found: list[tuple[int, int, int, int]], size: int, index: Index) -> list[tuple[int, int, int, int, bool]]:
    """Of a document's matches (template, first and end word, matched words) the best of overlapping ones of a template, with whether no other template matches better there."""
    out, busy = [], {}
    for t, start, end, matched in sorted(found, key=lambda m: (-m[3], m[1])):
        taken = busy.setdefault(t, np.zeros(size, bool))
        if not taken[start:end].any():
            taken[start:end] = True
            out.append((t, start, end, matched))
    # each word is painted by the matches over it, the better ones last
    painted = np.full(size, -1)
    out.sort(key=lambda m: (m[3], m[3] / len(index.texts[m[0]]), -m[0], -m[1]))
    for k, (_, start, end, _) in enumerate(out):
        painted[start:end] = k
    named = [(*m, bool((painted[m[1] : m[2]] <= k).all())) for k, m in enumerate(out)]
    return sorted(named, key=lambda m: (m[1], m[0]))


def matches(ids: np.ndarray, offsets: np.ndarray, rows: list[int], index: Index) -> dict[int, list[tuple[int, int, int, int, bool]]]:
    """Of some documents (ids of the templates' vocabulary, or -1, between offsets) their chosen() matches. A template is aligned with all its regions in all of them at once."""
    wanted: dict[int, list[tuple[int, int]]] = {}
    for row in rows:
        a, b = int(offsets[row]), int(offsets[row + 1])
        for t, shifts in candidates(ids[a:b], index).items():
            wanted.setdefault(t, []).extend((row, a + s) for s in shifts)
    found: dict[int, list[tuple[int, int, int, int]]] = {}
    for t, places in wanted.items():
        for at in range(0, len(places), TOGETHER):
            row, shift = np.array(places[at : at + TOGETHER], np.int64).T
            best = aligned(ids, index.texts[t], shift, offsets[row], offsets[row + 1])
            good = best[:, 2] >= MIN_COVERAGE * len(index.texts[t])
            for r, (start, end, matched) in zip(row[good].tolist(), best[good].tolist(), strict=True):
                found.setdefault(r, []).append((t, start - int(offsets[r]), end - int(offsets[r]), matched))
    return {r: chosen(m, int(offsets[r + 1] - offsets[r]), index) for r, m in found.items()}


@functools.cache
def index_of(templates: tuple[tuple[str, str], ...]) -> Index:
    return Index(dict(templates))


def licenses(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, coverage, matched, start_word, end_word, start, end (code points), is_best: a row for each match."""
    key = tuple((templates or TEMPLATES).items())

    def run(batches):
        index = index_of(key)
        for batch in batches:
            for part in slices(batch, "text"):
                distinct, at, offsets = words(part.column("text"))
                ids = pc.fill_null(pc.index_in(pa.array(distinct, pa.string()), value_set=index.vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = ids[at] if len(ids) else np.zeros(0, np.int64)
                near = np.isin(index.grams(ids), index.known)  # over text ends too; only picks the texts to look at
                looked = np.unique(np.searchsorted(offsets, np.flatnonzero(near), "right") - 1)
                out = []
                for row, found in sorted(matches(ids, offsets, looked.tolist(), index).items()):
                    spans = words_at(part.column("text")[row].as_py())
                    doc_id = part.column("doc_id")[row].as_py()
                    out += [(doc_id, index.names[t], matched / len(index.texts[t]), matched, a, b, spans[a][0], spans[b - 1][1], best) for t, a, b, matched, best in found]
                if out:
                    kinds = (pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], ["doc_id", "license", "coverage", "matched", "start_word", "end_word", "start", "end", "is_best"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInArrow(run, "doc_id long, license string, coverage double, matched long, start_word long, end_word long, start long, end long, is_best boolean")


def words_at(text: str) -> list[tuple[int, int]]:
    """Start and end of each word, as words() counts them: an empty one stands before white space that begins a text."""
    found = [m.span() for m in re.finditer(r"[^\t\n\v\f\r ]+", text)]
    return [(0, 0), *found] if re.match(r"[\t\n\v\f\r ]", text) else found
