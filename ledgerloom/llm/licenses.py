"""Licence scans: Dice coefficient of word bigrams against licence templates.

Texts are normalised to words of ASCII letters and digits, lower-cased. A
template slides over a text as a window of as many words as it has (the whole
text where that is shorter): wherever the Dice coefficient of both bigram
multisets reaches the threshold, the template matches, in a line of its own or
amid prose. Of matches that overlap the best stays.

For bigram multisets of sizes a and b the coefficient cannot exceed
2 min(a, b) / (a + b), and matching takes a share of a template's different
bigrams: templates beyond these bounds are not compared. Which bigrams of a
text are any template's is found in numpy, for many texts at once; only texts
and templates that pass are compared window by window. All in one pass over
the documents, without a shuffle.

Defined cases: a null text counts as empty. A text of fewer than two words has
no bigrams and matches nothing. Ties go to the longer template, then to the
earliest window, then to the template that comes first by name. Rows that
repeat a document are each reported. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped
from .wordcode import CodeIndex, chunks, paired, word_codes

THRESHOLD = 0.8
WORDS = np.zeros(256, bool)
WORDS[48:58] = WORDS[97:123] = True
#: Texts of short public licences, without copyright lines.
_WARRANTY = "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD_2 = f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, {_WARRANTY}"""
_BSD_3 = _BSD_2.replace("THIS SOFTWARE IS PROVIDED BY", "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\nTHIS SOFTWARE IS PROVIDED BY")
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
#: Notices by which public licences are declared.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        _BSD_3,
    ),
    "BSD-2-Clause": ("Released under the BSD 2-Clause License.", _BSD_2),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC0-1.0": ("Released into the public domain under CC0 1.0.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        _MIT,
    ),
    "ISC": ("Released under the ISC License.", _ISC),
    "Unlicense": (_UNLICENSE,),
    "Zlib": ("Released under the zlib License.", _ZLIB),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",),
}


def _pairs(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the word bigrams of all texts in order, and the number of the text that each is from."""
    codes, of = word_codes(texts, WORDS)
    if len(codes) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = of[1:] == of[:-1]
    return paired(codes[:-1], codes[1:])[same], of[1:][same]


class Templates:
    def __init__(self, templates: dict[str, tuple[str, ...]], threshold: float):
        self.threshold = threshold
        found = [(name, _pairs([text.encode()])[0]) for name, texts in sorted(templates.items()) for text in texts]
        self.known = [(name, codes) for name, codes in found if len(codes)]
        every = np.unique(np.concatenate([c for _, c in self.known])) if self.known else np.zeros(0, np.uint64)
        self.index = CodeIndex(every)
        self.grams = [Counter(self.index.find(codes).tolist()) for _, codes in self.known]
        self.sizes = np.array([len(codes) for _, codes in self.known], np.int64)
        self.has = np.zeros((len(every), len(self.known)), np.int32)
        for t, grams in enumerate(self.grams):
            self.has[list(grams), t] = 1
        # A match of sizes a and b takes threshold * (a + b) / 2 bigrams in common, and a is threshold / (2 - threshold) * b at least.
        ratio = threshold / (2 - threshold)
        common = threshold * (self.sizes + np.ceil(ratio * self.sizes)) / 2
        repeats = np.array([sum(g.values()) - len(g) for g in self.grams], np.int64)
        self.least, self.low = np.ceil(common - 1e-9) - repeats, ratio * self.sizes

    def scan(self, texts: list[bytes | None]) -> list[list[tuple[float, str, int]]]:
        """For each text its matches, best first: coefficient, licence, and first word."""
        out: list[list[tuple[float, str, int]]] = [[] for _ in texts]
        codes, of = _pairs(texts)
        which = self.index.find(codes)
        hits = np.flatnonzero(which >= 0)
        if not len(hits):
            return out
        keys = np.unique(of[hits] * len(self.has) + which[hits])  # a text's different bigrams
        text, gram = keys // len(self.has), keys % len(self.has)
        firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        common = np.add.reduceat(self.has[gram], firsts, 0)
        sizes = np.bincount(of, minlength=len(texts))
        begin = np.cumsum(sizes) - sizes
        for at, counts in zip(text[firsts].tolist(), common, strict=True):
            able = np.flatnonzero((counts >= self.least) & (sizes[at] + 1e-9 >= self.low))
            if len(able):
                mine = which[begin[at] : begin[at] + sizes[at]]
                out[at] = self._best([m for t in able.tolist() for m in self._windows(t, mine)])
        return out

    def _windows(self, t: int, mine: np.ndarray) -> Iterator[tuple[float, int, int, str]]:
        """Windows at which template `t` matches: coefficient, its size, first word and licence."""
        grams, size = self.grams[t], min(int(self.sizes[t]), len(mine))
        needed = self.threshold * (size + self.sizes[t]) / 2 - 1e-9
        inside = np.concatenate([[0], np.cumsum((mine >= 0) & (self.has[np.maximum(mine, 0), t] > 0))])
        seen: dict[int, int] = {}
        both, at = 0, None  # how many bigrams the window shares, and where it stands
        codes = mine.tolist()
        for start in np.flatnonzero(inside[size:] - inside[:-size] >= needed).tolist():
            if at is None or start - at >= size:
                seen = Counter(codes[start : start + size])
                both = sum(min(n, seen[g]) for g, n in grams.items() if g in seen)
            else:  # the window moves on: some bigrams leave, as many come
                for i in range(at, start):
                    gone, come = codes[i], codes[i + size]
                    both -= seen[gone] <= grams.get(gone, 0)
                    seen[gone] -= 1
                    seen[come] = seen.get(come, 0) + 1
                    both += seen[come] <= grams.get(come, 0)
            at = start
            if both >= needed:
                yield 2 * both / (size + int(self.sizes[t])), int(self.sizes[t]), start, self.known[t][0]

    def _best(self, found: list[tuple[float, int, int, str]]) -> list[tuple[float, str, int]]:
        """Matches, best first, that overlap no better one; those taken lie apart, so only the neighbours on either side are looked at."""
        starts: list[int] = []
        ends: list[int] = []
        out = []
        for dice, size, start, name in sorted(found, key=lambda m: (-m[0], -m[1], m[2], m[3])):
            i = bisect_right(starts, start)
            if (i == 0 or ends[i - 1] < start) and (i == len(starts) or start + size < starts[i]):
                starts.insert(i, start)
                ends.insert(i, start + size)
                out.append((dice, name, start))
        return out


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] = TEMPLATES, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, the best licence (null: none), its coefficient, how many windows match, and all licences found."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book = Templates(templates, threshold)
        for batch in batches:
            for first, texts in chunks(batch.column(1).cast(pa.binary()).to_pylist()):
                found = book.scan(texts)
                columns = [
                    batch.column(0).slice(first, len(texts)),
                    pa.array([f[0][1] if f else None for f in found], pa.string()),
                    pa.array([f[0][0] if f else None for f in found], pa.float64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([",".join(sorted({m[1] for m in f})) for f in found], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "license", "dice", "n_units", "licenses"])

    return slim.transform(mapped, scanned, "doc_id bigint, license string, dice double, n_units bigint, licenses string")
