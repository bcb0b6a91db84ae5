"""License scans: MinHash bands over overlapping text windows retrieve templates, exact containment verifies.

A template of ``s`` five-word shingles is looked for in windows of whole blocks of about ``s / 4``
shingles, a window starting at every block. Some window then holds any ``s`` shingles in a row and at
most about ``s / 2`` more, so a passage that holds 0.8 of the template gives that window a
similarity of at least ``LEAST``. A template is retrieved if any band, here one minimum, agrees, which
``BANDS`` of them miss with a chance under ``MISS``.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vecforge.llm.words import U64, mix, slices, word_shingles

WIDTH = 5
CONTAINED = 0.8          # least share of a template's shingles that a window has to hold
LEAST = 0.8 / (1.5 + 0.2)  # of 0.8 s common shingles to the union of s and 1.5 s
MISS = 1e-9
BANDS = math.ceil(math.log(MISS) / math.log(1 - LEAST))
SEED = 977
MAX_TEMPLATE_BYTES = 1 << 20  # templates are sent along with every task

# Notices and whole texts of public licenses, as they stand in texts and files.
GRANTED = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
           "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
           "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
           "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:")
AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
         "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
         "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
         "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
REDISTRIBUTION = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                  "the following conditions are met:")
BSD_CONDITIONS = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                  "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
                  "list of conditions and the following disclaimer in the documentation and/or other materials provided with "
                  "the distribution.")
BSD_THIRD = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
             "products derived from this software without specific prior written permission.")
BSD_DISCLAIMER = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                  "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                  "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
                  "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
                  "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
                  "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
                  "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
             "granted, provided that the above copyright notice and this permission notice appear in all copies.")
TEMPLATES = {
    "MIT-text": f"{GRANTED} The above copyright notice and this permission notice shall be included in all copies or substantial "
                f"portions of the Software. {AS_IS}",
    "BSD-2-Clause-text": f"{REDISTRIBUTION} {BSD_CONDITIONS} {BSD_DISCLAIMER}",
    "BSD-3-Clause-text": f"{REDISTRIBUTION} {BSD_CONDITIONS} 3. {BSD_THIRD} {BSD_DISCLAIMER}",
    "BSD-third-clause": BSD_THIRD,  # tells the last two apart
    "ISC-text": f"{ISC_GRANT} THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS "
                "SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
                "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
                "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
                "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "Zlib-text": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
                 "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
                 "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
                 "to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that "
                 "you wrote the original software. If you use this software in a product, an acknowledgment in the product "
                 "documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, "
                 "and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from "
                 "any source distribution.",
    "BSD-line": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0-line": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0-line": "Licensed under CC BY-SA 4.0.",
    "LGPL-3.0-or-later": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
                         "General Public License as published by the Free Software Foundation; either version 3 of the License, "
                         "or (at your option) any later version.",
    "AGPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
                         "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                         "or (at your option) any later version.",
    "MIT-line": "Released under the MIT License.",
    "Apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-line": "Licensed under CC BY-NC 4.0.",
    "MIT": GRANTED,
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                  "in compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                  "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                  "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify it under the terms of "
                        "the GNU General Public License as published by the Free Software Foundation, either version "
                        "3 of the License, or (at your option) any later version.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify it under the terms of "
                        "the GNU General Public License as published by the Free Software Foundation; either version "
                        "2 of the License, or (at your option) any later version.",
    "BSD-clauses": REDISTRIBUTION,
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
               "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "ISC": ISC_GRANT,
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
}


class Scanner:
    """Templates by block size, with their shingle sets and minima."""

    def __init__(self, templates: dict[str, str]):
        if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
            raise ValueError(f"templates are sent to every task and may have {MAX_TEMPLATE_BYTES} bytes")
        seeds = mix(np.arange(1, 2 * BANDS + 1, dtype=U64) + U64(SEED))
        self.a, self.b = seeds[:BANDS] | U64(1), seeds[BANDS:]
        self.names, self.sets, step_of = [], [], []
        for name, text in templates.items():
            raw = text.encode()
            found, _ = word_shingles(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64), WIDTH)
            if len(found):
                self.names.append(name)
                self.sets.append(np.unique(found))
                step_of.append((-(-len(found) // 4), len(found)))
        self.steps: dict[int, tuple[int, list[int]]] = {}
        for i, (step, size) in enumerate(step_of):
            blocks, members = self.steps.get(step, (0, []))
            self.steps[step] = (max(blocks, -(-(size - 1) // step) + 1), [*members, i])
        self.minima = np.array([[((s * a + b) >> U64(32)).min() for a, b in zip(self.a, self.b)] for s in self.sets],
                               U64).reshape(len(self.sets), BANDS)

    def scan(self, found: np.ndarray, bounds: np.ndarray):
        """``(row, template, contained, first shingle, last shingle)``: every verified place of each template.

        Of places that overlap the one that holds more counts, of equal ones the first.
        """
        verified: dict[tuple[int, int], list] = {}
        rows = np.arange(len(bounds) - 1)
        layout = {}
        for step, (blocks, members) in self.steps.items():
            count = -(-np.diff(bounds) // step)
            begin = np.repeat(bounds[:-1], count) + step * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            layout[step] = (begin, np.repeat(rows, count), np.zeros((len(members), len(begin)), bool))
        if not len(found):
            return
        hashed = np.empty_like(found)
        for k in range(BANDS):
            np.multiply(found, self.a[k], out=hashed)
            hashed += self.b[k]
            for step, (blocks, members) in self.steps.items():
                begin, row, hit = layout[step]
                least = np.minimum.reduceat(hashed, begin) if step > 1 else hashed
                window = least.copy()
                for j in range(1, min(blocks, len(begin))):
                    same = row[:-j] == row[j:]
                    window[:-j] = np.where(same, np.minimum(window[:-j], least[j:]), window[:-j])
                window >>= U64(32)
                for m, i in enumerate(members):
                    hit[m] |= window == self.minima[i, k]
        for step, (blocks, members) in self.steps.items():
            begin, row, hit = layout[step]
            for m, i in enumerate(members):
                for w in np.flatnonzero(hit[m]):
                    lo = int(begin[w])
                    hi = min(lo + blocks * step, int(bounds[row[w] + 1]))
                    inside = np.flatnonzero(np.isin(found[lo:hi], self.sets[i]))
                    share = len(np.unique(found[lo:hi][inside])) / len(self.sets[i])
                    if share >= CONTAINED:
                        first = int(bounds[row[w]])
                        verified.setdefault((int(row[w]), i), []).append((-share, lo + int(inside[0]) - first, lo + int(inside[-1]) - first))
        for (row_, i), places in sorted(verified.items()):
            taken: list[tuple] = []
            for share, first, last in sorted(set(places)):
                at = bisect.bisect(taken, (first,))
                if (at == len(taken) or taken[at][0] > last) and (not at or taken[at - 1][1] < first):
                    taken.insert(at, (first, last, -share))
            for first, last, share in taken:
                yield row_, i, share, first, last


def license_matches(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id, license, contained, first_word, last_word``: every place of each template in each text.

    ``contained`` is the share of the template's five-word shingles (lower-cased A-Z) that the
    window has, at least 0.8; the words are those of the first and last shingle of it that are
    there, counted from 0. Places of one template do not overlap in their shingles: the best one
    counts, of equal ones the first, and then the best of those beside it. A template of fewer than five words is
    its whole sequence, and is found only in texts that are that sequence.

    Narrow: texts are scanned whole where they are read, against templates of bounded size. A null
    or empty text matches nothing, a null id and repeated rows are scanned as they are, an empty
    table gives no rows, and other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    scanner = Scanner(templates)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first, buf, offs in slices(batch.column(1), 1 << 20):
                rows = list(scanner.scan(*word_shingles(buf, offs, WIDTH)))
                if rows:
                    row, which, share, a, b = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([first + r for r in row], pa.int64())),
                         pa.array([scanner.names[i] for i in which]), pa.array(share, pa.float64()),
                         pa.array(a, pa.int64()), pa.array([x + WIDTH - 1 for x in b], pa.int64())],
                        [id_col, "license", "contained", "first_word", "last_word"])

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(
        run, f"`{id_col}` {kind}, license string, contained double, first_word long, last_word long")
