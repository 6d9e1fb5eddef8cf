"""Licence scan: Dice coefficient over word bigrams against licence templates."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WORDS = re.compile(r"[^\W_]+")
LEAST = 0.8

#: Public licence notices and texts.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT notice": "Released under the MIT License.",
    "MIT notice 2": "Licensed under the MIT License.",
    "MIT": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-2-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD-3-Clause": 'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "BSD notice": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0 notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0 notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "GPL-3.0 header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    "GPL-2.0 header": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "MPL-2.0 header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC-BY-4.0 notice": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0 notice": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0 notice": "Licensed under CC BY-ND 4.0.",
    "CC-BY-4.0 sentence": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0 sentence": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-NC-4.0 sentence": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC0-1.0 sentence": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
}


def normal_words(text: str) -> list[str]:
    """Lower-case words of letters and digits; punctuation, spacing and case don't count."""
    return WORDS.findall(text.lower())


def bigrams(words: list[str]) -> frozenset:
    return frozenset(zip(words, words[1:]))


class Scanner:
    """Templates sorted by number of bigrams.

    A Dice of t or more needs sizes a, b with a at least t/(2-t) b, so a block meets only the
    templates between two bounds, and none if it shares no bigram with any.
    """

    def __init__(self, templates: dict[str, str], least: float):
        made = sorted((len(g), name, g) for name, text in templates.items() if (g := bigrams(normal_words(text))))
        self.sizes, self.names, self.grams = [m[0] for m in made], [m[1] for m in made], [m[2] for m in made]
        self.least, self.narrow = least, least / (2 - least)
        self.known = frozenset().union(*self.grams) if made else frozenset()

    def best(self, words: list[str]) -> tuple[float, str] | None:
        """The best template of one block at the threshold or above; ties to the first name."""
        pairs = set(zip(words, words[1:]))
        if self.known.isdisjoint(pairs):
            return None
        n, top = len(pairs), None
        for k in range(bisect_left(self.sizes, n * self.narrow - 1e-9), bisect_right(self.sizes, n / self.narrow + 1e-9)):
            dice = 2 * len(pairs & self.grams[k]) / (n + self.sizes[k])
            if dice >= self.least and (top is None or (-dice, self.names[k]) < (-top[0], top[1])):
                top = dice, self.names[k]
        return top

    def windows(self, words: list[str]) -> list[tuple[float, int, int, str]]:
        """(dice, first word, last word, licence): for each template every start's best run of words at the threshold or above.

        A best run begins and ends with a bigram of the template that it holds once, and has no more
        distinct bigrams than the size bound allows; all such runs are tried.
        """
        pairs = list(zip(words, words[1:]))
        seen = self.known.intersection(pairs)
        out = []
        for size, name, grams in zip(self.sizes, self.names, self.grams) if seen else ():
            if len(seen & grams) < size * self.narrow - 1e-9:
                continue
            most = size / self.narrow + 1e-9
            for i, g in enumerate(pairs):
                if g not in grams:
                    continue
                inside, both, alone = {g}, 1, 2 / (1 + size)
                top = (alone, i) if alone >= self.least else None
                for j in range(i + 1, len(pairs)):
                    x = pairs[j]
                    if x == g:
                        break
                    if x in inside:
                        continue
                    inside.add(x)
                    if len(inside) > most:
                        break
                    if x in grams:
                        both += 1
                        dice = 2 * both / (len(inside) + size)
                        if dice >= self.least and (top is None or dice > top[0]):
                            top = dice, j
                if top:
                    out.append((top[0], i, top[1] + 1, name))
        return out

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """(licence, dice, first line, last line): the best runs of words anywhere in the text.

        Of runs that overlap, the one with the highest coefficient stays; ties go to the longer, then the earlier.
        """
        words, at = [], []
        for k, line in enumerate(text.split("\n")):
            found = normal_words(line)
            words += found
            at += [k] * len(found)
        out, taken = [], []
        for dice, a, b, name in sorted(self.windows(words), key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])):
            if all(b < c or a > d for c, d in taken):
                taken.append((a, b))
                out.append((a, (name, dice, at[a], at[b])))
        return [x for _, x in sorted(out)]


def scanned(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """One row per document: doc_id, licence (the best; null if none), dice, n_found, found.

    ``found`` lists (licence, dice, first_line, last_line) of every matching run of words. Null and empty texts have none;
    ties go to the earlier block; null ids and repeated rows stay one row each; an empty table gives none.
    """

    def run(batches):
        s = Scanner(templates, least)
        kind = pa.list_(pa.struct([("licence", pa.string()), ("dice", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())]))
        for batch in batches:
            every = [s.scan(t.as_py() or "") for t in batch.column(1)]
            top = [min(x, key=lambda y: (-y[1], y[2])) if x else (None, None) for x in every]
            rows = [[dict(zip(("licence", "dice", "first_line", "last_line"), y)) for y in x] for x in every]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t[0] for t in top], pa.string()), pa.array([t[1] for t in top], pa.float64()), pa.array(map(len, every), pa.int64()), pa.array(rows, kind)],
                ["doc_id", "licence", "dice", "n_found", "found"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, licence string, dice double, n_found long, found array<struct<licence: string, dice: double, first_line: int, last_line: int>>"
    )
