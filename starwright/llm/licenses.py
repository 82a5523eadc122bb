"""Licence scans: texts against templates by the Dice coefficient over word bigrams.

A unit is a whole text, or one of its lines if it has several, or a run of lines
over which a template is wrapped. Words are ``[a-z0-9]+`` after A-Z is lowered. With bigram sets A and B the coefficient is
2 |A ∩ B| / (|A| + |B|); it can reach θ only if |A| lies between θ/(2−θ) |B| and
(2−θ)/θ |B|, which leaves few templates or none for most units. Any unit that
reaches θ shares θ/(2−θ) |B| bigrams with B, so runs are looked at only in texts
that share as many.

Runs count where neither the whole text nor one of their lines matches the same
template; of runs that overlap, the best one counts.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts_of
from .license_texts import TEXTS

LEAST_DICE = 0.85

# Notices and licence texts, published by their authors.
TEMPLATES = {
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."
    ),
    "CC-BY-4.0-notice": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0-notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
        "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
        "License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE."
    ),
    "MIT-notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        'SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "MPL-2.0-header": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."
    ),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS 'AS IS' AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission. "
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS 'AS IS' AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "GPL-2.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "LGPL-2.1-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 2.1 of the License, or (at your option) any later version. "
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    "LGPL-3.0-header": (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
        "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."
    ),
    **TEXTS,
}

WORD = re.compile(rb"[a-z0-9]+")


def bigrams(text: bytes) -> set[tuple[bytes, bytes]]:
    words = WORD.findall(text.lower())
    return set(zip(words, words[1:], strict=False))


class Templates:
    def __init__(self, texts: dict[str, str], least: float):
        self.least = least
        self.sets = {name: bigrams(text.encode()) for name, text in texts.items()}
        low, high = least / (2 - least), (2 - least) / least
        self.bounds = [(low * len(s), high * len(s), name, s) for name, s in sorted(self.sets.items()) if s]
        self.smallest = min((b[0] for b in self.bounds), default=0)
        self.largest = max((b[1] for b in self.bounds), default=-1)
        self.known = set().union(*self.sets.values())

    def matches(self, unit: bytes) -> list[tuple[str, float]]:
        """Names and coefficients of the templates that a unit reaches."""
        words = WORD.findall(unit.lower())
        if len(words) - 1 < self.smallest:
            return []
        found = set(zip(words, words[1:], strict=False))
        n = len(found)
        if not self.smallest <= n <= self.largest or self.known.isdisjoint(found):
            return []
        near = ((name, 2 * len(found & s) / (n + len(s))) for low, high, name, s in self.bounds if low <= n <= high)
        return [(name, dice) for name, dice in near if dice >= self.least]

    def wrapped(self, lines: list[bytes], alone: dict[str, set[int]]) -> list[tuple[str, float, int]]:
        """Names, coefficients and first lines (from 1) of runs; ``alone`` has the units that match by themselves."""
        words: list[bytes] = []
        starts = [0]
        for line in lines:
            words += WORD.findall(line.lower())
            starts.append(len(words))
        pairs = list(zip(words, words[1:], strict=False))
        hits = self.known.intersection(pairs)
        out = []
        for low, high, name, s in self.bounds:
            taken = alone.get(name, set())
            if len(hits) < low or 0 in taken or len(hits & s) < low:
                continue
            used: set[int] = set()
            for dice, first, last in sorted(self._runs(pairs, starts, high, s, taken), key=lambda r: (-r[0], r[1:])):
                if used.isdisjoint(range(first, last + 1)):
                    used.update(range(first, last + 1))
                    out.append((name, dice, first))
        return out

    def _runs(self, pairs: list, starts: list[int], high: float, s: set, taken: set[int]) -> list[tuple[float, int, int]]:
        """(coefficient, first line, last line) of runs that reach ``s``, without those that a shorter run with no lower one makes needless."""
        out = []
        n_lines = len(starts) - 1
        for i in range(n_lines):
            own = set(pairs[starts[i] : starts[i + 1]])  # the bigrams that begin in the line
            if own.isdisjoint(s):
                continue
            seen: set = set()
            shared = 0
            for j in range(i, n_lines):
                if j + 1 in taken:
                    break
                end = max(starts[j + 1] - 1, 0)
                new = set(pairs[max(starts[j] - 1, starts[i]) : end]) - seen if starts[j + 1] > starts[j] else set()
                seen |= new
                gain = len(new & s)
                shared += gain
                if j > i:
                    own.difference_update(pairs[max(starts[j] - 1, starts[i + 1]) : end])
                # Beyond, no run from here reaches s, or the run from the next line holds the same bigrams.
                if len(seen) > high or not own:
                    break
                dice = 2 * shared / (len(seen) + len(s))
                if j > i and gain and dice >= self.least:
                    out.append((dice, i + 1, j + 1))
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_DICE, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, license_id, dice, n_units, first_line) of every document and template that match.

    ``dice`` is the best coefficient, ``n_units`` the number of matching units,
    ``first_line`` the first of them: 0 for the whole text, else the number of
    the line, or of a run's first line, from 1. Null and empty texts match nothing; repeated rows give
    repeated results.
    """
    own = TEMPLATES if templates is None else templates
    rows = docs.select(doc, text)

    def apply(batches):
        known = Templates(own, least)
        for batch in batches:
            out = []
            for i, whole in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
                found: dict[str, list] = {}
                alone: dict[str, set[int]] = {}
                lines = whole.split(b"\n")
                for at, unit in enumerate([whole, *lines] if len(lines) > 1 else [whole]):
                    for name, dice in known.matches(unit):
                        best = found.setdefault(name, [0.0, 0, at])
                        best[0], best[1] = max(best[0], dice), best[1] + 1
                        alone.setdefault(name, set()).add(at)
                for name, dice, at in known.wrapped(lines, alone) if len(lines) > 1 else []:
                    best = found.setdefault(name, [0.0, 0, at])
                    best[:] = max(best[0], dice), best[1] + 1, min(best[2], at)
                out += [(i, name, *best) for name, best in sorted(found.items())]
            columns = list(zip(*out, strict=True)) or [[]] * 5
            kinds = (batch.schema.field(0).type, pa.string(), pa.float64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[doc, "license_id", "dice", "n_units", "first_line"])

    kind = rows.schema[doc].dataType.simpleString()
    return rows.mapInArrow(apply, f"`{doc}` {kind}, license_id string, dice double, n_units long, first_line long")
