"""Licence notices in documents, by Dice coefficient over word bigrams.

Passages are the lines of a text, its paragraphs of several lines and the whole text.
A passage is normalised to lower-case words of letters and digits, and compared with the templates as
bags of word bigrams.  For a coefficient of `least` the sizes a and b must satisfy
a >= b * least / (2 - least) and the same the other way round, so of the templates,
ordered by size, only a stretch is looked at; a passage that shares too few bigrams with all
templates together is not compared with any.  No shuffle; memory is one batch of texts.

Notices inside a line or across lines are found by windows over the words of the text: all that
begin and end with bigrams of a template and are within its size bounds, where its bigrams are dense
enough to reach `least`.  A window shorter than its template must hold the template's last bigram, which
mostly ends the licence's name or version.  Of windows that overlap the closest
counts, and one that overlaps a passage that states the same licence, or one at least as close, does not.
SPDX lines are read by their expression; they state the licences of the templates
that it names, with coefficient 1.

Null and empty texts, and passages of fewer than two words, match nothing.
Repeated rows are judged one by one; a document without a match has no row.
Empty table: no rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from math import ceil, floor

import pyarrow as pa
from pyspark.sql import DataFrame

LEAST = 0.8

_BSD_CLAUSES = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
    "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
    "Software."
)
_MIT_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)

# Names and common wordings of licence notices.
TEMPLATES: tuple[tuple[str, str], ...] = (
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        f"the following conditions are met: {_BSD_CLAUSES} {_BSD_WARRANTY}",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        f"the following conditions are met: {_BSD_CLAUSES}",
    ),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        f"the following conditions are met: {_BSD_CLAUSES} {_BSD_NAMES} {_BSD_WARRANTY}",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        f"the following conditions are met: {_BSD_CLAUSES} {_BSD_NAMES}",
    ),
    *(
        (
            name,
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:",
        )
        for name in ("BSD-2-Clause", "BSD-3-Clause")
    ),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
    ),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", f"{_MIT_GRANT} {_MIT_NOTICE} {_MIT_WARRANTY}"),
    ("MIT", f"{_MIT_GRANT} {_MIT_NOTICE}"),
    ("MIT", _MIT_GRANT),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the Software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

SCHEMA = "doc_id bigint, license string, dice double, n_passages bigint"

_WORD = re.compile(r"[^\W_]+")
_BLANK = re.compile(r"\n[ \t\r\f\v]*\n")
_SPDX = re.compile(r"SPDX-License-Identifier:([^\n]*)", re.IGNORECASE)
_SPDX_PART = re.compile(r"[A-Za-z0-9.+-]+|[^\sA-Za-z0-9.+()-]")


def passages(text: str) -> dict[str, list[tuple[int, int]]]:
    """Lines, paragraphs of several lines, and the text, with the places of their words."""
    found: dict[str, list[tuple[int, int]]] = {}
    lines = text.split("\n")
    paragraphs = _BLANK.split(text) if len(lines) > 1 else []
    for pieces in (lines, paragraphs, [text] if len(lines) > 1 else []):
        at = 0
        for piece in pieces:
            end = at + len(words(piece))
            if pieces is not paragraphs or "\n" in piece:
                found.setdefault(piece, []).append((at, end))
            at = end
    return found


def _names_of(expression: str) -> list[str]:
    """Licences of an SPDX expression, up to where it ends."""
    parts = _SPDX_PART.findall(expression)
    found = []
    for k in range(0, len(parts), 2):
        if k == 0 or parts[k - 1].upper() != "WITH":
            found.append(re.sub(r"(-only|-or-later|\+)$", "", parts[k], flags=re.IGNORECASE).lower())
        if k + 1 < len(parts) and parts[k + 1].upper() not in ("AND", "OR", "WITH"):
            break
    return found


class Scanner:
    """Templates ordered by size."""

    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        self.least = least
        bags = sorted(((sum(b.values()), name, b) for name, text in templates if (b := bag(words(text)))), key=lambda x: x[:2])
        self.bags = bags
        self.sizes = [size for size, _, _ in bags]
        self.all = {bigram for _, _, b in bags for bigram in b}

        self.last = [list(b)[-1] for _, _, b in bags]
        self.holders: dict[tuple[str, str], list[int]] = {}
        for k, (_, _, b) in enumerate(bags):
            for bigram in b:
                self.holders.setdefault(bigram, []).append(k)
        self.names = {name.lower(): name for _, name, _ in bags}

    def closest(self, passage: str) -> tuple[list[str], float]:
        """The licences whose templates are closest to a passage, and their coefficient."""
        found = words(passage)
        size = len(found) - 1
        low = bisect_left(self.sizes, size * self.least / (2 - self.least) - 1e-9)
        high = bisect_right(self.sizes, size * (2 - self.least) / self.least + 1e-9)
        if size < 1 or low >= high:
            return [], 0.0
        bigrams = list(zip(found, found[1:], strict=False))
        known = self.all
        if 2 * sum(b in known for b in bigrams) < self.least * (size + self.sizes[low]):
            return [], 0.0
        own = Counter(bigrams)
        names, best = [], self.least
        for other, name, template in self.bags[low:high]:
            dice = 2 * sum(min(n, template[b]) for b, n in own.items() if b in template) / (size + other)
            if dice > best or (dice == best and name not in names):
                names = [*names, name] if dice == best else [name]
                best = dice
        return names, best

    def _windows_of(self, k: int, hits: list[int], bigrams: list[tuple[str, str]]) -> Iterator[tuple[float, int, int, int]]:
        """(dice, bigrams in common, begin, end) of the closest window from each place where one may begin."""
        size, _, template = self.bags[k]
        need = ceil(size * self.least / (2 - self.least) - 1e-9)
        longest = floor(size * (2 - self.least) / self.least + 1e-9)
        for h in range(len(hits) - need + 1):
            begin = hits[h]
            if hits[h + need - 1] - begin >= longest:
                continue
            left, common, ended, best = dict(template), 0, False, (self.least - 1e-12, 0, 0, 0)
            for at in hits[h:]:
                if at - begin >= longest:
                    break
                bigram = bigrams[at]
                ended |= bigram == self.last[k]
                if left[bigram]:
                    left[bigram] -= 1
                    common += 1
                    length = at - begin + 1
                    dice = 2 * common / (length + size)
                    if dice > best[0] and (ended or length >= size):
                        best = (dice, common, begin, at + 2)
            if best[1]:
                yield best

    def windows(self, text: str) -> list[tuple[list[str], float, int, int]]:
        """(licences, coefficient, begin, end) of windows of words; none overlaps a closer one."""
        found = words(text)
        bigrams = list(zip(found, found[1:], strict=False))
        hits: dict[int, list[int]] = {}
        holders = self.holders
        for at, bigram in enumerate(bigrams):
            if bigram in holders:
                for k in holders[bigram]:
                    hits.setdefault(k, []).append(at)
        near = sorted(
            (-dice, -common, begin, end, self.bags[k][1])
            for k, places in hits.items()
            for dice, common, begin, end in self._windows_of(k, places, bigrams)
        )
        taken = bytearray(len(found))
        chosen: dict[tuple[int, int], tuple[list[str], float]] = {}
        for dice, _, begin, end, name in near:
            if not any(taken[begin:end]):
                taken[begin:end] = b"\1" * (end - begin)
                chosen[begin, end] = [name], -dice
            elif (begin, end) in chosen and chosen[begin, end][1] == -dice and name not in chosen[begin, end][0]:
                chosen[begin, end][0].append(name)
        return [(names, dice, *place) for place, (names, dice) in chosen.items()]

    def statements(self, text: str) -> dict[str, list[float]]:
        """Coefficients of the different passages, windows and SPDX lines that state each licence."""
        found: dict[str, list[float]] = {}
        stated: dict[int, list[tuple[list[str], float]]] = {}  # by word; a word is in three passages at most
        for passage, places in passages(text).items():
            names, dice = self.closest(passage)
            for name in names:
                found.setdefault(name, []).append(dice)
            for at in (at for place in places if names for at in range(*place)):
                stated.setdefault(at, []).append((names, dice))
        seen = set()
        all_words = None
        for names, dice, begin, end in self.windows(text):
            over = [x for at in range(begin, end) for x in stated.get(at, ())]
            all_words = all_words or words(text)
            for name in names:
                key = (name, *all_words[begin:end])
                if key not in seen and not any(name in x[0] or x[1] >= dice for x in over):
                    seen.add(key)
                    found.setdefault(name, []).append(dice)
        for expression in {x.strip() for x in _SPDX.findall(text)}:
            for name in {self.names[x] for x in _names_of(expression) if x in self.names}:
                found.setdefault(name, []).append(1.0)
        return found


def words(passage: str) -> list[str]:
    return _WORD.findall(passage.lower())


def bag(found: list[str]) -> Counter:
    return Counter(zip(found, found[1:], strict=False))


def _scan(batches: Iterator[pa.RecordBatch], templates: tuple[tuple[str, str], ...], least: float) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(templates, least)
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = scanner.statements(text or "")
            rows.extend((doc_id, name, max(dices), len(dices)) for name, dices in found.items())
        if rows:
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "license", "dice", "n_passages"],
            )


def scan(
    docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = LEAST
) -> DataFrame:
    """(doc_id, license, dice, n_passages): licences that a document's passages state.

    Windows and SPDX lines are passages too.  A passage states the licence that it is closest to, or several if they are equally
    close.  n_passages counts different passages; dice is that of the closest.
    """
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].alias("text"))
    return texts.mapInArrow(lambda batches: _scan(batches, templates, least), SCHEMA)
