"""License scans by Dice coefficient over word bigrams (operator 2).

Method.  Texts and templates are normalised to lower-case words (letters and
digits of any script; punctuation, layout and copyright signs fall away).  A
template of m words is compared with the windows of m words of a text -- with
the whole text if it has fewer -- by the Dice coefficient of their bags of
bigrams, ``2 * common / (bigrams + bigrams)``.  Pruning: a text of n bigrams
can reach the threshold t only with templates of at most n * (2 - t) / t
bigrams (size bound), and a window only if at least t * m of its bigrams
occur in the template at all, which running sums tell for every window at
once; only such windows are compared in full, the most promising first.

Templates are short notices in their usual wordings, file headers and full
texts (``licenses``).  Licences of one family share most of their words, so
of a family's templates, and of all notices, only the best is reported per window: one that has
half or more of its window in that of a better one, or is a notice within a
longer text, is looked for in the rest of the text.

The result has one row per document and licence that reach the threshold,
with the best window (the first of equals): id, license, dice, first word,
words, and the words themselves.  Documents without a match give no row.

Rows are independent: one narrow scan, no shuffle; templates travel with
the code.  Every whole text is read.

Cases: null or empty text, or one of a single word, has no bigrams and no
match; repeated rows are scanned one by one; templates of several families
may overlap in a text and are reported each, as are given templates; other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from math import ceil
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.util import row_groups

THRESHOLD = 0.8
WORDS = re.compile(r"[^\W_]+")

# Public licence notices, without names and years
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-notice":
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC0-1.0-notice":
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work.",
    "All-rights-reserved": "All rights reserved.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
        The above copyright notice and this permission notice shall be included in all copies or substantial portions of
        the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
        NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
        EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN
        ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR
        OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE
        SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
        IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL,
        DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
        notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
        above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution.""",
    "BSD-3-Clause-endorsement": """Neither the name of the copyright holder nor the names of its contributors may be
        used to endorse or promote products derived from this software without specific prior written permission.""",
    "BSD-disclaimer": """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR
        IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
        PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
        CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
        compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
        Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
        on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
        the specific language governing permissions and limitations under the License.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details.""",
    "LGPL-2.1": """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or
        (at your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
        GNU Lesser General Public License for more details.""",
    "LGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
        GNU Lesser General Public License for more details.""",
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or
        (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT
        ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the
        GNU Affero General Public License for more details.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public
        License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
        MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
        modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
        binary, for any purpose, commercial or non-commercial, and by any means.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors
        be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions:""",
}

#: How short notices begin, and what they call a licence ({0}: the version).
VERBS = ("Licensed under", "Released under", "Distributed under", "Available under")
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC": "Attribution-NonCommercial", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
       "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_GNU = {"GPL": "General", "LGPL": "Lesser General", "AGPL": "Affero General"}
CALLED = {
    "MIT": ["MIT", "MIT License"], "ISC": ["ISC License"], "Unlicense": ["Unlicense"], "Zlib": ["zlib License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License"], "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License"],
    "BSD": ["BSD License"], "Apache": ["Apache License"],
    "Apache-2.0": ["Apache License 2.0", "Apache License, Version 2.0", "Apache 2.0 License"],
    "MPL": ["Mozilla Public License"], "EPL": ["Eclipse Public License"],
    **{f"MPL-{v}": [f"Mozilla Public License {v}", f"Mozilla Public License, version {v}", f"Mozilla Public License, v. {v}", f"MPL {v}"]
       for v in ("1.1", "2.0")},
    **{f"EPL-{v}": [f"Eclipse Public License {v}", f"Eclipse Public License, version {v}", f"Eclipse Public License v{v}", f"EPL {v}"]
       for v in ("1.0", "2.0")},
    "GFDL": ["GNU Free Documentation License"], "GFDL-1.3": ["GNU Free Documentation License, Version 1.3"],
    **{k: [f"GNU {name} Public License", f"GNU {k}"] for k, name in _GNU.items()},
    **{f"{k}-{v}": [f"GNU {name} Public License, version {n}", f"GNU {name} Public License v{n}", f"GNU {k} version {n}", f"GNU {k} v{n}",
                    f"{k} version {n}", f"{k} v{n}", f"{k}v{n}", f"{k}-{v}"]
       for k, name, v in [("GPL", "General", "2.0"), ("GPL", "General", "3.0"), ("LGPL", "Lesser General", "2.1"),
                          ("LGPL", "Lesser General", "3.0"), ("AGPL", "Affero General", "3.0")] for n in {v, v.removesuffix(".0")}},
    **{f"CC-{k}-{v}": [f"CC {k} {v}", f"Creative Commons {k} {v}", f"Creative Commons {name} {v}",
                       f"Creative Commons {name} {v} {scope} License"]
       for k, name in _CC.items() for v, scope in (("3.0", "Unported"), ("4.0", "International"))},
    **{f"CC-{k}": [f"CC {k}", f"Creative Commons {k}", f"Creative Commons {name}", f"Creative Commons {name} License"]
       for k, name in _CC.items()},
    "CC0-1.0": ["CC0", "CC0 1.0", "CC0 1.0 Universal"],
}
LICENSES = Path(__file__).parent / "licenses"


def all_templates() -> dict[str, str]:
    """``TEMPLATES``, the wordings of notices (name-notice/number) and the full texts (name-text)."""
    out = dict(TEMPLATES)
    for name, called in CALLED.items():
        articles = ("", "the ", "a ", "the terms of the ", "the terms of a ") if name.startswith("CC") else \
            ("", "the ", "the terms of the ")
        # a name of one word after a long opening would be matched by the opening alone
        wordings = [f"{verb} {article}{x}" for verb in VERBS for article in articles for x in called
                    if len(words_of(x)) > 1 or "terms" not in article]
        wordings += [f"terms of the {x}" for x in called if len(words_of(x)) == 1]
        out |= {f"{name}-notice/{i}": x for i, x in enumerate(wordings)}
    return out | {f"{f.stem}-text": f.read_text(encoding="utf-8") for f in sorted(LICENSES.glob("*.txt"))}


def family_of(name: str) -> str:
    """GPL for the GNU licences, otherwise what stands before the first hyphen or digit."""
    first = re.split(r"[-\d/]", name)[0]
    return "GPL" if first in ("LGPL", "AGPL", "GFDL") else first


def rivals(a: str, b: str) -> bool:
    """Whether only the better of two templates is reported for a window: those of a family, and notices."""
    return family_of(a) == family_of(b) or "-notice" in a and "-notice" in b


def words_of(text: str | None) -> list[str]:
    return WORDS.findall(text.lower()) if text else []


class Scanner:
    """Finds the templates in one text at a time."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.threshold = threshold
        self.names = list(templates)
        words = [words_of(templates[k]) for k in self.names]
        if any(len(w) < 2 for w in words):
            raise ValueError("a template needs two words")
        self.number = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for t in words for w in t))}
        self.size = len(self.number) + 1
        codes = [self._bigrams(np.array([self.number[w] for w in t])) for t in words]
        self.bags = [Counter(c.tolist()) for c in codes]
        self.counts = [len(c) for c in codes]
        self.every = np.unique(np.concatenate(codes))
        self.known = np.zeros(self.size * self.size, bool)
        self.known[self.every] = True
        self.member = np.zeros((len(codes), len(self.every)), bool)
        for t, c in enumerate(codes):
            self.member[t, np.searchsorted(self.every, c)] = True
        self.sizes = np.array(self.counts)

    def _bigrams(self, ids: np.ndarray) -> np.ndarray:
        return np.where((ids[:-1] > 0) & (ids[1:] > 0), ids[:-1] * self.size + ids[1:], 0)

    def dice(self, t: int, window: np.ndarray) -> float:
        bag = self.bags[t]
        common = sum(min(n, bag[x]) for x, n in Counter(window.tolist()).items() if x in bag)
        return 2 * common / (len(window) + self.counts[t])

    def _read(self, text: str | None):
        """Words, codes, positions of known bigrams, their numbers, and the templates that are possible by size and hits."""
        words = words_of(text)
        get = self.number.get
        ids = np.fromiter((get(w, 0) for w in words), np.int64, len(words))
        codes = self._bigrams(ids) if len(ids) > 1 else ids[:0]
        hits = np.flatnonzero(self.known[codes] & (codes > 0))
        found = np.searchsorted(self.every, codes[hits])
        n = len(codes)
        span = np.minimum(self.sizes, n)
        possible = self.sizes * self.threshold / (2 - self.threshold) <= n
        if len(hits):
            numbers, times = np.unique(found, return_counts=True)
            enough = np.ceil(self.threshold * (span + self.sizes) / 2 - 1e-9)
            possible &= (len(hits) >= enough)
            left = np.flatnonzero(possible)
            left = left[self.member[np.ix_(left, numbers)].astype(np.float32) @ times.astype(np.float32) >= enough[left]]
        else:
            left = hits
        return words, codes, hits, found, left.tolist()

    def _best(self, t: int, codes, hits, found, taken=()) -> tuple[float, int, int] | None:
        """Dice, place and bigrams of the template's best window that is not the same as one of ``taken``."""
        n, m = len(codes), self.counts[t]
        span = min(n, m)
        inside = np.zeros(n + 1, np.int64)
        inside[hits + 1] = self.member[t, found]
        inside = np.cumsum(inside)
        hit = inside[span:] - inside[:-span]
        least = ceil(self.threshold * (span + m) / 2 - 1e-9)
        at = np.flatnonzero(hit >= least)
        for start, length in taken:
            shared = np.minimum(at + span, start + length) - np.maximum(at, start)
            at = at[2 * shared < span]
        best, where = 0.0, -1
        for k in at[np.argsort(-hit[at], kind="stable")].tolist():
            bound = 2 * int(hit[k]) / (span + m)
            if bound < best or bound == best and k > where:
                if bound < best:
                    break
                continue
            d = self.dice(t, codes[k:k + span])
            if d > best or d == best and k < where:
                best, where = d, k
        return (best, where, span) if best >= self.threshold else None

    def _row(self, words: list[str], name: str, hit: tuple[float, int, int]) -> tuple[str, float, int, int, str]:
        best, where, span = hit
        return name, best, where, span + 1, " ".join(words[where:where + span + 1])

    def scan(self, text: str | None) -> list[tuple[str, float, int, int, str]]:
        """(template, dice, first word, words, matched words) of each template that reaches the threshold."""
        words, codes, hits, found, left = self._read(text)
        return [self._row(words, self.names[t], hit) for t in left if (hit := self._best(t, codes, hits, found))]

    def report(self, text: str | None) -> list[tuple[str, float, int, int, str]]:
        """The same for each licence, with the best template of a family for the same window."""
        words, codes, hits, found, left = self._read(text)
        todo = {t: hit for t in left if (hit := self._best(t, codes, hits, found))}
        out, taken = [], []
        while todo:
            t = min(todo, key=lambda t: (-todo[t][0], -todo[t][2], todo[t][1], t))
            full, name, hit = self.names[t], self.names[t].split("/")[0], todo.pop(t)
            out.append((t, self._row(words, name, hit)))
            taken.append((full, hit[1:]))
            for u, (_, at, span) in list(todo.items()):
                other = self.names[u]
                if other.split("/")[0] == name:
                    del todo[u]
                elif rivals(full, other) and 2 * (min(at + span, hit[1] + hit[2]) - max(at, hit[1])) >= span:
                    if found_else := self._best(u, codes, hits, found, [w for n, w in taken if rivals(n, other)]):
                        todo[u] = found_else
                    else:
                        del todo[u]
        return [row for _, row in sorted(out)]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, license, dice, first_word, n_words, matched."""
    own = templates is not None
    templates = dict(templates) if own else all_templates()

    def run(batches):
        scanner = Scanner(templates, threshold)
        rows_of = scanner.scan if own else scanner.report
        for batch in row_groups(batches):
            rows = [(i, *hit) for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for hit in rows_of(text)]
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = (batch.column(0).type, pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["id", "license", "dice", "first_word", "n_words", "matched"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {id_type}, license string, dice double, first_word long, n_words long, matched string") \
        .withColumnRenamed("id", id_col)
