"""License scan: MinHash bands over overlapping text windows, then exact containment.

A template with S word shingles is looked for in windows of whole blocks of about S / 2
shingles, so many that every run of S shingles lies inside one window. A window that holds at
least the share ``least`` of a template then has a Jaccard similarity of at least
J = least * S / (W + (1 - least) * S), W being the window's shingles. With ``bands`` bands of 2
MinHash values it shares a band with the template with probability 1 - (1 - J^2)^bands. J is
0.4 at the least (S = 5) and 0.45 to 0.5 for long templates, so 60 bands miss a window with a
probability below 3 in 10^5, and below 10^-6 for long templates.

A band agrees only if its smallest shingle is in both; windows without any shingle of any
template therefore agree with none, and are passed over before hashing. What the bands
retrieve is verified by the exact share of the template's distinct shingles in the window.

Tokens are runs of ASCII letters and digits and of bytes beyond ASCII, lower-cased. Shingles
have five tokens; a shorter template is one shingle of its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import prepare, source
from .toxicity import _BREAK, _LOWER
from .words import Words, slices, split_words, window_hashes, word_hashes

_PROVIDED = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so"
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the organization. "
)
_ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
_HOLDERS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)


def _gnu(kind: str, version: str, later: bool, what: str = "program") -> str:
    """A notice of the GNU licenses up to the address or URL at its end, which tells no version."""
    name = f"GNU {kind} Public License"
    version = f"either version {version} of the License, or (at your option) any later version" if later else f"version {version}"
    return (
        f"This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} as published by "
        f"the Free Software Foundation; {version}. This {what} is distributed in the hope that it will be useful, but WITHOUT "
        "ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"{name} for more details. You should have received a copy of the {name} along with this {what}"
    )


#: Looked for by default (fixed values): license texts that go into files as a whole, the
#: notices that longer licenses ask to put there, and one-line notices. "#" and what follows it
#: mark another wording of a name and are not reported.
TEMPLATES = {
    "MIT-notice": "Released under the MIT License.",
    "MIT-notice#licensed": "Licensed under the MIT License.",
    "Apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "MIT": f"{_MIT}, subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
    f"copies or substantial portions of the Software. {_PROVIDED}",
    "MIT-0": f"{_MIT}. {_PROVIDED}",
    "Apache-2.0": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License."
    ),
    "BSD-2-Clause": _BSD + _HOLDERS,
    "BSD-3-Clause": _BSD + _ENDORSE + _HOLDERS,
    "BSD-4-Clause": _BSD + _ADVERTISING + _ENDORSE + _HOLDERS,
    "ISC": f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies. {_ISC_END}",
    "0BSD": f"{_ISC}. {_ISC_END}",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "CC0-1.0-notice": "Licensed under CC0 1.0.",
    "CC0-1.0": (
        "To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to "
        "this software to the public domain worldwide. This software is distributed without any warranty. You should have "
        "received a copy of the CC0 Public Domain Dedication along with this software. If not, see "
        "<http://creativecommons.org/publicdomain/zero/1.0/>."
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
        "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to "
        "be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
        "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
        "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
}
for _id, _kind, _version in [("GPL", "General", "2"), ("GPL", "General", "3"), ("LGPL", "Library General", "2"), ("LGPL", "Lesser General", "2.1"), ("LGPL", "Lesser General", "3"), ("AGPL", "Affero General", "3")]:
    _name = f"{_id}-{_version}" if "." in _version else f"{_id}-{_version}.0"
    TEMPLATES[f"{_name}-notice"] = f"This work is licensed under the GNU {_kind} Public License, version {_version}."
    for _end, _later in (("or-later", True), ("only", False)):
        TEMPLATES[f"{_name}-{_end}"] = _gnu(_kind, _version, _later, "library" if _id == "LGPL" else "program")
for _id, _kind in [
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
]:
    TEMPLATES[f"CC-{_id}-4.0-notice"] = f"Licensed under CC {_id} 4.0."
    TEMPLATES[f"CC-{_id}-3.0-notice"] = f"Licensed under CC {_id} 3.0."
    for _mark, _article in (("", "a"), ("#the", "the")):
        TEMPLATES[f"CC-{_id}-4.0{_mark}"] = f"This work is licensed under {_article} Creative Commons {_kind} 4.0 International License."
        TEMPLATES[f"CC-{_id}-3.0{_mark}"] = f"This work is licensed under {_article} Creative Commons {_kind} 3.0 Unported License."

SHINGLE, LEAST, BANDS = 5, 0.8, 60


def _tokens(texts: pa.Array) -> Words:
    w = split_words(texts, _BREAK)
    w.data = _LOWER[w.data]
    return w


def _shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first token, hash)`` of all shingles."""
    return window_hashes(word_hashes(w, 21, space=_BREAK)[0], w.first, size, 22 + size)


def _words(w: Words, at: int, size: int) -> tuple[bytes, ...]:
    return tuple(w.data[a:b].tobytes() for a, b in zip(w.starts[at : at + size], w.ends[at : at + size]))


def signature(h: np.ndarray) -> np.ndarray:
    """MinHash values of a set of shingle hashes: two per band."""
    rng = np.random.default_rng(23)
    a = rng.integers(0, 2**62, 2 * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    x = h[:, None] * a[None, :]
    return ((x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)).min(0)


class Template:
    def __init__(self, name: str, text: str):
        w = _tokens(pa.array([text]))
        tokens = len(w.starts)
        if not tokens:
            raise ValueError(f"template {name!r} has no words")
        self.name, self.size = name, min(SHINGLE, tokens)
        at, h = _shingles(w, self.size)
        self.set = np.unique(h)
        self.words = {int(x): _words(w, int(i), self.size) for i, x in zip(at, h)}
        self.length = tokens - self.size + 1
        self.block = -(-self.length // 2)
        self.blocks = -(-(self.length + self.block - 1) // self.block)
        self.bands = signature(self.set).reshape(BANDS, 2)


def tight(h: np.ndarray, at: np.ndarray) -> tuple[int, int]:
    """First and last index of the run with every value of ``h`` that is shortest by ``at``."""
    _, value = np.unique(h, return_inverse=True)
    last, best = np.full(value.max() + 1, -1), (0, len(h) - 1)
    for j, v in enumerate(value):
        last[v] = j
        if (i := int(last.min())) >= 0 and at[j] - at[i] < at[best[1]] - at[best[0]]:
            best = i, j
    return best


def scan(texts: pa.Array, templates: list[Template]) -> list[tuple[int, str, int, int, float]]:
    """``(text, template, first token, token after the last, share)`` of every window that
    holds enough of a template, cut to the shortest run with all of its shingles of the template."""
    out = []
    w = _tokens(texts)
    first = w.first
    for size in sorted({t.size for t in templates}):
        at, h = _shingles(w, size)
        text = np.searchsorted(first, at, "right") - 1
        group = [t for t in templates if t.size == size]
        words = {x: s for t in group for x, s in t.words.items()}
        some = np.flatnonzero(np.isin(h, np.concatenate([t.set for t in group])))
        # Whole words decide: a hash that other words share is no shingle of a template.
        some = some[[_words(w, int(at[i]), size) == words[int(h[i])] for i in some]] if len(some) else some
        real = np.zeros(len(h), bool)
        real[some] = True
        start_of = np.searchsorted(text, np.arange(len(first) - 1))  # first shingle of each text
        end_of = np.searchsorted(text, np.arange(len(first) - 1), "right")
        for block, blocks in sorted({(t.block, t.blocks) for t in group}):
            shape = [t for t in group if (t.block, t.blocks) == (block, blocks)]
            known = np.concatenate([t.set for t in shape])
            hits = some[np.isin(h[some], known)]
            own = text[hits]
            last = (hits - start_of[own]) // block  # windows by the number of their first block
            n = -(-(end_of[own] - start_of[own]) // block)
            windows = {(int(d), k) for d, j, m in zip(own, last, n) for k in range(max(0, int(j) - blocks + 1), min(int(j), max(0, int(m) - blocks)) + 1)}
            for d, k in sorted(windows):
                lo = int(start_of[d]) + k * block
                hi = min(int(end_of[d]), lo + blocks * block)
                sig = signature(np.unique(h[lo:hi])).reshape(BANDS, 2)
                for t in shape:
                    if (sig == t.bands).all(1).any():
                        inside = np.flatnonzero(real[lo:hi] & np.isin(h[lo:hi], t.set))
                        share = len(np.unique(h[lo:hi][inside])) / len(t.set)
                        if share >= LEAST:
                            base = int(first[d])
                            i, j = tight(h[lo:hi][inside], inside)
                            out.append((d, t.name, int(at[lo + inside[i]]) - base, int(at[lo + inside[j]]) - base + size, share))
    return out


def siblings(templates: list[Template]) -> dict[str, set[str]]:
    """For each template, those that share half of the larger one's shingles with it."""
    near = {t.name: set() for t in templates}
    for i, a in enumerate(templates):
        for b in templates[:i]:
            if a.size == b.size and 2 * len(np.intersect1d(a.set, b.set)) >= max(len(a.set), len(b.set)):
                near[a.name].add(b.name)
                near[b.name].add(a.name)
    return near


def settle(hits: list[tuple[int, str, int, int, float]], templates: list[Template], near: dict[str, set[str]]) -> list[tuple[int, str, int, int, float]]:
    """Of siblings found at one place, those that cover most of it.

    From the most shingles covered down, and from the shortest window up, a window falls to one
    that covers more and overlaps at least half of the shorter of the two. A window that
    overlaps a better one of its own template so may reach from one notice into the next; it
    stays, but no window falls to it.
    """
    size = {t.name: len(t.set) for t in templates}
    stay: dict[int, list] = {}
    lead: dict[int, list] = {}
    for hit in sorted(hits, key=lambda x: (-round(x[4] * size[x[1]]), -x[4], x[3] - x[2], x)):
        d, name, start, end, share = hit
        rank = round(share * size[name]), share
        over = [(other, r) for other, s, e, r in lead.get(d, []) if 2 * (min(end, e) - max(start, s)) >= min(end - start, e - s)]
        if not any(other in near[name] and rank < r for other, r in over):
            stay.setdefault(d, []).append(hit)
            if all(other != name for other, _ in over):
                lead.setdefault(d, []).append((name, start, end, rank))
    return [hit for kept in stay.values() for hit in kept]


def license_scan(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licenses in every whole text: one row per row of ``docs`` and template found.

    Returns ``id, license, start, end`` (tokens of the window with the largest share, the
    first of equals), ``share`` (of the template's shingles, at least 0.8) and ``n_places``
    (windows found that do not overlap the one before). Of templates that share much of their
    wording, such as the versions of a license, a place counts for the one that covers most of
    it. The templates are a parameter that goes to every task; they are a list that people
    keep, not data.

    Null and empty texts hold nothing and give no row. Rows are independent, so ids may be
    null or repeat. Empty table: no rows. Other input columns are never read by name. A narrow
    map: no shuffle.
    """
    prepare(docs.sparkSession)
    known = [Template(k, v) for k, v in (TEMPLATES if templates is None else templates).items()]
    near = siblings(known)
    rows = source(docs, id_col, text_col, row=False)

    def run(batches):
        for batch in batches:
            for part, texts in slices(batch, text_col, 2 << 20):
                best: dict[tuple[int, str], list] = {}
                for d, name, start, end, share in sorted((d, name.partition("#")[0], *place) for d, name, *place in settle(scan(texts, known), known, near)):
                    got = best.setdefault((d, name), [start, end, share, 0, -1])
                    if start >= got[4]:
                        got[3] += 1
                    got[4] = max(got[4], end)
                    if share > got[2]:
                        got[:3] = start, end, share
                found = sorted(best.items())
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": part["id"].take(pa.array([d for (d, _), _ in found], pa.int64())),
                        "license": pa.array([name for (_, name), _ in found], pa.string()),
                        "start": pa.array([int(x[0]) for _, x in found], pa.int64()),
                        "end": pa.array([int(x[1]) for _, x in found], pa.int64()),
                        "share": pa.array([float(x[2]) for _, x in found], pa.float64()),
                        "n_places": pa.array([x[3] for _, x in found], pa.int64()),
                    }
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, license string, start long, end long, share double, n_places long")
