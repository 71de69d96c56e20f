"""License scans by patience alignment.

Texts and license templates are sequences of lower-cased words (letters and
digits).  Two sequences are aligned by their anchors, words that occur once in
both; the longest increasing subsequence of anchors is kept, matches grow
from each anchor to both sides, and the gaps between are aligned the same way
until they have no anchor.  The share of a template's words that are aligned
is its coverage.

A text is aligned piece by piece, in pieces of 1.5 template lengths that
overlap by one, so a second copy of a license can't hide the first.  A piece
is skipped only if its words can't reach the coverage asked for (the words of
the template that it has, with their counts, bound every alignment); so a
text without the words costs one lookup.  Findings don't overlap, also those
of different templates; the one with the most aligned words stays.

Sibling licenses differ in a word or a number.  A finding needs every telling
word of its template (``TELLING`` and version numbers) aligned, and none
between its first and last word that the template doesn't have.

Defined results: null and empty texts have no finding; null ids are kept;
rows that repeat are scanned each; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from propval.llm import textbytes as tb

MIN_COVERAGE = 0.8
MIN_DENSITY = 0.6        # aligned words to words of the text from the first to the last

#: Notices and grants as licenses ask authors to write them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or "
        "implied. See the License for the specific language governing permissions and limitations under the License."),
    "BSD-2-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
        "Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that "
        "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
        "copyright notice and this permission notice appear in all copies."),
    "MIT": "Released under the MIT License",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software."),
}

_WORK, _CC = "This work is licensed under ", {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
                                             "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
                                             "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}


def _siblings() -> dict[str, str]:
    """Forms of the other common licenses and of the siblings of those above."""
    out = {
        "BSD-3-Clause": TEMPLATES["BSD-2-Clause"] + (
            " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
            "this software without specific prior written permission."),
        "BSD-2-Clause-grant": "Licensed under the BSD 2-Clause License",
        "BSD-3-Clause-grant": "Licensed under the BSD 3-Clause License",
        "CC0-1.0": "Licensed under CC0 1.0",
        "CC0-1.0-waiver": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work CC0 1.0 Universal",
        "ISC-grant": "Released under the ISC License",
        "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0",
        "MPL-2.0-header": (
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
            "file, You can obtain one at https://mozilla.org/MPL/2.0/."),
        "Unlicense": (
            "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
            "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
            "means."),
        "Unlicense-grant": "Released under the Unlicense",
    }
    for code, kind, version in (("GPL", "", "3"), ("GPL", "", "2"), ("LGPL", "Lesser ", "3"), ("LGPL", "Lesser ", "2.1"), ("AGPL", "Affero ", "3")):
        name, title = f"{code}-{version if '.' in version else version + '.0'}", f"GNU {kind}General Public License"
        out[name] = f"{_WORK}the {title}, version {version}"
        out[f"{name}-name"] = f"{title}, version {version if '.' in version else version + '.0'}"
        out[f"{name}-header"] = TEMPLATES["GPL-3.0-header"].replace("GNU General Public License", title).replace("version 3", f"version {version}")
        out[f"{name}-short"] = f"Licensed under the {code} v{version}"
    for code, title in _CC.items():
        for version, port in (("4.0", "International"), ("3.0", "Unported")):
            out[f"CC-{code}-{version}"] = f"Licensed under CC {code} {version}"
            out[f"CC-{code}-{version}-work"] = f"{_WORK}a Creative Commons {title} {version} {port} License"
    out["CC-BY-SA-4.0-grant"] = out.pop("CC-BY-SA-4.0")
    out.pop("CC-BY-SA-4.0-work")                             # above as CC-BY-SA-4.0
    return {name: text for name, text in out.items() if name not in TEMPLATES}


TEMPLATES |= _siblings()

#: Words that tell sibling licenses apart; numbers do in a short form and after "version" or "v".
TELLING = ("lesser", "library", "affero", "gpl", "lgpl", "agpl", "mit", "isc", "bsd", "apache", "mozilla", "mpl", "cc", "cc0", "unlicense", "nc", "sa", "nd",
           "noncommercial", "sharealike", "noderivatives", "noderivs", "contributors")
NUMBERS = tuple(f"{v}{n}" for v in ("", "v") for n in range(1, 10))
SHORT = 20               # words of a short form

_byte = np.arange(256)
IS_INNER = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(hash, text number) of every run of letters and digits, and the number of texts."""
    data, offsets = tb.text_bytes(texts)
    inside = IS_INNER[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    first[offsets[:-1][full]] = inside[offsets[:-1][full]]
    last[offsets[1:][full] - 1] = inside[offsets[1:][full] - 1]
    start = np.flatnonzero(first)
    return tb.SpanHash(data, lower=True)(start, np.flatnonzero(last) + 1), np.searchsorted(offsets, start, "right") - 1, len(offsets) - 1


def rising(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence (patience sorting)."""
    tops: list[int] = []
    piles: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        back.append(piles[p - 1] if p else -1)
        if p == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[p], piles[p] = v, i
    out, i = [], piles[-1] if piles else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Patience alignment: pairs of places of a and b with equal words, rising
    in both.  Gaps wait on a stack, so long texts need no deep recursion."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        i, j, k, m = gaps.pop()
        while i < j and k < m and a[i] == b[k]:               # equal ends need no anchor
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i >= j or k >= m:
            continue
        in_a, in_b = Counter(a[i:j]), Counter(b[k:m])
        at = {w: p for p, w in enumerate(b[k:m], k) if in_b[w] == 1}
        both = [(p, at[w]) for p, w in enumerate(a[i:j], i) if in_a[w] == 1 and w in at]
        if not both:
            continue
        edge_i, edge_k = i, k
        for x in rising([q for _, q in both]):
            p, q = both[x]
            gaps.append((edge_i, p, edge_k, q))
            out.append((p, q))
            edge_i, edge_k = p + 1, q + 1
        gaps.append((edge_i, j, edge_k, m))
    return sorted(out)


def _hashes(plain: tuple[str, ...]) -> set[int]:
    return set(words(pa.array(plain, pa.string()))[0].tolist())


class Scanner:
    def __init__(self, templates: dict[str, str]):
        self.names, self.numbers, self.version = _hashes(TELLING), _hashes(NUMBERS), _hashes(("version", "v"))
        hashed, owner, n = words(pa.array(list(templates.values()), pa.string()))
        self.templates = [(name, hashed[owner == i].tolist()) for i, name in enumerate(templates) if (owner == i).any()]
        self.known = np.unique(hashed)
        self.counts = [Counter(t) for _, t in self.templates]
        self.telling = [{t[p] for p in range(len(t)) if self._tells(t, p, len(t))} for _, t in self.templates]
        # The words of each template by their number among the known ones, and how often it has them.
        self.weight = np.zeros((len(self.known), len(self.templates)), np.int64)
        for k, c in enumerate(self.counts):
            for w, m in c.items():
                self.weight[np.searchsorted(self.known, np.uint64(w)), k] = m

    def _tells(self, text: list[int], p: int, length: int) -> bool:
        """Whether the word at p tells siblings of a template of so many words apart."""
        return text[p] in self.names or text[p] in self.numbers and (length <= SHORT or p > 0 and text[p - 1] in self.version)

    def __call__(self, texts: pa.Array) -> list[tuple[int, str, float, int, int, int]]:
        """(text number, license, coverage, first word, last word, aligned words) of every finding."""
        hashed, owner, n = words(texts)
        if not len(hashed) or not self.templates:
            return []
        at = np.minimum(np.searchsorted(self.known, hashed), len(self.known) - 1)
        is_known = np.flatnonzero(self.known[at] == hashed)
        has = np.zeros((n, len(self.known)), bool)
        has[owner[is_known], at[is_known]] = True
        size = np.array([len(t) for _, t in self.templates])
        possible = has @ self.weight >= MIN_COVERAGE * size   # no alignment covers words that aren't there
        begin = np.searchsorted(owner, np.arange(n + 1))
        out = []
        for i in np.flatnonzero(possible.any(axis=1)):
            text = hashed[begin[i]:begin[i + 1]].tolist()
            found = [f for k in np.flatnonzero(possible[i]) for f in self._scan(text, int(k))]
            out += [(int(i), *f) for f in _apart(found)]
        return out

    def _scan(self, text: list[int], k: int) -> list[tuple[str, float, int, int, int]]:
        name, template = self.templates[k]
        count, length = self.counts[k], len(template)
        half = max(1, length // 2)
        marks = np.fromiter((w in count for w in text), bool, len(text))
        run = np.concatenate([[0], np.cumsum(marks)])
        found = []
        for at in range(0, max(1, len(text) - length + half), half):
            to = min(len(text), at + length + half)
            if run[to] - run[at] < MIN_COVERAGE * length:
                continue
            piece = text[at:to]
            own = Counter(w for w in piece if w in count)
            if sum(min(c, count[w]) for w, c in own.items()) < MIN_COVERAGE * length:
                continue
            pairs = align(template, piece)
            if not pairs:
                continue
            first, last = pairs[0][1], pairs[-1][1] + 1
            if len(pairs) >= MIN_COVERAGE * length and len(pairs) >= MIN_DENSITY * (last - first) and self._agrees(piece, pairs, k):
                found.append((len(pairs) / length, -(last - first), -(at + first), at + first, at + last, len(pairs)))
        kept: list[tuple] = []
        for f in sorted(found, reverse=True):
            if all(f[4] <= g[3] or g[4] <= f[3] for g in kept):
                kept.append(f)
        return sorted((name, f[0], f[3], f[4], f[5]) for f in kept)

    def _agrees(self, piece: list[int], pairs: list[tuple[int, int]], k: int) -> bool:
        """Whether the aligned part has the telling words of template k and no others."""
        length, telling, aligned = len(self.templates[k][1]), self.telling[k], {q for _, q in pairs}
        if not telling <= {piece[q] for q in aligned}:
            return False
        others = (q for q in range(pairs[0][1], pairs[-1][1]) if q not in aligned and self._tells(piece, q, length))
        return all(piece[q] in telling for q in others)


def _apart(found: list[tuple[str, float, int, int, int]]) -> list[tuple[str, float, int, int, int]]:
    """Of findings that overlap, the one with the most aligned words."""
    starts: list[int] = []
    kept: list[tuple] = []
    for f in sorted(found, key=lambda f: (-f[4], -f[1], f[3] - f[2], f[2], f[0])):
        at = bisect_left(starts, f[2])
        if (at == 0 or kept[at - 1][3] <= f[2]) and (at == len(kept) or f[3] <= kept[at][2]):
            starts.insert(at, f[2])
            kept.insert(at, f)
    return kept


def scan(docs: DataFrame, templates: dict[str, str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, license, coverage, first_word, last_word, n_aligned): every
    license notice found; words are numbered from 0, last_word is the one
    behind the notice."""
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(templates if templates is not None else TEMPLATES))

    def run(batches):
        for part in tb.slices(batches, "text"):
            found = scanner.value(part.column("text"))
            own = part.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([own, pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.float64()),
                                              *(pa.array([f[x] for f in found], pa.int64()) for x in (3, 4, 5))],
                                             names=["doc_id", "license", "coverage", "first_word", "last_word", "n_aligned"])
    named = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    return named.mapInArrow(run, "doc_id long, license string, coverage double, first_word long, last_word long, n_aligned long")
